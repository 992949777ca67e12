import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procmetrics.functions import clean, keys, sequence
from procmetrics.functions.sequence import exact_median, lag_first, list_members, row_number, text_list


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr.alias("v")).first().v


@pytest.mark.parametrize("raw, want", [("  A1  ", "A1"), ("   ", None), ("", None), (None, None)])
def test_clean_str(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(clean.clean_str(F.col("c"))).first()[0] == want


def test_text_casts_turn_bad_text_into_null(spark):
    df = spark.createDataFrame(
        [("1/5/2024", " 12.50 ", "7"), ("13/45/2024", "n/a", "x"), ("", "", " "),
         ("01/05/2024", "-3", "1e2")], "d string, n string, h string")
    got = df.select(clean.clean_pdate(F.col("d")), clean.clean_pnum(F.col("n")),
                    clean.clean_hsnum(F.col("h"))).collect()
    day = dt.date(2024, 1, 5)
    assert [r[0] for r in got] == [day, None, None, day]
    assert [r[1] and float(r[1]) for r in got] == [12.5, None, None, -3.0]
    assert [r[2] for r in got] == [7.0, None, None, 100.0]


def test_sentinel_and_ratio(spark):
    df = spark.createDataFrame([(dt.date(1753, 1, 1), 3, 0), (dt.date(2024, 1, 1), 3, 2)],
                               "d date, a int, b int")
    got = df.select(clean.clean_sdate(F.col("d")), clean.ratio(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(None, None), (dt.date(2024, 1, 1), 1.5)]


def test_names(spark):
    df = spark.createDataFrame(
        [("Halcyon Hydraulics, LLC",), ("Redstone  Machine Works Inc",), ("Group",), ("A & B Co",)],
        "n string")
    got = df.select(keys.name_core(F.col("n")), keys.name_alnum(F.col("n"))).collect()
    assert [r[0] for r in got] == ["HALCYON HYDRAULICS", "REDSTONE MACHINE WORKS", "GROUP", "A B"]
    assert got[0][1] == "HALCYONHYDRAULICSLLC"
    assert one(spark, keys.domain_stem(F.col("d")), d="acme.co.uk") == "ACME"


def test_suffixes_come_from_the_seed_longest_first(spark):
    seed = spark.createDataFrame([("CO",), ("COMPANY",), ("GMBH",)], "suffix string")
    assert keys.suffix_list(seed) == ("COMPANY", "GMBH", "CO")
    assert keys.suffix_list(seed.limit(0)) == keys.LEGAL_SUFFIXES


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, null values and a null key."""
    rnd = random.Random(7)
    rows = []
    for n in range(600):
        k = "hot" if n % 3 == 0 else None if n % 50 == 1 else f"k{rnd.randrange(40)}"
        rows.append((k, n, None if n % 11 == 0 else rnd.randrange(30), f"c{rnd.randrange(10**6):06d}-{n}"))
    return spark.createDataFrame(rows, "k string, seq bigint, v int, code string").repartition(5).cache()


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("parts", [None, 7, 100, 600])
def test_row_number_in_pieces_equals_the_window(skewed, parts):
    got = row_number(skewed, ["k"], ["code"], "rn", parts)
    want = skewed.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy("code")))
    assert rows(got, "k", "code", "rn") == rows(want, "k", "code", "rn")
    assert exchanges(got) == 1
    down = row_number(skewed, ["k"], ["-v", "code"], "rn", parts)
    want = skewed.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy(F.desc_nulls_last("v"), "code")))
    assert rows(down, "k", "code", "rn") == rows(want, "k", "code", "rn")


def test_more_cuts_than_the_driver_holds(skewed, monkeypatch):
    """The numbers are those of the window, and cut points beyond a bound do not reach the driver."""
    monkeypatch.setattr(sequence, "MOST_CUTS", 5, raising=False)
    frame, most, collect = type(skewed), [0], type(skewed).collect

    def counted(df):
        got = collect(df)
        most[0] = max(most[0], len(got))
        return got

    monkeypatch.setattr(frame, "collect", counted)
    got = row_number(skewed, ["k"], ["-v", "code"], "rn", 300)
    assert most[0] <= 2 * sequence.PER_CUT * 5
    monkeypatch.setattr(frame, "collect", collect)
    want = skewed.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy(F.desc_nulls_last("v"), "code")))
    assert rows(got, "k", "code", "rn") == rows(want, "k", "code", "rn")
    for r in sequence._points(skewed, ["k"], ["code"], 300).groupBy("k").count().collect():
        assert r["count"] > 1
    # equal order values stay in one piece, whatever points fall on them
    numbers = {}
    for r in row_number(skewed, ["k"], ["v"], "rn", 300).collect():
        numbers.setdefault(r.k, []).append((10**9 if r.v is None else r.v, r.rn))
    for mine in numbers.values():
        assert sorted(n for _, n in mine) == list(range(1, len(mine) + 1))
        assert [v for v, _ in sorted(mine, key=lambda m: m[1])] == sorted(v for v, _ in mine)


def test_row_number_over_repeated_order_values(skewed):
    """Equal order values share their numbers in any order; no number is missing or given twice."""
    got = {}
    for r in row_number(skewed, ["k"], ["v"], "rn", 300).collect():
        got.setdefault(r.k, []).append((r.rn, 10**9 if r.v is None else r.v))
    for mine in got.values():
        mine.sort()
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1))
        assert [v for _, v in mine] == sorted(v for _, v in mine)


def test_a_hot_key_is_cut_into_even_pieces(spark):
    """A key with a third of the rows, and one order value with half of those."""
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as k", "if(id % 6 = 0, 7, id) as v")
    cuts = sequence._cuts(df, ["k"], ["v"], 30)
    assert set(cuts) == {("hot",)} and len(cuts["hot",]) >= 4
    sizes = {r._piece: r["count"] for r in sequence._cut(df, ["k"], ["v"], cuts).groupBy("_piece").count().collect()}
    # rows of one order value stay together
    assert sorted(sizes.values())[-3] < 2_500 and sizes[None] == 20_000
    got = row_number(df, ["k"], ["v"], "rn", 30).where("k = 'hot'")
    assert got.agg(F.count_distinct("rn"), F.max("rn")).first()[:] == (10_000, 10_000)


@pytest.mark.parametrize("parts", [None, 7, 100, 600])
def test_lag_and_first_in_pieces_equal_the_window(skewed, parts):
    got = lag_first(skewed, ["k"], "seq", "v", "p", "f", parts)
    w = W.partitionBy("k").orderBy("seq")
    want = skewed.withColumns({"p": F.lag("v").over(w), "f": F.first("v").over(w)})
    assert rows(got, "k", "seq", "p", "f") == rows(want, "k", "seq", "p", "f")
    assert exchanges(got) == 1
    # equal and missing places in the order: those go by value, nulls come last
    loose = skewed.withColumn("seq", F.when(F.col("seq") % 17 > 0, F.floor(F.col("seq") / 9)))
    got = lag_first(loose, ["k"], "seq", "v", "p", "f", parts)
    w = W.partitionBy("k").orderBy(F.asc_nulls_last("seq"), "v")
    want = loose.withColumns({"p": F.lag("v").over(w), "f": F.first("v").over(w)})
    assert rows(got, "k", "seq", "v", "p", "f") == rows(want, "k", "seq", "v", "p", "f")


def test_median(skewed):
    data = {}
    for r in skewed.collect():
        if r.v is not None:
            data.setdefault(r.k, []).append(r.v)
    got = {r.k: r.m for r in exact_median(skewed, ["k"], "v", "m").collect()}
    assert got == {k: statistics.median(v) for k, v in data.items()}
    every = [x for v in data.values() for x in v]
    assert exact_median(skewed, [], "v", "m", "n").first()[:] == (statistics.median(every), len(every))
    assert exact_median(skewed.where("v is null"), [], "v", "m").first().m is None


def test_an_outlier_leaves_the_middle_narrow(spark):
    """Values that all lie close together beside one far away: hardly any are put in order."""
    df = spark.range(200_001).selectExpr("id % 5 as k", "if(id = 77, 1e15, (id * 7919) % 200001 / 1e6) as v")
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r.k, []).append(r.v)
    got = exact_median(df, ["k"], "v", "m")
    assert {r.k: r.m for r in got.collect()} == {k: statistics.median(v) for k, v in by_key.items()}
    whole = exact_median(df, [], "v", "m")
    assert whole.first().m == statistics.median([x for v in by_key.values() for x in v])
    off = sequence.MARGIN / sequence.ACCURACY
    lo, hi = df.selectExpr(f"percentile_approx(v, array({0.5 - off}, {0.5 + off}), {sequence.ACCURACY})").first()[0]
    assert 1 <= df.where((F.col("v") >= lo) & (F.col("v") <= hi)).count() < 1_000


def test_lists_are_complete_for_every_group(spark, skewed):
    got = {r.k: r for r in text_list(skewed, ["k"], "code", ",", "codes").collect()}
    assert got["hot"].n_items == 200
    for k, r in got.items():
        assert r.codes == ",".join(sorted(x.code for x in skewed.where(F.col("k").eqNullSafe(F.lit(k))).collect()))
    big = spark.range(12_000).selectExpr("'k' as k", "lpad(id, 6, '0') as code")
    r = text_list(big, ["k"], "code", ",", "codes").first()
    assert r.n_items == 12_000 and len(r.codes.split(",")) == 12_000


def test_members_are_the_lists_as_rows(skewed):
    lists = {r.k: r.codes.split(",") for r in text_list(skewed, ["k"], "code", ",", "codes").collect()}
    rows = list_members(skewed, ["k"], "code", 200).collect()
    for k, codes in lists.items():
        mine = sorted((r.position, r.code) for r in rows if r.k == k)
        assert [p for p, _ in mine] == list(range(1, len(codes) + 1)) and [c for _, c in mine] == codes
