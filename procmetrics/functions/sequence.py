"""Ordered per-key operators (row_number, lag, first) that survive hot keys.

A plain window sorts all rows of a key in one task, so a key holding a third of
the table is one task sorting a third of the table. These operators work as a
prefix scan. A sample of a fixed number of rows, in the order of (key, order), gives as many cut points as
there are tasks; a key that holds several of them is cut there into pieces of about one task's rows. The window runs
per (key, piece) with one shuffle, and what a piece has to know of the pieces before it, its
count and its end values, is one row per piece, carried along on the driver and joined back. There are no more
pieces than cut points, whatever the data, so both lists are broadcast. Keys without cuts, usually all,
are one piece each and carry nothing. Rows of equal order values stay in one piece.

The driver holds ``MOST_CUTS`` cut points at most. ``row_number`` with more of them cuts in two steps: first at so many points
as above, then each of these pieces at points that are a table, and what these pieces carry is a table too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import measured_join, stored

#: Sampled rows per cut point.
PER_CUT = 20
#: Cut points of a key are searched in two steps, over groups of so many.
GROUP = 64
#: Cut points, and pieces, that the driver holds at most.
MOST_CUTS = 2_000


def _direction(term: str) -> tuple[str, bool]:
    return (term[1:], True) if term.startswith("-") else (term, False)


def _sorted(order: Sequence[str]) -> list[Column]:
    """``order`` as sort columns: a leading minus is descending, nulls are last."""
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in map(_direction, order)]


def _before(cut: Column, order: Sequence[str]) -> Column:
    """Whether the order values in ``cut`` come before those of the row."""
    found = F.lit(False)
    for c, down in reversed([_direction(t) for t in order]):
        x, y = cut[c], F.col(c)
        less = F.coalesce(x > y if down else x < y, x.isNotNull() & y.isNull())
        found = less | (x.eqNullSafe(y) & found)
    return found


def _cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int) -> dict[tuple, list[tuple]]:
    """Order values at which a key is to be cut, for the keys that hold two and more of ``parts`` even cuts."""
    names = [_direction(t)[0] for t in order]
    rows = df.select(*keys, *names)
    wanted = PER_CUT * parts
    share = min(1.0, wanted / max(1, rows.count()))
    sample = rows if share == 1.0 else rows.sample(share, seed=11)
    # a sample has as many rows as were asked for, give or take; every step-th is a cut
    ordered = sample.orderBy(*[F.col(k).asc_nulls_last() for k in keys], *_sorted(order)).collect()
    step = max(1, len(ordered) // parts)
    cuts: dict[tuple, list[tuple]] = {}
    for r in ordered[step::step]:
        mine = cuts.setdefault(tuple(r[:len(keys)]), [])
        value = tuple(r[len(keys):])
        if not mine or mine[-1] != value:
            mine.append(value)
    return {k: v for k, v in cuts.items() if len(v) > 1}


def _parts_of(df: DataFrame, parts: int | None) -> int:
    return parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _join_keys(keys: Sequence[str]) -> list[Column]:
    # a null key is a group of its own in a window
    return [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]


def _local(df: DataFrame, keys: Sequence[str], rows: list, more: Sequence[T.StructField]) -> DataFrame:
    fields = [T.StructField(f"_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    return F.broadcast(df.sparkSession.createDataFrame(rows, T.StructType([*fields, *more])))


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: dict[tuple, list[tuple]]) -> DataFrame:
    """``df`` with ``_piece``: the number of its key's cuts before the row, null for a key without cuts."""
    point = T.StructType([T.StructField(c, df.schema[c].dataType) for c, _ in map(_direction, order)])
    groups = T.ArrayType(T.ArrayType(point))
    rows = [(*k, [v[i:i + GROUP] for i in range(0, len(v), GROUP)]) for k, v in cuts.items()]
    known = _local(df, keys, rows, [T.StructField("_cuts", groups)])
    joined = df.join(known, _join_keys(keys), "left")
    at = F.size(F.filter("_cuts", lambda g: _before(F.get(g, F.lit(0)), order)))
    joined = joined.withColumn("_group", F.when(F.col("_cuts").isNotNull(), at))
    inside = F.size(F.filter(F.get("_cuts", F.col("_group") - 1), lambda c: _before(c, order)))
    piece = F.when(F.col("_group") > 0, (F.col("_group") - 1) * GROUP + inside).otherwise(F.col("_group"))
    return joined.select(*df.columns, piece.alias("_piece"))


def _summaries(cut: DataFrame, keys: Sequence[str], summary: Sequence[Column]) -> list:
    return cut.where("_piece is not null").groupBy(*keys, "_piece").agg(*summary).collect()


def _carried(cut: DataFrame, found: list, keys: Sequence[str], carry, fields: Sequence[T.StructField]) -> DataFrame:
    """``cut`` with what ``carry`` makes of the summaries of the pieces before a row's piece."""
    by_key: dict[tuple, list] = {}
    for r in found:
        by_key.setdefault(tuple(r[:len(keys)]), []).append(r[len(keys):])
    rows = [(*k, piece, *values) for k, pieces in by_key.items()
            for piece, values in carry(sorted(pieces, key=lambda p: p[0]))]
    known = _local(cut, keys, rows, [T.StructField("_p", T.IntegerType()), *fields])
    on = [*_join_keys(keys), F.col("_piece") == F.col("_p")]
    return cut.join(known, on, "left").drop("_p", *[f"_k{i}" for i in range(len(keys))])


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
               parts: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` as column ``out``.

    ``order`` are column names, descending with a leading minus; nulls are last. Rows of a key with equal order values
    get their numbers in any order. A key is cut if it holds several of ``parts`` (by default the number
    of shuffle partitions) equal shares of the rows.
    """
    parts = _parts_of(df, parts)
    if parts > MOST_CUTS:
        return _finely_numbered(df, keys, order, out, parts)
    cuts = _cuts(df, keys, order, parts)
    if not cuts:
        return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*_sorted(order))).cast("bigint"))
    cut = _cut(df, keys, order, cuts)
    own = F.row_number().over(W.partitionBy(*keys, "_piece").orderBy(*_sorted(order)))
    return _counted_on(cut, keys).withColumn(out, (own + F.coalesce("_ahead", F.lit(0))).cast("bigint")).drop("_piece", "_ahead")


def _counted_on(rows: DataFrame, keys: Sequence[str], counted: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``_ahead``: the rows of the key in the pieces before, null for a key without cuts.

    ``counted`` has the same rows, if they are cheaper to count there.
    """

    def counts_before(pieces):
        total = 0
        for piece, n in pieces:
            yield piece, (total,)
            total += n

    found = _summaries(rows if counted is None else counted, keys, [F.count(F.lit(1)).alias("_n")])
    return _carried(rows, found, keys, counts_before, [T.StructField("_ahead", T.LongType())])


def _points(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int) -> DataFrame:
    """What ``_cuts`` finds, as a table with a row per cut: the sorted sample is numbered by Spark, and stays there."""
    names = [_direction(t)[0] for t in order]
    rows = df.select(*keys, *names)
    share = min(1.0, PER_CUT * parts / max(1, rows.count()))
    sample = rows if share == 1.0 else rows.sample(share, seed=11)
    in_order = sample.orderBy(*[F.col(k).asc_nulls_last() for k in keys], *_sorted(order))
    # the number of the task stands above bit 33, that of its row below
    placed = stored(in_order.withColumn("_at", F.monotonically_increasing_id()), "sample")
    task = F.shiftright("_at", 33)
    starts, total = [], 0
    for t, n in sorted(placed.groupBy(task.alias("t")).agg(F.count(F.lit(1))).collect()):
        starts.append((t, total))
        total += n
    known = F.broadcast(df.sparkSession.createDataFrame(starts, "_task bigint, _start bigint"))
    step = max(1, total // parts)
    at = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    cuts = placed.join(known, task == F.col("_task")).where((at >= step) & (at % step == 0)).select(*rows.columns).distinct()
    many = cuts.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return cuts.join(many, _join_keys(keys), "left_semi")


def _finely_numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, parts: int) -> DataFrame:
    """``row_number`` with more cut points than the driver holds.

    The pieces at the first ``MOST_CUTS`` cut points are small enough for one task each. In them rows and the other cut points
    are put in order together, which gives each row its fine piece; the counts of fine pieces are summed up as a table.
    """
    points = _points(df, keys, order, parts)
    cuts = _cuts(df, keys, order, MOST_CUTS)
    marked = df.withColumn("_point", F.lit(0)).unionByName(points.withColumn("_point", F.lit(1)), allowMissingColumns=True)
    cut = _cut(marked, keys, order, cuts) if cuts else marked.withColumn("_piece", F.lit(None).cast("int"))
    group = [*keys, "_piece"]
    # a row stands before the cut point that equals it
    upto = W.partitionBy(*group).orderBy(*_sorted(order), "_point").rowsBetween(W.unboundedPreceding, 0)
    fine = stored(cut.withColumn("_fine", F.sum("_point").over(upto)).where("_point = 0").drop("_point"), "pieces")
    sizes = fine.groupBy(*group, "_fine").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_fine").rowsBetween(W.unboundedPreceding, -1)
    ahead = sizes.withColumn("_in_piece", F.sum("_n").over(before)).where("_in_piece is not null").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(group)], F.col("_fine").alias("_f"), "_in_piece")
    rows = fine.join(ahead, [*_join_keys(group), F.col("_fine") == F.col("_f")], "left").drop(
        "_f", *[f"_k{i}" for i in range(len(group))])
    rows = _counted_on(rows, keys, fine) if cuts else rows.withColumn("_ahead", F.lit(None).cast("bigint"))
    own = F.row_number().over(W.partitionBy(*group, "_fine").orderBy(*_sorted(order)))
    number = own + F.coalesce("_in_piece", F.lit(0)) + F.coalesce("_ahead", F.lit(0))
    return rows.withColumn(out, number.cast("bigint")).select(*df.columns, out)


def lag_first(df: DataFrame, keys: Sequence[str], seq: str, value: str, lag_out: str | None = None,
              first_out: str | None = None, parts: int | None = None) -> DataFrame:
    """Previous and first ``value`` per key along ``seq``; nulls in ``seq`` are last, equal ones go by ``value``.

    Beyond ``MOST_CUTS`` parts keys are cut no finer.
    """
    cuts = _cuts(df, keys, [seq], min(_parts_of(df, parts), MOST_CUTS))
    in_order = [F.col(seq).asc_nulls_last(), F.col(value).asc()]

    def windows(rows, w, lag, first):
        made = {lag_out: lag(w), first_out: first(w)}
        return rows.withColumns({n: c for n, c in made.items() if n})

    if not cuts:
        return windows(df, W.partitionBy(*keys).orderBy(*in_order), lambda w: F.lag(value).over(w), lambda w: F.first(value).over(w))

    def ends_before(pieces):
        first, last = pieces[0][1], None
        for piece, head, tail in pieces:
            yield piece, (last, first)
            last = tail

    kind = df.schema[value].dataType
    place = F.struct(F.col(seq).isNull(), seq, value)
    ends = [F.min_by(F.struct(value), place)[value].alias("_head"), F.max_by(F.struct(value), place)[value].alias("_tail")]
    cut = _cut(df, keys, [seq], cuts)
    rows = _carried(cut, _summaries(cut, keys, ends), keys, ends_before,
                    [T.StructField("_last", kind), T.StructField("_start", kind)])
    w = W.partitionBy(*keys, "_piece").orderBy(*in_order)
    rows = rows.withColumn("_place", F.row_number().over(w))
    return windows(rows, w,
                   lambda w: F.when(F.col("_place") == 1, F.col("_last")).otherwise(F.lag(value).over(w)),
                   lambda w: F.when(F.col("_piece").isNull(), F.first(value).over(w)).otherwise(F.col("_start")),
                   ).drop("_piece", "_place", "_last", "_start")


def text_list(df: DataFrame, keys: Sequence[str], value: str, sep: str, out: str) -> DataFrame:
    """Ordered text list of ``value`` per key, complete for every key, with the count ``n_items``.

    One text holds a key's whole list, so the key's values meet in one row; a consumer that
    does not need the text should read ``list_members``, which never gathers a key.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(F.sort_array(F.collect_list(value)), sep).alias(out))


def list_members(df: DataFrame, keys: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """The members of the same lists as rows (keys, position from 1, value); null values are no members."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    return row_number(rows, keys, [value], "position", parts)


#: Errors of the sketch's ranks, as a share of a key's rows, are below 1 / ACCURACY; the middle lies between the quantiles
#: MARGIN such errors below and above it.
ACCURACY, MARGIN = 10_000, 4


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, count_out: str | None = None) -> DataFrame:
    """Exact median per key (mean of the two middle values) by selection, without a per-key sort.

    A mergeable sketch per key gives two values that hold the middle between them with about a thousandth of the key's
    rows, wherever values are dense, and however far outliers lie. Rows are folded to counts per
    distinct value; values below the two are only counted, and those between them are put in order. A null value is none.
    ``count_out`` names the number of values, if that is wanted too.
    """
    v = F.col(value).cast("double")
    have = df.where(F.col(value).isNotNull()).select(*keys, v.alias("_v"))
    off = MARGIN / ACCURACY
    cut = F.percentile_approx("_v", [0.5 - off, 0.5 + off], ACCURACY)
    ends = have.groupBy(*keys).agg(cut.alias("_c"), F.count(F.lit(1)).alias("_total")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.get("_c", F.lit(0)).alias("_lo"), F.get("_c", F.lit(1)).alias("_hi"), "_total")
    counts = have.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    if keys:
        ends = stored(ends, "median-ends")
    near = measured_join(counts, ends, [(k, f"_k{i}") for i, k in enumerate(keys)], F.col("_v")).where(F.col("_v") <= F.col("_hi"))
    # one row a key for all that lies below, one a value for the rest
    folded = near.groupBy(*keys, F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v")).agg(
        F.sum("_n").alias("_n"), F.first("_total").alias("_total"))
    upto = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(1))).orderBy(
        F.col("_v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    placed = folded.withColumn("_to", F.sum("_n").over(upto))
    lo, hi = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    at = lambda rank: F.max(F.when((F.col("_to") - F.col("_n") < rank) & (F.col("_to") >= rank), F.col("_v")))
    wanted = [((at(lo) + at(hi)) / 2).alias(out), *([F.max("_total").alias(count_out)] if count_out else [])]
    return placed.groupBy(*keys).agg(*wanted) if keys else placed.agg(*wanted)
