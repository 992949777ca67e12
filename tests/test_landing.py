import datetime as dt
import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procmetrics.operators import events, staging
from procmetrics.session import scratch, shared_dir
from procmetrics.sources import catalog, contract, landing, publish
from procmetrics.streaming import jobs

D = dt.date
SPEC = catalog.TableSpec("erp", "t", "modified_date", ("id",), "day")
COLS = "id int, v string, day date"


def fixture_tables():
    """The source schemas stated in FIXTURES.md, as a contract."""
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "FIXTURES.md")
    out = {}
    for row in open(path):
        m = re.match(r"\| (\w+)\.(\w+) \| `[^`]+` \| `[^`]+` \| \w+ \|.*\| (.*) \|$", row.strip())
        if m:
            cols = dict(c.rsplit(" ", 1) for c in re.split(r", (?=\w+ \w)", m.group(3)))
            out.setdefault(m.group(1), {})[m.group(2)] = cols
    return out


NAMES = dict(zip(("hubspot", "netstock", "pangea", "paycom", "sage_x3"),
                 ("crm", "planning", "freight", "payroll", "erp")))


def test_every_source_table_stages(spark):
    """All 54 tables: schema from the contract, spec from the rules, one projection."""
    found = fixture_tables()
    tables = [(NAMES[s], t, contract.contract_schema(found, s, t)) for s in found for t in found[s]]
    assert len(tables) == 54 and sum(len(s) for _, _, s in tables) == 497
    labels = staging.empty(spark, "menu_chapter bigint, menu_code bigint, language_code string, "
                                  "menu_label string")
    for system, table, schema in tables:
        spec = catalog.table_spec(system, table)
        assert set(spec.primary_key) <= set(schema.fieldNames()), table
        if spec.cursor_column:
            assert spec.cursor_column in schema.fieldNames()
        df = spark.createDataFrame([tuple(None for _ in schema)], schema)
        out = staging.stage_table(system, table, df, labels)
        assert len(set(out.columns)) == len(out.columns), table
        assert out.count() == 1
        menus = len(staging.MENUS.get(table, ())) if system == "erp" else 0
        flags = len(staging.FLAGS.get(table, ())) if system == "erp" else 0
        private = table == "employee"
        assert len(out.columns) == len(schema) + menus + flags, (table, private)


def test_derived_kinds():
    kinds = {s.alias: s.kind for s in staging.spec_for("payroll", "check", T.StructType.fromDDL(
        "check_id string, check_date string, period_start string, gross_pay string, hours string"))}
    assert kinds == {"check_id": "str", "check_date": "pdate", "period_start_date": "pdate",
                     "gross_pay_amount": "pnum", "hours": "pnum"}
    erp = {s.alias: s.kind for s in staging.spec_for("erp", "SORDERQ", T.StructType.fromDDL(
        "SOHNUM_0 string, SOPLIN_0 bigint, QTY_0 decimal(18,4), DEMDLVDAT_0 date"))}
    assert erp == {"sales_order_number": "str", "sales_order_line_number": "int",
                   "ordered_qty": "num", "requested_delivery_date": "sdate"}


def test_contract_and_drift(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    frozen = contract.freeze({("s", "t"): df})
    path = tmp_path / "c.json"
    import json
    path.write_text(json.dumps(frozen))
    assert contract.contract_schema(contract.load_contract(str(path)), "s", "t") == df.schema
    assert contract.contract_schema(
        {"s": {"t": {"x": {"data_type": "decimal", "precision": 9, "scale": 2}, "y": "text"}}},
        "s", "t").simpleString() == "struct<x:decimal(9,2),y:string>"
    assert contract.check_drift(frozen, "s", "t", df) is None
    new = contract.check_drift(frozen, "s", "t", df.withColumn("c", F.lit(1)))
    assert not new.is_incident and new.added == ("c",)
    lost = contract.check_drift(frozen, "s", "t", df.drop("b"))
    with pytest.raises(contract.DriftError, match="lost b"):
        contract.require_no_incident([new, lost, None])
    assert contract.check_drift(frozen, "s", "other", df) is None


def test_all_null_column_survives_a_pinned_read(spark):
    path = scratch(spark, "nulls")
    df = spark.createDataFrame([(1, None)], "a int, b string")
    df.write.parquet(path)
    assert landing.read_full(spark, path, df.schema, ["b"]).schema["b"].dataType == T.StringType()


def test_projection_is_idempotent_and_keeps_the_newest(spark):
    root = scratch(spark, "landing")
    a = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 1))], COLS)
    b = spark.createDataFrame([(2, "B", D(2024, 1, 2)), (3, None, D(2024, 1, 2))], COLS)
    landing.land(a, root, SPEC, "1", D(2024, 1, 1))
    landing.land(b, root, SPEC, "2", D(2024, 1, 2))
    now = landing.project(landing.scan_landing(spark, root, SPEC, a.schema), SPEC)
    want = {(1, "a"), (2, "B"), (3, None)}
    assert {(r.id, r.v) for r in now.collect()} == want
    landing.land(b, root, SPEC, "3", D(2024, 1, 3))
    again = landing.project(landing.scan_landing(spark, root, SPEC, a.schema), SPEC)
    assert {(r.id, r.v) for r in again.collect()} == want
    # a column added later reads as null in the older packages
    landing.land(b.withColumn("n", F.lit(7)), root, SPEC, "4", D(2024, 1, 4))
    wide = landing.project(landing.scan_landing(spark, root, SPEC), SPEC)
    assert {(r.id, r.n) for r in wide.collect()} == {(1, None), (2, 7), (3, 7)}


def test_scan_prunes_load_dates(spark):
    root = scratch(spark, "landing")
    a = spark.createDataFrame([(1, "a", D(2024, 1, 1))], COLS)
    for n in (1, 2, 3):
        landing.land(a, root, SPEC, str(n), D(2024, 1, n))
    df = landing.scan_landing(spark, root, SPEC, a.schema, since=D(2024, 1, 3))
    assert df.count() == 1
    assert "PartitionFilters: [isnotnull(load_date" in df._jdf.queryExecution().toString()


def test_watermark_never_moves_back(spark):
    state = spark.createDataFrame([], landing.STATE_SCHEMA)
    assert landing.window_start(state, SPEC) is None
    for day in (D(2024, 5, 1), D(2024, 4, 1), None):
        df = spark.createDataFrame([(1, "a", day)], COLS)
        state = landing.advance(state, SPEC, df, "day")
    assert [r.high_water_mark for r in state.collect()] == [D(2024, 5, 1)]
    assert landing.window_start(state, SPEC) == D(2024, 2, 1)
    assert landing.window_start(state, SPEC, full_refresh=True) is None


def test_header_window_reads_padded_children_once(spark):
    parent = spark.createDataFrame([("A", D(2024, 3, 1)), ("A", D(2024, 3, 2)), ("B", D(2023, 1, 1))],
                                   "no string, day date")
    child = spark.createDataFrame([("A   ", 1), ("A   ", 2), ("B", 1)], "no string, line int")
    got = landing.read_header_window(child, parent, "no", "day", D(2024, 1, 1))
    assert sorted(r.line for r in got.collect()) == [1, 2]
    assert landing.read_header_window(child, parent, "no", "day", None).count() == 3


def drop(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def test_file_drop(spark, tmp_path):
    folder = str(tmp_path / "drop")
    drop(folder, "EMPLOYEE_20240101.csv", "a,b\n1,x\n")
    drop(folder, "EMPLOYEE_20240103.csv", 'b,a\n,007\n"q, ""z""",2\n')
    drop(folder, "EMPLOYEE_DETAIL_20240109.csv", "a\n1\n")
    got = landing.read_latest_drop(spark, folder, "employee", D(2024, 1, 5))
    assert {(r.a, r.b) for r in got.collect()} == {("007", None), ("2", 'q, "z"')}
    with pytest.raises(landing.StaleExportError, match="3 days old"):
        landing.read_latest_drop(spark, folder, "employee", D(2024, 1, 6))
    with pytest.raises(landing.StaleExportError, match="no CHECK"):
        landing.read_latest_drop(spark, folder, "check", D(2024, 1, 6))


def test_specs():
    assert len(catalog.all_specs()) == 54
    assert catalog.table_spec("erp", "SORDER").disposition == "merge"
    assert catalog.table_spec("erp", "SORDER").reconcile_keys == "weekly"
    assert catalog.table_spec("planning", "forecast").disposition == "replace"
    assert catalog.table_spec("freight", "charge").window_via[0] == "shipment"


def test_seeds_keep_their_types(spark):
    for name in publish.SEEDS:
        df = publish.load_seed(spark, name)
        assert df.schema.simpleString() == spark.createDataFrame([], publish.SEEDS[name]).schema.simpleString()
    assert publish.load_seed(spark, "legal_suffix").where("note is not null").count() == 2


def test_projection_opens_the_newest_package_only(spark):
    root, spec = scratch(spark, "archive"), catalog.table_spec("erp", "COMPANY")
    for day in range(1, 9):
        rows = spark.createDataFrame([(f"C{i}", day) for i in range(day)], "CPY_0 string, n int")
        landing.land(rows, root, spec, f"L{day:03d}", dt.date(2024, 1, day))
    got = landing.current(spark, root, spec)
    assert {(r.CPY_0, r.n) for r in got.collect()} == {(f"C{i}", 8) for i in range(8)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("load_date") and "2024-01-08" in plan


def test_the_newest_load_counts_not_the_newest_folder(spark):
    root = scratch(spark, "archive")
    spec = catalog.TableSpec("planning", "t", "snapshot", ("id",))
    landing.land(spark.createDataFrame([(1, "old", None)], COLS), root, spec, "load-1", D(2024, 1, 2))
    landing.land(spark.createDataFrame([(1, "new", None)], COLS), root, spec, "load-2", D(2024, 1, 1))
    landing.land(spark.createDataFrame([], COLS), root, spec, "load-3", D(2024, 1, 3))
    assert landing.newest_load(spark, root, spec) == "load-2"
    assert [r.v for r in landing.current(spark, root, spec).collect()] == ["new"]
    assert {r.v for r in landing.project_replace(landing.scan_landing(spark, root, spec)).collect()} == {"new"}


def test_a_package_is_landed_once(spark):
    root = scratch(spark, "archive")
    a = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 5))], COLS)
    for _ in range(3):
        landing.land(a, root, SPEC, "1", D(2024, 1, 6))
    # complete: a later attempt with other rows is no new package
    landing.land(a.where("id = 1"), root, SPEC, "1", D(2024, 1, 7))
    assert landing.scan_landing(spark, root, SPEC, a.schema).count() == 2
    # lost before its row was written: not read, and replaced by the next attempt
    (a.withColumns({"load_id": F.lit("2"), "load_date": F.lit(D(2024, 1, 7)), "package": F.lit("p-2")})
     .write.mode("append").partitionBy("load_date", "package").parquet(landing.landing_path(root, SPEC)))
    assert landing.scan_landing(spark, root, SPEC, a.schema).count() == 2
    landing.land(a.where("id = 2"), root, SPEC, "2", D(2024, 1, 7))
    assert sorted(r.load_id for r in landing.scan_landing(spark, root, SPEC).collect()) == ["1", "1", "2"]
    # a ledger row that was written twice counts once
    landing.ledger(spark, root).where("load_id = '2'").write.mode("append").parquet(f"{root}/load_ledger")
    status = landing.landing_status(landing.ledger(spark, root), [SPEC]).first()
    assert status[:] == ("erp", "t", 3, 2, 2, D(2024, 1, 6), D(2024, 1, 7), D(2024, 1, 5))


def test_status_reads_the_ledger_alone(spark):
    root = scratch(spark, "archive")
    rows = [("erp", "t", f"{n:03d}", D(2024, 1, 1) + dt.timedelta(days=n // 2), n, None if n < 3 else D(2023, 1, n % 28 + 1))
            for n in range(100)]
    spark.createDataFrame(rows, landing.LEDGER).write.parquet(f"{root}/load_ledger")
    other = catalog.TableSpec("crm", "never", "full_refresh", ("id",))
    got = {r.table_name: r[2:] for r in landing.landing_status(landing.ledger(spark, root), [SPEC, other]).collect()}
    assert got == {"t": (4950, 100, 50, D(2024, 1, 1), D(2024, 2, 19), D(2023, 1, 28)),
                   "never": (0, 0, 0, None, None, None)}
    assert landing.ledger(spark, scratch(spark, "nothing")).count() == 0


def test_quoted_line_breaks_in_ranges(spark, tmp_path):
    """Records over several lines and several ranges, against the csv module."""
    import csv

    rnd = random.Random(4)
    words = ["plain", 'say "so"', "two\nlines", "a, b", "", '"', "\n\n", "end\n" * 40, "ä"]
    rows = [[str(n), rnd.choice(words), rnd.choice(words) + rnd.choice(words)] for n in range(700)]
    folder = tmp_path / "drop" / "EMPLOYEE_20240103.csv"
    folder.mkdir(parents=True)
    for part, end in enumerate(("\n", "\r\n")):
        with open(folder / f"part-{part}.csv", "w", newline="") as fh:
            out = csv.writer(fh, lineterminator=end)
            out.writerow(["id", "note", "more"])
            out.writerows(rows[part::2])
    want = sorted((a, b or None, c or None) for a, b, c in rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "2k", "300"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = landing.read_latest_drop(spark, str(tmp_path / "drop"), "employee", D(2024, 1, 3))
            assert sorted(tuple(r) for r in got.collect()) == want
            lines = spark.read.option("lineSep", "\n").text(str(folder))
            assert (lines.rdd.getNumPartitions() > 10) == (size != "128m")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stream_restart_goes_on_where_it_stopped(spark):
    folder, target, mark = (scratch(spark, n) for n in ("in", "out", "mark"))
    schema = T.StructType.fromDDL("id int, n int, v string")
    run = lambda: jobs.stream_upsert(
        jobs.file_stream(spark, folder, schema), ["id"], ["n"], target, mark)
    for n, rows in enumerate(([(1, 1, "a"), (2, 1, "b")], [(1, 2, "A")], [(2, 0, "late")])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        run()
        run()
    got = {(r.id, r.v) for r in jobs.read_current(spark, target, schema).collect()}
    assert got == {(1, "A"), (2, "b")}
    # a replayed batch of the same run changes nothing
    write = jobs.upsert_batches(target, ["id"], ["n"], mark)
    write(spark.createDataFrame([(2, 9, "replayed")], schema), 2)
    assert {(r.id, r.v) for r in jobs.read_current(spark, target, schema).collect()} == got
    # a new checkpoint goes on from the state there is
    spark.createDataFrame([(3, 1, "c"), (1, 2, "later")], schema).write.mode("append").parquet(folder)
    mark = scratch(spark, "mark")
    run()
    got = {(r.id, r.v) for r in jobs.read_current(spark, target, schema).collect()}
    assert got == {(1, "later"), (2, "b"), (3, "c")} or got == {(1, "A"), (2, "b"), (3, "c")}


def test_later_arrivals_win_on_equal_order_values(spark):
    target, schema = scratch(spark, "out"), T.StructType.fromDDL("id int, n int, v string")
    write = jobs.upsert_batches(target, ["id"], ["n"])
    for b in range(4):
        write(spark.createDataFrame([(i, 1, f"batch {b}") for i in range(40)], schema), b)
    assert {r.v for r in jobs.read_current(spark, target, schema).collect()} == {"batch 3"}


def contents(spark, target, schema):
    return {(r.id, r.v) for r in jobs.read_current(spark, target, schema).collect()}


def test_a_batch_rewrites_only_its_buckets(spark):
    target, schema = scratch(spark, "out"), T.StructType.fromDDL("id int, n int, v string")
    write = jobs.upsert_batches(target, ["id"], ["n"])
    write(spark.createDataFrame([(i, 1, "a") for i in range(500)], schema), 0)
    write(spark.createDataFrame([(7, 2, "b")], schema), 1)
    written = jobs._stored(spark, target, schema).groupBy("_batch").agg(
        F.count_distinct("_bucket").alias("n")).collect()
    assert {r._batch: r.n for r in written} == {0: jobs.BUCKETS - 1, 1: 1}
    for b in range(2, 6):
        write(spark.createDataFrame([(7, b, "c")], schema), b)
    write(spark.createDataFrame([], schema), 6)
    assert {r.v: r["count"] for r in jobs.read_current(spark, target, schema).groupBy("v").count().collect()} == {"a": 499, "c": 1}


def test_a_batch_lost_in_the_swap_is_swapped_from_staging(spark):
    target, schema = scratch(spark, "out"), T.StructType.fromDDL("id int, n int, v string")
    write = jobs.upsert_batches(target, ["id"], ["n"])
    write(spark.createDataFrame([(i, 1, "a") for i in range(300)], schema), 0)
    second = spark.createDataFrame([(i, 2, "b") for i in range(0, 300, 3)], schema)
    write(second, 1)
    want = contents(spark, target, schema)
    for part in sorted(os.listdir(target))[:9]:
        if part.startswith("_bucket="):
            shutil.rmtree(f"{target}/{part}")
    assert contents(spark, target, schema) != want
    write(second, 1)
    assert contents(spark, target, schema) == want
    # staged but not finished: the target is untouched, the batch is folded anew
    third = spark.createDataFrame([(1, 3, "c")], schema)
    write(third, 2)
    os.remove(f"{target}-staging/_SUCCESS")
    write(third, 2)
    assert contents(spark, target, schema) == (want - {(1, "a")}) | {(1, "c")}


def test_staging_of_another_run_is_not_taken(spark):
    target, schema = scratch(spark, "out"), T.StructType.fromDDL("id int, n int, v string")
    marks = [scratch(spark, "mark") for _ in range(2)]
    for n, mark in enumerate(marks):
        spark.createDataFrame([(f"run {n}",)], "value string").write.text(f"{mark}/metadata")
        jobs.upsert_batches(target, ["id"], ["n"], mark)(spark.createDataFrame([(n, 1, "x")], schema), 0)
    assert contents(spark, target, schema) == {(0, "x"), (1, "x")}


def test_milestones_stream_follows_late_events(spark):
    """Events in any order over several batches, one shipment with most of them, equal the batch job."""
    rnd = random.Random(5)
    codes = ["PU", "DP", "IT", "IT", "AR", "OD", "DL", "EX"]
    rows = []
    for n in range(600):
        s = "hot" if n % 3 else f"s{n % 20}"
        rows.append((s, None if n % 97 == 0 and s != "hot" else n, rnd.choice(codes),
                     None if n % 13 == 0 else dt.date(2024, 1, 1) + dt.timedelta(days=n // 4 + rnd.randrange(-4, 5)), None))
    # one event without a place in the sequence a shipment: among several the order is open
    seen = set()
    rows = [r for r in rows if r[1] is not None or not (r[0] in seen or seen.add(r[0]))]
    schema = T.StructType.fromDDL("shipment_id string, event_sequence bigint, event_code string, event_at date, event_location string")
    folder, target, mark = (scratch(spark, n) for n in ("in", "miles", "mark"))
    names = ["shipment_id", *events.MILESTONES.values(), "event_count", "had_exception", "out_of_sequence_event_count",
             "has_out_of_sequence_events"]
    rnd.shuffle(rows)
    for at in range(0, len(rows), 150):
        spark.createDataFrame(rows[at:at + 150], schema).coalesce(2).write.mode("append").parquet(folder)
        jobs.stream_milestones(jobs.file_stream(spark, folder, schema), target, mark, lambda s: F.floor(s / 40))
        want = events.milestones(spark.createDataFrame(rows[:at + 150], schema))
        got = jobs.read_milestones(spark, target, schema)
        assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, want.select(*names).collect()))
    # a lost checkpoint reads all events again and ends at the same rows
    jobs.stream_milestones(jobs.file_stream(spark, folder, schema), target, scratch(spark, "mark"), lambda s: F.floor(s / 40))
    assert sorted(map(str, jobs.read_milestones(spark, target, schema).select(*names).collect())) == sorted(
        map(str, want.select(*names).collect()))


class Conf(dict):
    @property
    def conf(self):
        return self


def test_scratch_follows_the_session():
    asked = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/x/"})
    assert shared_dir(asked) == "hdfs:///shared/x"
    assert scratch(asked, "in").startswith("hdfs:///shared/x/in-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Conf({"spark.master": "yarn"}))
