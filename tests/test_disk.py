"""What large jobs leave on the disks while they run."""

import datetime as dt
import time
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F
from small import SMALL

from procmetrics.functions.joins import stored
from procmetrics.operators import match, quality
from procmetrics.plans.catalog import load
from procmetrics.plans.marts import shipped_metrics
from procmetrics.plans.metrics import Catalog
from procmetrics.session import DROP_SHUFFLES


def shuffled(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(",").split(",") if b.startswith("shuffle_")}


def left_behind(spark, before: set[str]) -> set[str]:
    for _ in range(50):
        if not (left := shuffled(spark) - before):
            break
        time.sleep(0.1)
    return left


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_leave_no_shuffle(spark):
    from procmetrics.llm.common import store

    own = spark.conf.get(DROP_SHUFFLES)
    for write in (stored, store):
        before = shuffled(spark)
        rows = write(spark.range(2000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test")
        assert not left_behind(spark, before)
        assert sorted(map(tuple, rows.collect())) == sorted(Counter(i % 7 for i in range(2000)).items())
    assert spark.conf.get(DROP_SHUFFLES) == own


def facts(spark):
    n = F.col("id")
    rows = spark.range(60).repartition(3).select(
        n.alias("shipment_id"), n.alias("invoice_number"), (n % 3 == 0).alias("has_order_reference"),
        F.when(n % 7 != 0, n % 4 == 0).alias("is_unsettled"),
        *[F.when(n % 5 != 0, n % 4).cast("int" if "date" in c else "string").alias(c) for c in (
            "ship_date_key", "invoice_date_key", "customer_key", "site_code", "carrier_scac", "item_code")])
    return lambda name, need: rows.select(*sorted(need))


def test_passes_of_several_facts_run_one_after_the_other(spark):
    wanted = ["order_reference_coverage_rate", "unsettled_invoice_rate"]
    metrics = {k: v for k, v in shipped_metrics().items() if k in wanted}
    catalog = Catalog(facts(spark), metrics)
    before = shuffled(spark)
    out = quality.metric_parity(catalog), catalog.totals(wanted), catalog.rows(wanted)
    assert not left_behind(spark, before)
    assert "Exchange" not in plan(out[1]) and "Exchange" not in plan(out[2])
    got = {r.metric_name: r for r in out[0].collect()}
    assert set(got) == set(wanted) and all(r.passes and r.agrees for r in got.values())
    assert abs(float(got["order_reference_coverage_rate"].from_fact) - 20 / 60) < 1e-6
    known = [i for i in range(60) if i % 7]
    values = {r.metric_name: float(r.metric_value) for r in out[1].collect()}
    assert values["order_reference_coverage_rate"] == float(got["order_reference_coverage_rate"].from_fact)
    assert abs(values["unsettled_invoice_rate"] - sum(i % 4 == 0 for i in known) / 60) < 1e-6


def test_marts_are_counted_one_after_the_other(spark):
    assert "Exchange" not in plan(load()[0]["mart_all"](spark, SMALL))


def test_three_way_match_deals_its_sides_by_the_po_line_once(spark):
    day = dt.date(2020, 1, 1)
    d = Decimal
    invoices = [("I1", 1, "P1", 1, "R1", d(2), d(5)), ("I1", 2, "P1", 1, "R2", d(3), d(5)), ("I2", 1, "P1", 1, None, d(1), d(9)),
                ("I2", 2, None, 1, "R1", d(1), d(1)), ("I2", 3, "P9", 1, "R9", d(1), d(1)), ("I3", 1, "P2", 1, "R3", d(4), d(7)),
                ("I9", 1, "P1", 1, "R1", d(2), d(5)), (None, 1, "P1", 1, "R1", d(2), d(5)), ("I1", 1, "P1", 1, "R1", d(2), d(5)),
                ("I1", 4, "P3", 1, "R4", d(1), d(1)), ("I1", 5, "P1", None, "R1", d(1), d(1))]
    heads = [("I1", "V1", day, day, "USD", 1), ("I2", "V2", day, None, "USD", 1), ("I3", None, day, day, "USD", 1), (None, "V", day, day, "X", 1)]
    pos = [("P1", 1, d(5), d(5)), ("P2", 1, d(4), d(7)), ("P2", 1, d(6), d(8)), (None, 1, d(1), d(1)), ("P4", 1, d(1), d(1))]
    receipts = [("R1", "P1", 1, d(1), day), ("R1", "P1", 1, d(1), day), ("R2", "P1", 1, d(3), day), (None, "P1", 1, d(7), day),
                ("R3", "P2", 1, d(9), day), ("R4", "P3", 1, d(1), day), ("R1", None, 1, d(5), day), ("R1", "P1", None, d(5), day)]
    key = "purchase_order_number string, purchase_order_line_number long"
    money = "decimal(18,4)"
    sides = [spark.createDataFrame(rows, schema) for rows, schema in (
        (invoices, f"supplier_invoice_number string, supplier_invoice_line_number long, {key}, receipt_number string, "
                   f"invoiced_qty {money}, invoiced_unit_price {money}"),
        (heads, "supplier_invoice_number string, supplier_code string, invoice_date date, accounting_date date, "
                "currency_code string, invoice_status_code long"),
        (pos, f"{key}, ordered_qty {money}, net_unit_price {money}"),
        (receipts, f"receipt_number string, {key}, received_qty {money}, receipt_date date"))]
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = match.three_way_match(*sides)
        # invoice lines twice, headers, PO lines, receipts for each of their two folds, what PO lines and receipts give
        assert plan(out).count("Exchange ") <= 7
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    want = Counter()
    for i, line, po, no, receipt, *_ in invoices:
        for h in (x for x in heads if x[0] == i and i is not None):
            named = [x[3] for x in receipts if x[:3] == (receipt, po, no) and None not in x[:3]]
            total = [x for x in receipts if x[1:3] == (po, no) and None not in x[1:3]]
            for p in [x for x in pos if x[:2] == (po, no) and None not in x[:2]] or [(None,) * 4]:
                want[(i, line, po, no, receipt, h[1], p[2], sum(named) if named else None, sum(x[3] for x in total) if total else None,
                      len({x[0] for x in total if x[0]}) if total else None)] += 1
    assert Counter((r.supplier_invoice_number, r.supplier_invoice_line_number, r.purchase_order_number, r.purchase_order_line_number,
                    r.receipt_number, r.supplier_code, r.ordered_qty, r.received_qty, r.total_received_qty, r.receipt_count)
                   for r in got) == want
