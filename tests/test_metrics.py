import datetime as dt

import pytest
from pyspark.sql import functions as F

from procmetrics.operators import dims, quality
from procmetrics.plans import marts, metrics
from procmetrics.plans.metrics import Filter, Metric, MetricError, Side


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(f"s{n}", 20240101 + n % 3, f"c{n % 2}", "A" if n % 4 else "UNKNOWN", "v",
             None if n % 5 == 0 else n % 3 == 0, float(n), None if n % 7 == 0 else f"o{n // 2}",
             n % 7 != 0) for n in range(40)]
    return spark.createDataFrame(
        rows, "shipment_id string, ship_date_key int, customer_key string, site_code string, "
        "carrier_scac string, is_on_time_vs_carrier_promise boolean, shipment_cost_usd double, "
        "sales_order_number string, has_order_reference boolean")


SHIPPED = marts.shipped_metrics()


def test_the_shipped_definitions_are_sound(spark):
    assert len(SHIPPED) == 10
    for m in SHIPPED.values():
        metrics.check(m)
    assert [m.name for m in SHIPPED.values() if not metrics.is_reaggregatable(m)] == ["cost_per_order"]
    assert len(metrics.relationships()) == 22


@pytest.mark.parametrize("by", [[], ["site_code"], ["date_key", "customer_key"]])
def test_rollup_equals_the_fact(fact, by):
    m = SHIPPED["on_time_delivery_rate"]
    up = metrics.rollup(m, metrics.evaluate(m, fact), by)
    keyed = fact.withColumn("date_key", F.col("ship_date_key"))
    want = metrics.direct(m, keyed, by)
    assert up.exceptAll(want).isEmpty() and want.exceptAll(up).isEmpty()


def test_distinct_counts_do_not_roll_up(fact):
    m = SHIPPED["cost_per_order"]
    with pytest.raises(MetricError, match="does not re-aggregate"):
        metrics.rollup(m, metrics.evaluate(m, fact), ["site_code"])


def test_one_pass_equals_one_by_one(fact):
    group = [SHIPPED[n] for n in ("on_time_delivery_rate", "cost_per_shipment",
                                  "order_reference_coverage_rate")]
    rows = metrics.together(group, fact)
    for m in group:
        a = rows.where(F.col("metric_name") == m.name).select("date_key", "site_code", "metric_value")
        b = metrics.evaluate(m, fact).select("date_key", "site_code", "metric_value")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    m = SHIPPED["cost_per_order"]
    a = metrics.together([m], fact).select("date_key", "site_code", "metric_value")
    b = metrics.evaluate(m, fact).select("date_key", "site_code", "metric_value")
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


@pytest.mark.parametrize("op, value, n", [
    ("is_true", None, 2), ("is_false", None, 1), ("is_null", None, 1), ("is_not_null", None, 3)])
def test_boolean_filters(spark, op, value, n):
    df = spark.createDataFrame([(True,), (True,), (False,), (None,)], "b boolean")
    assert df.where(Filter("b", op, value).to_column()).count() == n


@pytest.mark.parametrize("op, value, want", [
    ("eq", 2, {2}), ("ne", 2, {1, 3}), ("gt", 1, {2, 3}), ("gte", 2, {2, 3}), ("lt", 2, {1}),
    ("lte", 2, {1, 2}), ("in", [1, 3], {1, 3})])
def test_valued_filters(spark, op, value, want):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "n int")
    assert {r.n for r in df.where(Filter("n", op, value).to_column()).collect()} == want


def test_a_valued_filter_on_a_distinct_count(fact, spark):
    m = Metric("orders_a", "x", "active", "fct_shipment", "g",
               Side("count_distinct", "sales_order_number", Filter("site_code", "eq", "A")),
               Side("count_distinct", "sales_order_number"), ("site",))
    dim = spark.createDataFrame([("A", "Alpha"), ("UNKNOWN", "Unresolved")],
                                "site_code string, site_name string")
    got = {r["site_site_name"]: r.numerator for r in metrics.ask(
        m, fact, {"dim_site": dim}, by=["site.site_name"]).collect()}
    assert got["Alpha"] > 0 and got["Unresolved"] == 0


def test_questions_outside_the_definition_are_refused(fact):
    m = SHIPPED["on_time_delivery_rate"]
    for spec, why in (("moon.phase", "not a conformed dimension"), ("item.item_status", "cannot be"),
                      ("site.zip", "not an attribute")):
        with pytest.raises(MetricError, match=why):
            metrics.ask(m, fact, {}, by=[spec])


@pytest.mark.parametrize("text, n", [("2024", 366), ("2024-Q1", 91), ("2024q4", 92), ("2024-02", 29),
                                     ("202402", 29)])
def test_periods(spark, text, n):
    cal = dims.dim_date(spark, as_of=dt.date(2025, 1, 1))
    assert cal.where(metrics.period(text)).count() == n


@pytest.mark.parametrize("text", ["24", "2024-Q5", "2024-13", "soon"])
def test_bad_periods(text):
    with pytest.raises(MetricError):
        metrics.period(text)


def test_calendar(spark):
    cal = dims.dim_date(spark, as_of=dt.date(2025, 1, 1))
    assert cal.count() == 1461
    r = cal.where("date_key = 20240901").first()
    assert (r.calendar_month_name, r.day_name, r.day_of_week, r.is_weekend, r.iso_week) == (
        "September", "Sunday", 0, True, 35)
    assert cal.where("is_past_as_of_build").count() == 367


def test_blocked_metric_shows_a_reason_and_no_number(spark, fact):
    blocked = Metric("x_rate", "X", "blocked", "fct_shipment", "g", None, None,
                     blocked_reason="no source")
    metrics.check(blocked)
    with pytest.raises(MetricError, match="blocked"):
        metrics.evaluate(blocked, fact)
    live = SHIPPED["cost_per_shipment"]
    both = {"x_rate": blocked, live.name: live}
    slots = [("P2C", "x_rate", "M1", 1), ("P2C", live.name, "M2", 2)]
    cat = metrics.Catalog(lambda name, need: fact, both)
    got = marts.process_mart(spark, "P2C", slots, both, cat.rows)
    lost = got.where("metric_name = 'x_rate'").collect()
    assert len(lost) == 1 and lost[0].blocked_reason == "no source" and lost[0].numerator is None
    assert got.where("metric_name = 'cost_per_shipment'").count() > 1
    empty = marts.process_mart(spark, "F2P", slots, both, cat.rows)
    assert empty.count() == 0 and empty.dtypes == got.dtypes
    with pytest.raises(MetricError, match="no logic"):
        metrics.check(Metric("y", "Y", "blocked", "fct_shipment", "g", live.numerator, None,
                             blocked_reason="r"))
    reg = metrics.registry_df(spark, both)
    assert quality.blocked_with_logic(reg).count() == 0


def test_another_date_role(fact):
    m = SHIPPED["on_time_delivery_rate"]
    with pytest.raises(MetricError, match="offers no date key"):
        metrics.evaluate(m, fact, date_key="paid_date_key")


def test_definitions_load_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "m.yml").write_text(
        "name: m\nlabel: M\nstatus: active\nbase_model: fct_shipment\n"
        "numerator: {agg: sum, column: a}\ndenominator: {agg: count, column: b}\ndimensions: [site]\n")
    m = metrics.load_metrics(tmp_path)["m"]
    assert m.numerator.agg == "sum" and m.dimensions == ("site",)


def test_unknown_parts_of_a_definition_are_refused(fact):
    ok = dict(name="m", label="M", status="active", base="fct_shipment", grain="g")
    side = Side("count", "shipment_id")
    for m in (Metric(**ok, numerator=Side("mode", "shipment_id"), denominator=side),
              Metric(**ok, numerator=side, denominator=Side("count", "nope")),
              Metric(**ok, numerator=side, denominator=side, dimensions=("item",)),
              Metric(**ok, numerator=side, denominator=side, filters=(Filter("site_code", "like"),)),
              Metric(**{**ok, "base": "fct_moon"}, numerator=side, denominator=side)):
        with pytest.raises(MetricError):
            metrics.check(m, fact)


def test_severity(spark):
    df = spark.createDataFrame([(0,), (5,), (50,)], "n bigint")
    got = [r.s for r in df.select(
        quality.status(F.col("n"), "error", ">0", ">10").alias("s")).collect()]
    assert got == ["pass", "warn", "error"]
    got = [r.s for r in df.select(quality.status(F.col("n"), "warn").alias("s")).collect()]
    assert got == ["pass", "warn", "warn"]


def test_a_question_folds_the_days_of_its_period_to_the_keys_asked_for(spark, fact, monkeypatch):
    """Metric rows at the declared dimensions give the same answer."""
    days = spark.createDataFrame([(20240101, 2024, 1, 1, "a"), (20240102, 2023, 1, 1, "b"), (20240103, 2024, 1, 1, "c"), (None, 2024, 1, 1, "d")],
                                 "date_key int, calendar_year int, calendar_quarter int, calendar_month int, calendar_month_label string")
    seen = []

    def spy(m, f, date_key=None, real=metrics.evaluate):
        seen.append((m.dimensions, f.count()))
        return real(m, f, date_key)

    m = SHIPPED["on_time_delivery_rate"]
    rows = metrics.evaluate(m, fact)
    monkeypatch.setattr(metrics, "evaluate", spy)
    want = metrics.ask(m, fact, {"dim_date": days}, by=["date.calendar_month_label"], period_text="2024", rows=rows)
    got = metrics.ask(m, fact, {"dim_date": days}, by=["date.calendar_month_label"], period_text="2024")
    inside = fact.where("ship_date_key in (20240101, 20240103)").count()
    assert seen == [(("date",), inside)] and inside < fact.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == 2
