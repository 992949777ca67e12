"""The ten metrics, roll-up, questions, scorecards and process marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import stored
from ..operators import facts, profile
from ..sources.publish import load_seed
from . import marts
from .metrics import (BINDINGS, DIMENSIONS, Filter, Metric, Side, columns_of, direct, evaluate,
                      registry_df, rollup)
from .models import Models
from .registry import query

METRICS = marts.shipped_metrics()

# fixed values: SQL name of each base
BASES = {"fct_shipment": "f_ship", "fct_sales_order_line": "f_order",
         "fct_invoice_line": "f_invoice", "fct_supplier_invoice_line": "f_ap",
         "fct_inventory_count_line": "f_count", "dim_customer": "d_customer"}

# numerator, denominator and row filter of each metric as written in SQL
SIDES = {
    "cost_per_order": ("sum(shipment_cost_usd)", "count(distinct sales_order_number)",
                       "has_order_reference"),
    "cost_per_shipment": ("sum(shipment_cost_usd)", "count(shipment_id)", None),
    "customer_unmatched_rate": (
        "sum(crm_company_count) filter (where source_scope = 'crm_only')",
        "sum(crm_company_count)", None),
    "dso_days_to_pay_proxy": ("sum(days_to_pay_settled_only)", "count(days_to_pay_settled_only)",
                              None),
    "inventory_accuracy": (
        "count(count_line_number) filter (where is_accurate_position)",
        "count(count_line_number) filter (where is_accurate_position is not null)", None),
    "match_rate": (
        "count(supplier_invoice_line_number) filter (where is_three_way_matched)",
        "count(supplier_invoice_line_number) filter (where is_three_way_matched is not null)",
        None),
    "on_time_delivery_rate": (
        "count(shipment_id) filter (where is_on_time_vs_carrier_promise)",
        "count(shipment_id) filter (where is_on_time_vs_carrier_promise is not null)", None),
    "order_reference_coverage_rate": ("count(shipment_id) filter (where has_order_reference)",
                                      "count(shipment_id)", None),
    "return_rate": ("sum(returned_amount_usd)", "sum(invoiced_amount_usd)", None),
    "unsettled_invoice_rate": ("count(invoice_number) filter (where is_unsettled)",
                               "count(invoice_number)", None),
}


def metric_sql(name: str, keys: dict[str, str] | None = None, where: str | None = None) -> str:
    """The metric rows as SQL; ``keys`` maps output key to fact column."""
    m = METRICS[name]
    if keys is None:
        keys = {DIMENSIONS[d].key: BINDINGS[m.base][d] for d in m.dimensions}
    num, den, own = SIDES[name]
    conds = [c for c in (own, where) if c]
    cols = "".join(f"{c} as {k}, " for k, c in keys.items())
    outs = "".join(f"{k}, " for k in keys)
    group = f"group by {', '.join(str(n + 1) for n in range(len(keys)))}" if keys else ""
    return f"""
select {outs}numerator, denominator,
  cast(numerator as double) / nullif(cast(denominator as double), 0) as metric_value,
  '{name}' as metric_name, '{m.status}' as metric_status
from (select {cols}{num} as numerator, {den} as denominator from {BASES[m.base]}
      {'where ' + ' and '.join(conds) if conds else ''} {group})"""


def _metric_query(key: str, name: str):
    # this fact reads the order lines many times
    many = METRICS[name].base == "fct_sales_order_line"

    @query(key, metric_sql(name), store_lines=many)
    def run(i):
        return Models(i).catalog().metric(name)

    return run


# fixed values: query key of each metric
METRIC_KEYS = {
    "mtr_on_time": "on_time_delivery_rate",
    "mtr_cost_per_order": "cost_per_order",
    "mtr_cost_per_shipment": "cost_per_shipment",
    "mtr_customer_unmatched": "customer_unmatched_rate",
    "mtr_dso_proxy": "dso_days_to_pay_proxy",
    "mtr_inventory_accuracy": "inventory_accuracy",
    "mtr_match_rate": "match_rate",
    "mtr_order_coverage": "order_reference_coverage_rate",
    "mtr_return_rate": "return_rate",
    "mtr_unsettled_rate": "unsettled_invoice_rate",
}
for _key, _name in METRIC_KEYS.items():
    _metric_query(_key, _name)


# the two worked additions: a metric on an existing column, and one that first
# needs a null-aware flag on the fact

CANCELLED = Metric(
    "order_cancellation_rate", "Order Line Cancellation Rate", "active", "fct_sales_order_line",
    "One sales order line.",
    Side("count", "sales_order_line_number", Filter("order_status", "eq", "P")),
    Side("count", "sales_order_line_number"), ("date", "customer", "site", "item"),
    format="percent", direction="lower_is_better")

BY_REQUEST = Metric(
    "shipped_by_request_date_rate", "Shipped by Requested Date", "active",
    "fct_sales_order_line", "One shipped sales order line.",
    Side("count", "sales_order_line_number", Filter("is_shipped_by_request_date", "is_true")),
    Side("count", "sales_order_line_number", Filter("is_shipped_by_request_date", "is_not_null")),
    ("date", "customer", "site", "item"), format="percent")


@query("mtr_order_cancellation", """
select site_code, numerator, denominator, cast(numerator as double) / denominator as metric_value,
  'order_cancellation_rate' as metric_name, 'active' as metric_status
from (select site_code, count(*) filter (where order_status = 'P') as numerator,
        count(*) as denominator from f_order group by 1)""")
def mtr_order_cancellation(i):
    rows = evaluate(CANCELLED, Models(i).model("fct_sales_order_line", columns_of(CANCELLED)))
    return rollup(CANCELLED, rows, ["site_code"])


@query("mtr_shipped_by_request", """
select site_code, numerator, denominator, cast(numerator as double) / nullif(denominator, 0)
    as metric_value, 'shipped_by_request_date_rate' as metric_name, 'active' as metric_status
from (select site_code,
        count(*) filter (where shipment_date <= requested_delivery_date) as numerator,
        count(*) filter (where shipment_date is not null and requested_delivery_date is not null)
          as denominator from f_order group by 1)""")
def mtr_shipped_by_request(i):
    need = {"shipment_date", "requested_delivery_date", "sales_order_line_number", "site_code"}
    fact = facts.with_shipped_by_request(Models(i).model("fct_sales_order_line", need))
    return direct(BY_REQUEST, fact, ["site_code"])


# ------------------------------------------------------------- roll-up and ask


@query("rollup_site", metric_sql("on_time_delivery_rate", {"site_code": "site_code"}))
def rollup_site(i):
    """On-time delivery folded from its metric rows to the site."""
    m = METRICS["on_time_delivery_rate"]
    return rollup(m, Models(i).catalog().metric(m.name), ["site_code"])


ASK = """
select {labels}, {num} as numerator, {den} as denominator,
  cast({num} as double) / nullif(cast({den} as double), 0) as value
from {base} m {joins}
where {where} group by all"""


def ask_sql(name, labels, joins, where="true"):
    num, den, own = SIDES[name]
    return ASK.format(labels=labels, num=num, den=den, base=BASES[METRICS[name].base],
                      joins=joins, where=f"{own} and {where}" if own else where)


SITE = "join d_site site on site.site_code = m.site_code"


@query("mtr_on_time_by_nation", ask_sql(
    "on_time_delivery_rate", "site.site_name as site_site_name",
    "join d_site site on site.site_code = m.site_code"))
def mtr_on_time_by_nation(i):
    """The flagship question: on-time delivery by the shipping nation."""
    return Models(i).catalog().ask("on_time_delivery_rate", by=["site.site_name"])


@query("ask_period", ask_sql(
    "on_time_delivery_rate", "carrier.transport_mode as carrier_transport_mode",
    f"{SITE} join d_date on d_date.date_key = m.ship_date_key "
    "join d_carrier carrier on carrier.carrier_scac = m.carrier_scac",
    "calendar_year = 1997 and calendar_quarter = 2 and site.company_name = 'ASIA'"))
def ask_period(i):
    """A quarter, one company, by transport mode; read off the metric rows."""
    return Models(i).catalog().ask(
        "on_time_delivery_rate", by=["carrier.transport_mode"],
        where={"site.company_name": "ASIA"}, period_text="1997-Q2")


@query("ask_not_additive", ask_sql(
    "cost_per_order", "site.company_name as site_company_name",
    f"{SITE} join d_date on d_date.date_key = m.ship_date_key", "calendar_year = 1999"))
def ask_not_additive(i):
    """A distinct count does not add up, so this one is computed on the fact."""
    return Models(i).catalog().ask("cost_per_order", by=["site.company_name"], period_text="1999")


@query("ask_month_item", ask_sql(
    "return_rate", "d_item.best_abc_class as item_best_abc_class, "
    "d_date.calendar_month_label as date_calendar_month_label",
    "join d_item on d_item.item_code = m.item_code "
    "join d_date on d_date.date_key = m.order_date_key", "calendar_year = 1996"), store_lines=True)
def ask_month_item(i):
    return Models(i).catalog().ask(
        "return_rate", by=["item.best_abc_class", "date.calendar_month_label"],
        period_text="1996")


def score_sql(label, joins, alias):
    parts = []
    for name, out in (("on_time_delivery_rate", "on_time"), ("cost_per_shipment", "cost")):
        num, den, _ = SIDES[name]
        parts.append(f"cast({num} as double) / nullif(cast({den} as double), 0) as {out}")
    return f"select {label} as {alias}, {', '.join(parts)} from f_ship m {joins} group by 1"


def _scorecard(i, label):
    c = Models(i).catalog()
    return profile.scorecard(
        c.ask("on_time_delivery_rate", by=[label]), c.ask("cost_per_shipment", by=[label]),
        [label.replace(".", "_")], "on_time", "cost")


@query("scorecard_carrier", score_sql(
    "carrier_name", "join d_carrier using (carrier_scac)", "carrier_carrier_name"))
def scorecard_carrier(i):
    """On-time and cost side by side per carrier."""
    return _scorecard(i, "carrier.carrier_name")


@query("scorecard_quarter", score_sql(
    "fiscal_quarter_label", "join d_date on date_key = ship_date_key",
    "date_fiscal_quarter_label"))
def scorecard_quarter(i):
    return _scorecard(i, "date.fiscal_quarter_label")


@query("role_date", metric_sql("on_time_delivery_rate", {
    "date_key": "delivered_date_key", "customer_key": "customer_key", "site_code": "site_code",
    "carrier_scac": "carrier_scac"}))
def role_date(i):
    """On-time delivery dated on the delivery instead of the shipping day."""
    return Models(i).catalog().metric("on_time_delivery_rate", date_key="delivered_date_key")


@query("role_date_paid", metric_sql("dso_days_to_pay_proxy", {
    "date_key": "payment_date_key", "customer_key": "customer_key", "site_code": "site_code",
    "item_code": "item_code"}))
def role_date_paid(i):
    return Models(i).catalog().metric("dso_days_to_pay_proxy", date_key="payment_date_key")


# ------------------------------------------------------------- marts

PROCESSES = ("P2C", "O2C", "S2P", "F2P", "I2D", "R2P", "H2R", "I2S", "M2O")
SLOTS = (("O2C", "dso_days_to_pay_proxy", "M1", 1), ("O2C", "return_rate", "M2", 2),
         ("O2C", "cost_per_order", "M3", 3), ("S2P", "match_rate", "M1", 1),
         ("I2D", "inventory_accuracy", "M1", 1), ("I2D", "on_time_delivery_rate", "M2", 2),
         ("I2D", "cost_per_shipment", "M3", 3))
MART_KEYS = (("date_key", "int"), ("customer_key", "varchar"), ("site_code", "varchar"),
             ("item_code", "varchar"), ("carrier_scac", "varchar"))


def mart_sql(*processes: str) -> str:
    blocks = []
    for process, name, slot, order in SLOTS:
        if process not in processes:
            continue
        m = METRICS[name]
        own = {DIMENSIONS[d].key for d in m.dimensions}
        keys = ", ".join(f"{k if k in own else f'cast(null as {t})'} as {k}" for k, t in MART_KEYS)
        vals = ", ".join(f"cast({v} as decimal(38,6)) as {v}"
                         for v in ("numerator", "denominator", "metric_value"))
        blocks.append(f"""
select '{process}' as process_code, '{slot}' as slot, {order} as display_order,
  '{name}' as metric_name, '{m.label}' as metric_label, '{m.status}' as metric_status,
  '{m.format}' as metric_format, '{m.direction}' as metric_direction, {keys}, {vals},
  cast(null as varchar) as blocked_reason
from ({metric_sql(name)})""")
    return "\nunion all\n".join(blocks)


def _mart(i, *processes):
    slots = marts.slots_of(load_seed(i.spark, "process_metric_map"))
    rows_of = Models(i).catalog().rows
    out = None
    for p in processes:
        one = marts.process_mart(i.spark, p, slots, METRICS, rows_of)
        out = one if out is None else out.unionByName(one)
    return out


@query("mart_i2d", mart_sql("I2D"), store_folds=True)
def mart_i2d(i):
    return _mart(i, "I2D")


@query("mart_o2c", mart_sql("O2C"), store_lines=True)
def mart_o2c(i):
    return _mart(i, "O2C")


@query("mart_s2p", mart_sql("S2P"))
def mart_s2p(i):
    return _mart(i, "S2P")


@query("mart_all", f"""
select process_code, metric_name, count(*) as metric_rows from ({mart_sql(*PROCESSES)})
group by 1, 2""", store_lines=True)
def mart_all(i):
    """All nine processes; six of them are empty typed frames and add no rows.

    A process has its own metrics, so the marts are counted one after the other, and the shuffles of one are gone
    from the disks before the next one starts.
    """
    codes = [r.process_code for r in load_seed(i.spark, "process").collect()]
    counted = [stored(_mart(i, c).groupBy("process_code", "metric_name").agg(
        F.count(F.lit(1)).alias("metric_rows")), "mart-counts") for c in codes]
    return reduce(DataFrame.unionByName, counted)


#: The definitions as DuckDB reads them: an account of the registry that shares no code with the library.
REGISTRY_SQL = f"""
select name as metric_name, label as metric_label, status, coalesce(is_data_quality, false) as is_data_quality,
  base_model, grain, coalesce(owner, 'TBD') as owner, coalesce(owner_proposed, '') as owner_proposed, format, direction,
  status <> 'blocked' and numerator->>'agg' in ('sum', 'count') and denominator->>'agg' in ('sum', 'count')
    as is_reaggregatable,
  case when status <> 'blocked' then 'mtr_' || name end as sql_model, description, blocked_reason
from read_json('{marts.DEFINITIONS}/*.json', columns = {{name: 'varchar', label: 'varchar', status: 'varchar',
  is_data_quality: 'boolean', base_model: 'varchar', grain: 'varchar', owner: 'varchar', owner_proposed: 'varchar',
  format: 'varchar', direction: 'varchar', numerator: 'json', denominator: 'json', description: 'varchar',
  blocked_reason: 'varchar'}})"""


@query("registry_totals", f"select r.*, t.metric_value from ({REGISTRY_SQL}) r join (" + " union all ".join(
    f"select '{n}' as metric_name, metric_value from ({metric_sql(n, {})})" for n in sorted(METRICS))
    + ") t using (metric_name)", store_lines=True)
def registry_totals(i):
    """The whole registry with each metric's overall value beside it."""
    values = Models(i).catalog().totals(list(METRICS)).select("metric_name", "metric_value")
    return registry_df(i.spark, METRICS).join(values, "metric_name")
