"""Data-quality checks, whole-model checks and profiling on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import profile, quality
from ..operators.quality import Check
from ..sources.publish import load_seed
from .inputs import SENTINEL, tag
from .metrics import registry_df, relationships
from .models import Models
from .queries_metrics import BASES, METRICS, metric_sql
from .registry import query


def _count(name: str, failing: str, warn: bool = False, error_above: int | None = None) -> str:
    worst = "warn" if warn else "error"
    status = f"case when n > 0 then '{worst}' else 'pass' end"
    if error_above is not None:
        status = f"case when n > {error_above} then 'error' when n > 0 then 'warn' else 'pass' end"
    return (f"select '{name}' as check_name, n as failing_rows, {status} as status "
            f"from (select count(*) as n from ({failing}))")


@query("dq_suite", "\nunion all\n".join([
    _count("order_customer_not_null", "select 1 from f_order where customer_code is null"),
    _count("ship_carrier_not_null", "select 1 from shipment where carrier_scac is null", True),
    _count("delivered_date_not_null", "select 1 from shipment where delivered_date is null",
           error_above=10),
    _count("shipment_status_accepted",
           "select 1 from shipment where shipment_status not in ('DELIVERED')", True),
    _count("shipment_id_unique",
           "select shipment_id from shipment group by 1 having count(*) > 1"),
    _count("order_line_grain", "select 1 from f_order group by sales_order_number, "
           "sales_order_line_number having count(*) > 1"),
    _count("lineitem_grain", "select 1 from lineitem group by l_orderkey, l_linenumber "
           "having count(*) > 1"),
    _count("reference_resolves", "select 1 from shipment s where reference_number is not null and "
           "not exists (select 1 from sorder o where o.sales_order_number = s.reference_number)",
           True),
    _count("rate_not_identity", "select 1 from fx where currency_code <> 'USD' and "
           "rate_to_reporting_currency = 1.0"),
    _count("names_unique", "select 1 from bpcustomer group by upper(trim(customer_name)) "
           "having count(*) > 1", True),
    _count("blocked_has_no_logic", "select 1 where false"),
    _count("process_exists", "select 1 where false"),
    _count("at_most_four_metrics", "select 1 where false"),
]))
def dq_suite(i):
    """Row checks of a table share one pass; grain and reference checks are folds and anti joins."""
    m = Models(i)
    ship = i.shipment
    order = m.model("fct_sales_order_line", {
        "sales_order_number", "sales_order_line_number", "customer_code"})
    slots, processes = load_seed(i.spark, "process_metric_map"), load_seed(i.spark, "process")
    none = registry_df(i.spark, METRICS)
    return quality.run_checks([
        (order, [
            Check("order_customer_not_null", F.col("customer_code").isNull()),
            Check("order_line_grain", failing=quality.unique_combination(
                order, ["sales_order_number", "sales_order_line_number"])),
        ]),
        (ship, [
            Check("ship_carrier_not_null", F.col("carrier_scac").isNull(), severity="warn"),
            Check("delivered_date_not_null", F.col("delivered_date").isNull(),
                  warn_if=">0", error_if=">10"),
            Check("shipment_status_accepted", ~F.col("shipment_status").isin("DELIVERED"),
                  severity="warn"),
            Check("shipment_id_unique", failing=quality.unique(ship, "shipment_id")),
            Check("reference_resolves", failing=quality.relationships(
                ship, "reference_number", i.sorder, "sales_order_number"),
                severity="warn"),
        ]),
        (i.raw("lineitem"), [Check("lineitem_grain", failing=quality.unique_combination(
            i.raw("lineitem"), ["l_orderkey", "l_linenumber"]))]),
        (m.fx, [Check("rate_not_identity", failing=quality.identity_rates(m.fx, "USD"))]),
        (i.bpcustomer, [Check("names_unique", failing=quality.colliding_names(
            i.bpcustomer, "customer_name", "customer_code"), severity="warn")]),
        (none, [
            Check("blocked_has_no_logic", failing=quality.blocked_with_logic(none)),
            Check("process_exists", failing=quality.unmapped_processes(slots, processes)),
            Check("at_most_four_metrics", failing=quality.crowded_processes(slots)),
        ]),
    ])


@query("registry_blocked_logic", """
select 'metric ' || p_partkey as metric_name, 'blocked' as status, 'model ' || p_size as sql_model
from part where p_partkey % 3 = 0 and p_partkey % 4 <> 1 and p_partkey % 5 <> 0""")
def registry_blocked_logic(i):
    """Blocked metrics that carry logic, planted among parts read as a registry."""
    k = F.col("p_partkey")
    logic = F.when(k % 4 == 1, F.lit("")).when(k % 5 != 0, tag("model ", F.col("p_size")))
    return quality.blocked_with_logic(i.raw("part").select(
        tag("metric ", k).alias("metric_name"),
        F.when(k % 3 == 0, "blocked").otherwise("live").alias("status"), logic.alias("sql_model")))


@query("registry_unmapped", """
select 'P' || (s_suppkey % 7) as process_code from supplier
where s_suppkey % 7 not in (select n_nationkey from nation where n_nationkey % 2 = 0)""")
def registry_unmapped(i):
    """Slots of processes that do not exist."""
    slots = i.raw("supplier").select(tag("P", F.col("s_suppkey") % 7).alias("process_code"))
    known = i.raw("nation").where("n_nationkey % 2 = 0").select(
        tag("P", F.col("n_nationkey")).alias("process_code"))
    return quality.unmapped_processes(slots, known)


@query("registry_crowded", """
select 'P' || c_nationkey || if(c_custkey % 9 = 0, '', '-' || c_custkey // 4) as process_code, count(*) as metric_count
from customer group by 1 having count(*) > 4""")
def registry_crowded(i):
    """Processes with more than four metrics, among customers read as slots; most processes have a few."""
    small = F.when(F.col("c_custkey") % 9 != 0, tag("-", F.floor(F.col("c_custkey") / 4)))
    return quality.crowded_processes(i.raw("customer").select(
        F.concat(tag("P", F.col("c_nationkey")), F.coalesce(small, F.lit(""))).alias("process_code")))


@query("colliding_names", """
select upper(trim(customer_name)) as name_upper, count(*) as records,
  string_agg(customer_code, ', ' order by customer_code) as codes
from bpcustomer group by 1 having count(*) > 1""")
def colliding_names(i):
    return quality.colliding_names(i.bpcustomer, "customer_name", "customer_code")


@query("accepted_values", """
select match_result, count(*) as rows from f_ap
where match_result not in ('matched', 'quantity_variance', 'price_variance') group by 1""")
def accepted_values(i):
    fact = Models(i).fct_supplier_invoice_line
    return quality.accepted_values(
        fact, "match_result", ["matched", "quantity_variance", "price_variance"]).groupBy(
        "match_result").agg(F.count(F.lit(1)).alias("rows"))


# fixed values: SQL name of each dimension
DIM_SQL = {"dim_date": "d_date", "dim_customer": "d_customer", "dim_site": "d_site",
           "dim_item": "d_item", "dim_carrier": "d_carrier"}
FACT_SQL = {**BASES, "fct_shipment_event": "f_event"}


@query("dim_relationships", "\nunion all\n".join(
    f"select '{fact}.{fk}' as binding, count(*) as orphans from {FACT_SQL[fact]} "
    f"where {fk} is not null and {fk} not in (select {pk} from {DIM_SQL[dim]})"
    for fact, fk, dim, pk in relationships()), store_lines=True)
def dim_relationships(i):
    """All bindings at once: each fact and each dimension is read once."""
    m, bound = Models(i), relationships()
    facts = {f: m.model(f, {b[1] for b in bound if b[0] == f}) for f in dict.fromkeys(
        b[0] for b in bound)}
    dims = {d: m.model(d) for d in dict.fromkeys(b[2] for b in bound)}
    return quality.binding_orphans(facts, dims, bound)


def _parity_sql(name):
    num, den = "sum(numerator)", "sum(denominator)"
    return f"""
select a.metric_name, a.v as from_rows, b.metric_value as from_fact,
  {'false' if name == 'cost_per_order' else 'true'} as is_reaggregatable,
  abs(a.v - b.metric_value) <= greatest(abs(a.v), abs(b.metric_value), 1) * 1e-6 as agrees,
  true as passes
from (select '{name}' as metric_name, cast({num} as double) / nullif(cast({den} as double), 0) as v
      from ({metric_sql(name)})) a cross join ({metric_sql(name, {})}) b"""


@query("parity", "\nunion all\n".join(_parity_sql(n) for n in sorted(METRICS)), store_lines=True)
def parity(i):
    """Metric rows rolled up against the aggregate on the fact, for all ten metrics."""
    return quality.metric_parity(Models(i).catalog())


@query("reconcile", """
select a as first_amount, b as second_amount, a - b as difference
from (select sum(line_net_amount_usd) as a from f_invoice) cross join
     (select sum(amount_company_currency) as b from gl_line where gl_account_code = '41000')
where abs(a - b) > 1.00""")
def reconcile(i):
    """Invoiced revenue against the revenue account; one row when they differ."""
    gl = i.gl_line.where("gl_account_code = '41000'")
    return quality.reconcile(Models(i).model("fct_invoice_line", {"line_net_amount_usd"}),
                             "line_net_amount_usd", gl,
                             "amount_company_currency")


@query("lossless", """
select part, supp, qty, ship, 1 as rows_in_first, 0 as rows_in_second from position_
where part % 50 = 7
union all
select part, supp, qty + 1, ship, 0, 1 from position_ where part % 50 = 7""")
def lossless(i):
    """Two builds of the stock positions, one with changed rows; equal rows cancel."""
    first = i._position
    second = first.withColumn("qty", F.when(F.col("part") % 50 == 7, F.col("qty") + 1)
                              .otherwise(F.col("qty")).cast("decimal(18,4)"))
    return quality.lossless(first, second)


@query("lossless_equal", """
select count(*) as differing_rows from (select 1 where false)""")
def lossless_equal(i):
    """Two routes to the same lines: direct, and through a per-load fold."""
    direct = i.line.select("order_id", "line_no", "qty", "amt")
    parts = i.raw("lineitem").groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,4)")).alias("q"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).alias("a"))
    other = parts.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("q").cast("decimal(18,4)").alias("qty"),
        F.sum("a").cast("decimal(18,4)").alias("amt")).withColumnsRenamed(
        {"l_orderkey": "order_id", "l_linenumber": "line_no"})
    return quality.lossless(direct, other).agg(F.count(F.lit(1)).alias("differing_rows"))


# ------------------------------------------------------------- profiling


@query("profile_census", "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}"
    for t in ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")))
def profile_census(i):
    names = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
    return profile.census({n: i.raw(n) for n in names})


@query("profile_cost", """
with c as (select shipment_id, sum(charge_amount_usd) as t from charge group by 1)
select count(*) as shipments, count(*) filter (where t is null) as no_charge_lines,
  sum(header_cost_usd) as header_total, sum(t) as charge_total,
  count(*) filter (where abs(header_cost_usd - t) < 0.01) as agree_to_cent,
  round(cast(sum(t - header_cost_usd) as double) / count(t - header_cost_usd), 2) as mean_diff
from shipment left join c using (shipment_id)""")
def profile_cost(i):
    return profile.cost_agreement(i.shipment, i.charge)


@query("profile_charge_mix", """
select charge_code, count(*) as lines, sum(charge_amount_usd) as amount_usd,
  count(distinct currency_code) as currencies from charge group by 1""")
def profile_charge_mix(i):
    return profile.charge_mix(i.charge)


def _otd_sql(basis, promised):
    return f"""
select '{basis}' as basis, count(*) as delivered,
  count(*) filter (where delivered_date <= {promised}) as on_time,
  round(cast(count(*) filter (where delivered_date <= {promised}) as double) / count(*) * 100, 1)
    as pct
from f_ship where delivered_date is not null and {promised} is not null"""


@query("profile_otd", _otd_sql("carrier promise", "carrier_promised_delivery_date") + " union all "
       + _otd_sql("customer request", "customer_requested_delivery_date"))
def profile_otd(i):
    ship = Models(i).model("fct_shipment", {
        "delivered_date", "carrier_promised_delivery_date", "customer_requested_delivery_date"})
    out = None
    for basis, col in (("carrier promise", "carrier_promised_delivery_date"),
                       ("customer request", "customer_requested_delivery_date")):
        one = profile.on_time(ship, "delivered_date", col).select(F.lit(basis).alias("basis"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("profile_status", """
select shipment_status as status, count(*) as shipments, count(delivered_date)
  as has_delivered_date from shipment group by 1""")
def profile_status(i):
    return profile.status_completeness(i.shipment, "shipment_status", "delivered_date")


@query("profile_dso", """
with d as (select date_diff('day', invoice_date, coalesce(payment_date, date '1753-01-01')) as a,
             date_diff('day', invoice_date, payment_date) as s, payment_date is null as o
           from sinvoicev)
select count(*) as invoices, count(*) filter (where o) as sentinel_unpaid,
  round(cast(count(*) filter (where o) as double) / count(*) * 100, 1) as pct_unpaid,
  round(cast(sum(s) as double) / count(s), 1) as mean_days, min(s) as min_days, max(s) as max_days,
  round(cast(sum(a) as double) / count(a), 1) as mean_days_unguarded, median(s) as median_days
from d""")
def profile_dso(i):
    raw = i.sinvoicev.withColumn("payment_date", F.coalesce("payment_date", F.lit(SENTINEL)))
    return profile.settlement(raw, "invoice_date", "payment_date", SENTINEL)


@query("profile_presence", """
select (select count(distinct invoice_type_code) from sinvoicev) as invoice_types,
  (select count(*) from sinvoiced where line_net_amount < 0) as negative_invoice_lines,
  (select count(*) from preceiptd where received_qty > 0) as lines_received,
  (select count(distinct gl_account_code) from gl_line) as gl_accounts""")
def profile_presence(i):
    """Presence probes: one aggregate per probed table, put side by side."""
    parts = [
        i.sinvoicev.agg(F.countDistinct("invoice_type_code").alias("invoice_types")),
        i.sinvoiced.agg(F.count_if(F.col("line_net_amount") < 0).alias("negative_invoice_lines")),
        i.preceiptd.agg(F.count_if(F.col("received_qty") > 0).alias("lines_received")),
        i.gl_line.agg(F.countDistinct("gl_account_code").alias("gl_accounts")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))
    return out


@query("profile_movements", """
select l_linenumber as code, case when l_linenumber % 2 = 0 then 'type ' || l_linenumber end
  as label, count(*) as rows from lineitem group by 1, 2""")
def profile_movements(i):
    """Rows per movement type with its label; a type without a label stays."""
    n = F.col("l_linenumber")
    labels = i.raw("lineitem").where(n % 2 == 0).select(
        n.alias("k"), tag("type ", n).alias("t")).distinct()
    return profile.label_counts(i.raw("lineitem"), "l_linenumber", labels, "k", "t")


@query("profile_padding", """
select 'part.p_brand' as column_name, count(*) filter (where p_partkey % 3 = 0) as padded_rows
from part
union all select 'customer.c_name', count(*) filter (where c_custkey % 4 = 0) from customer
union all select 'orders.o_orderpriority', 0 from orders group by 1""")
def profile_padding(i):
    def padded(t, key, col, n):
        c = F.col(col)
        return i.raw(t).select(F.when(F.col(key) % n == 0, F.concat(c, F.lit("   "))).otherwise(c)
                               .alias("v"))
    return profile.padding_census({
        "part.p_brand": (padded("part", "p_partkey", "p_brand", 3), "v"),
        "customer.c_name": (padded("customer", "c_custkey", "c_name", 4), "v"),
        "orders.o_orderpriority": (i.raw("orders"), "o_orderpriority"),
    })


def _link_sql(name, left, lk, right, rk):
    return f"""
select '{name}' as link, count(*) as rows, count(*) filter (where k is null) as null_keys,
  count(r) as linked, round(cast(count(r) as double) / count(*) * 100, 1) as pct
from (select {lk} as k from {left}) left join (select distinct {rk} as r from {right}) on k = r"""


@query("profile_links", " union all ".join([
    _link_sql("shipment to order", "shipment", "trim(reference_number)", "sorder",
              "trim(sales_order_number)"),
    _link_sql("shipment name to customer", "(select distinct customer_name from shipment)",
              "upper(trim(customer_name))", "bpcustomer", "upper(trim(customer_name))"),
    _link_sql("company to customer", "hs", "c", "x3", "c"),
    _link_sql("deal to order", "deal", "erp_order_number_raw", "deal_orders",
              "sales_order_number"),
    _link_sql("rep to roster", "represent", "upper(trim(rep_name))", "roster",
              "upper(trim(legal_last_name) || ' ' || trim(legal_first_name))"),
]))
def profile_links(i):
    """Hit rate of each crosswalk link; partners are folded to distinct keys."""
    c = F.col
    up = lambda col: keys.name_upper(c(col))
    rates = [
        profile.link_rate("shipment to order", i.shipment, F.trim("reference_number"), i.sorder,
                          F.trim("sales_order_number")),
        profile.link_rate("shipment name to customer", i.shipment.select("customer_name").distinct(),
                          up("customer_name"), i.bpcustomer, up("customer_name")),
        profile.link_rate("company to customer", i.company, keys.name_core(c("company_name")),
                          i.bpcustomer, keys.name_core(c("customer_name"))),
        profile.link_rate("deal to order", i.deal, c("erp_order_number_raw"), i.deal_orders,
                          c("sales_order_number")),
        profile.link_rate("rep to roster", i.represent, up("rep_name"), i.roster,
                          keys.person_key(c("legal_last_name"), c("legal_first_name"))),
    ]
    out = rates[0]
    for r in rates[1:]:
        out = out.unionByName(r)
    return out


@query("profile_name_collisions", """
select count(*) as colliding_names from (
  select upper(trim(legal_last_name) || ' ' || trim(legal_first_name)) from roster group by 1
  having count(*) > 1)""")
def profile_name_collisions(i):
    return profile.colliding_keys(
        i.roster, keys.person_key(F.col("legal_last_name"), F.col("legal_first_name")))


@query("profile_currency", """
select 'orders' as table_name, currency_code as currency, count(*) as row_count from sorder
group by 2 union all
select 'invoices', currency_code, count(*) from sinvoicev group by 2""")
def profile_currency(i):
    return profile.currency_spread({"orders": i.sorder, "invoices": i.sinvoicev})


@query("profile_implied_rate", """
select currency_code as document_currency,
  round(cast(amount_company_currency as double) / nullif(cast(amount_document_currency as double), 0),
        4) as implied_rate, count(*) as lines
from gl_line join gl_header using (journal_entry_number) group by 1, 2""")
def profile_implied_rate(i):
    return profile.implied_rates(i.gl_line, i.gl_header)


@query("profile_events", """
with e as (select *, lag(event_at) over (partition by shipment_id order by event_sequence) as p
           from event)
select count(*) as events, count(*) filter (where p is not null and event_at < p) as out_of_sequence,
  round(cast(count(*) filter (where p is not null and event_at < p) as double) / count(*) * 100, 2)
    as pct
from e""")
def profile_events(i):
    return profile.out_of_sequence_share(i.event)


@query("profile_event_codes", """
select event_code, event_description, count(*) as events from event group by 1, 2""")
def profile_event_codes(i):
    return i.event.groupBy("event_code", "event_description").agg(
        F.count(F.lit(1)).alias("events"))


@query("revenue_quarter", """
select h.sales_site_code as site_code, cast(date_trunc('quarter', invoice_date) as date) as quarter,
  sum(line_net_amount) as revenue, count(*) as lines
from sinvoiced l join sinvoicev h using (invoice_number) group by 1, 2""")
def revenue_quarter(i):
    j = i.sinvoiced.join(i.sinvoicev.select("invoice_number", "sales_site_code", "invoice_date"),
                         "invoice_number")
    return profile.revenue_by_quarter(j, "sales_site_code", "invoice_date", "line_net_amount")


@query("forecast_error", """
select abc_class, count(abs_pct_error) as periods, median(cast(abs_pct_error as double))
  as median_error
from (select *, cast(abs(forecast_qty - cast(length(item_code) * 7 as decimal(18,4)))
        as decimal(18,4)) as abs_pct_error from item_location) group by 1""")
def forecast_error(i):
    key = ["item_code", "location_code"]
    accuracy = i.item_location.select(*key, F.abs(
        F.col("forecast_qty") - (F.length("item_code") * 7).cast("decimal(18,4)"))
        .cast("decimal(18,4)").alias("abs_pct_error"))
    return profile.forecast_error_by_class(accuracy, i.item_location, key)


@query("lead_time", """
select sales_site_code as site_code, count(*) as orders, count(shipment_date) as shipped,
  round(cast(sum(date_diff('day', order_date, shipment_date)) as double)
    / count(date_diff('day', order_date, shipment_date)), 1) as mean_days,
  min(date_diff('day', order_date, shipment_date)) as min_days,
  max(date_diff('day', order_date, shipment_date)) as max_days
from sorder group by 1""")
def lead_time(i):
    raw = i.sorder.withColumn("shipment_date", F.coalesce("shipment_date", F.lit(SENTINEL)))
    return profile.lead_time(raw, "sales_site_code", "order_date", "shipment_date", SENTINEL)
