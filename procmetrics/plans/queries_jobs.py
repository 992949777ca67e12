"""Entity resolution, document matching, dimensions and facts on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.clean import MONEY
from ..functions.keys import suffix_list
from ..operators import events, facts, fx, match, scd2
from ..policy import Policy
from ..sources.publish import load_seed
from .inputs import tag, txt
from .models import Models
from .registry import query
from .views import FX_JOIN, M, RATE, calendar, dkey


# ------------------------------------------------------------- resolution


@query("customer_xref", "select * from xref")
def customer_xref(i):
    return match.customer_xref(i.company, i.bpcustomer)


@query("customer_xref_tiers", """
select crm_company_id, match_method, confidence, probes_agreeing, count(*) as members,
  min(candidate_rank) as first_rank
from xref group by all""")
def customer_xref_tiers(i):
    """The candidate list by counts, without forming the pairs."""
    return match.candidate_tiers(i.company, i.bpcustomer)


@query("customer_xref_seed", "select * from xref")
def customer_xref_seed(i):
    """The same with the legal forms of the packaged seed table."""
    return match.customer_xref(i.company, i.bpcustomer, suffix_list(load_seed(i.spark, "legal_suffix")))


@query("customer_best_match", """
select crm_company_id, erp_customer_code, match_method, confidence, is_ambiguous
from xref where is_selected""")
def customer_best_match(i):
    """The selected rows of the above, without forming the candidate pairs."""
    return match.best_customer_match(i.company, i.bpcustomer)


@query("employee_xref", """
with folk as (
  select lower(work_email) as mail, min(upper(trim(legal_last_name) || ' ' || trim(legal_first_name))) as spoken,
    list({'since': ifnull(hire_date, date '2100-01-01'), 'code': employee_code}
      order by ifnull(hire_date, date '2100-01-01'), employee_code) as records
  from roster where work_email is not null group by mail),
asked as (
  select 'hubspot' as source_system, owner_id as source_key, first_name || ' ' || last_name as source_label,
    lower(trim(email)) as mail, 'work_email' as match_method, 0.99 as sure from owner_
  union all by name
  select 'sage_x3' as source_system, rep_code as source_key, rep_name as source_label,
    upper(trim(rep_name)) as spoken, 'person_name' as match_method, 0.70 as sure from represent)
select md5(concat_ws('-', source_system, source_key, records[1].code)) as employee_xref_key,
  source_system, source_key, source_label, records[1].code as payroll_employee_code,
  folk.mail as work_email, len(records) as duplicate_record_count,
  array_to_string(list_sort([r.code for r in records]), ',') as all_employee_codes, match_method,
  cast(sure as decimal(4,2)) as confidence,
  row_number() over (partition by source_system, source_key order by records[1].code) as candidate_rank,
  count(*) over (partition by source_system, source_key) > 1 as is_ambiguous, candidate_rank = 1 as is_selected
from asked join folk on folk.mail = asked.mail or folk.spoken = asked.spoken""")
def employee_xref(i):
    return match.employee_xref(i.roster, i.represent, i.owner)


@query("repair_refs", """
with typed as (
  select *, unnest([x for x in [trim(y) for y in string_split(erp_order_number_raw, '/')] if x <> '']) as seen
  from deal),
read_ as (
  select *, regexp_extract(upper(seen), '^(SO)?((US|CA)[0-9]{8})$', 2) as tail,
    [x for x in [case when contains(erp_order_number_raw, '/') then 'split_multi_value' end,
                 case when seen <> upper(seen) then 'case_corrected' end,
                 case when tail <> '' and not starts_with(upper(seen), 'SO') then 'prefix_restored' end]
     if x is not null] as steps
  from typed)
select deal_id, erp_order_number_raw, 'SO' || nullif(tail, '') as sales_order_number,
  list_contains(steps, 'split_multi_value') as was_split,
  list_contains(steps, 'case_corrected') as was_case_corrected,
  list_contains(steps, 'prefix_restored') as was_prefix_restored,
  case len(steps) when 0 then 'as_is' else array_to_string(steps, ' + ') end as repair_applied,
  is_closed_won, is_archived, deal_amount, close_date,
  ('SO' || tail) in (select sales_order_number from deal_orders) as resolves_to_order,
  count(*) over (partition by deal_id) as references_on_deal
from read_""")
def repair_refs(i):
    return match.repair_refs(i.deal, i.deal_orders)


@query("return_line", "select * from ret_line")
def return_line(i):
    return Models(i).returns


@query("fx_rates", "select * from fx")
def fx_rates(i):
    return Models(i).fx


@query("fx_lookup", f"""
select h.sales_order_number, {RATE} as fx_rate,
  fx.rate_to_reporting_currency is null as fx_rate_is_fallback
from sorder h {FX_JOIN.format(d='order_date')}""")
def fx_lookup(i):
    rates = Models(i).stored_fx
    orders = i.sorder.select("sales_order_number", "currency_code", "order_date")
    return fx.with_fx(orders, rates, "currency_code", "order_date").select(
        "sales_order_number", "fx_rate", "fx_rate_is_fallback")


@query("shipment_charge", "select * from int_charge")
def shipment_charge(i):
    return Models(i).charges


@query("milestones", "select * from mile")
def milestones(i):
    return Models(i).milestones


@query("milestones_split", "select * from mile")
def milestones_split(i):
    """Milestones with every shipment cut into pieces, as a hot one would be."""
    return events.milestones(i.event, parts=400)


@query("shipment_order", "select * from ship_order")
def shipment_order(i):
    return Models(i).links


@query("three_way_match", "select * from match3")
def three_way_match(i):
    return Models(i).matched


@query("match_outcomes", f"""
select match_result, count(*) as lines, sum(line_net_amount) as amount from match3 group by 1""")
def match_outcomes(i):
    return Models(i).matched.groupBy("match_result").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_net_amount").alias("amount"))


@query("match_zero_receipt", """
select count(*) filter (where match_result = 'matched' and received_qty = 0) as passed_by_default,
  0 as passed_by_policy from match3""")
def match_zero_receipt(i):
    """A receipt of nothing passes by default and fails under the stricter policy."""
    zero = (F.col("match_result") == "matched") & (F.col("received_qty") == 0)
    strict = Models(i, Policy(zero_receipt_is_variance=True)).matched
    a = Models(i).matched.agg(F.count_if(zero).alias("passed_by_default"))
    billed = zero & (F.col("invoiced_qty") != 0)
    b = strict.agg(F.count_if(billed).alias("passed_by_policy"))
    return a.crossJoin(F.broadcast(b))


# ------------------------------------------------------------- dimensions


@query("dim_carrier", "select * from d_carrier")
def dim_carrier(i):
    return Models(i).dim_carrier


@query("dim_customer", "select * from d_customer")
def dim_customer(i):
    return Models(i).dim_customer


@query("dim_date", "select * from d_date")
def dim_date(i):
    return Models(i).dim_date


@query("dim_date_fiscal", calendar(4))
def dim_date_fiscal(i):
    """A fiscal year that starts in April."""
    return Models(i, Policy(fiscal_year_start_month=4)).dim_date


@query("dim_item", "select * from d_item")
def dim_item(i):
    return Models(i).dim_item


@query("dim_site", "select * from d_site")
def dim_site(i):
    return Models(i).dim_site


# ------------------------------------------------------------- facts


@query("fct_shipment", "select * from f_ship")
def fct_shipment(i):
    return Models(i).fct_shipment


@query("fct_shipment_header_cost", """
select shipment_id, header_cost_usd as shipment_cost_usd,
  'shipment_header' as shipment_cost_basis from f_ship""")
def fct_shipment_header_cost(i):
    """The cost basis is chosen when the plan is built; charges stay on the fact."""
    header = Models(i, Policy(shipment_cost_basis="shipment_header"))
    return header.model("fct_shipment", {
        "shipment_id", "shipment_cost_usd", "shipment_cost_basis"})


@query("fct_shipment_event", "select * from f_event")
def fct_shipment_event(i):
    return Models(i).fct_shipment_event


@query("fct_sales_order_line", "select * from f_order", store_lines=True)
def fct_sales_order_line(i):
    return Models(i).fct_sales_order_line


@query("fct_invoice_line", "select * from f_invoice")
def fct_invoice_line(i):
    return Models(i).fct_invoice_line


@query("fct_supplier_invoice_line", "select * from f_ap")
def fct_supplier_invoice_line(i):
    return Models(i).fct_supplier_invoice_line


@query("fct_count_line", "select * from f_count")
def fct_count_line(i):
    return Models(i).fct_inventory_count_line


@query("fct_count_line_tolerant", """
select count_session_number, count_line_number,
  case when system_qty = 0 then counted_qty = 0 else cast(abs(counted_qty - system_qty) as double)
    / cast(system_qty as double) * 100 <= 2.5 end as is_accurate_position
from stocountd""")
def fct_count_line_tolerant(i):
    """Accuracy within a tolerance band, the zero system quantity aside."""
    pol = Policy(inventory_accuracy_tolerance_pct=2.5)
    return Models(i, pol).fct_inventory_count_line.select(
        "count_session_number", "count_line_number", "is_accurate_position")


# ------------------------------------------------------------- further facts


@query("fct_purchase_order_line", f"""
select p.purchase_order_number, p.purchase_order_line_number, {dkey('o.order_date')}
    as order_date_key, {dkey('o.order_date + 14')} as expected_receipt_date_key, p.item_code,
  o.site as site_code, 'V' || (o.order_id % 10) as supplier_code, o.status as order_status,
  'USD' as document_currency_code, o.order_date, p.ordered_qty,
  cast(coalesce(r.q, 0) as {M}) as received_qty,
  p.ordered_qty - cast(coalesce(r.q, 0) as {M}) as open_qty,
  p.net_unit_price as net_unit_price_doc,
  cast(p.ordered_qty * p.net_unit_price as {M}) as line_net_amount_doc,
  coalesce(r.q, 0) >= p.ordered_qty as is_fully_received
from porderq p join ord o on 'PO' || o.order_id = p.purchase_order_number
left join (select purchase_order_number, purchase_order_line_number, sum(received_qty) as q
           from preceiptd group by 1, 2) r
  on r.purchase_order_number = p.purchase_order_number
  and r.purchase_order_line_number = p.purchase_order_line_number""")
def fct_purchase_order_line(i):
    key = ["purchase_order_number", "purchase_order_line_number"]
    got = i.preceiptd.groupBy(*key).agg(F.sum("received_qty").cast(MONEY).alias("received_qty"))
    head = i.order.select(
        tag("PO", F.col("order_id")).alias("purchase_order_number"), "order_date",
        F.col("status").alias("order_status"), tag("V", F.col("order_id") % 10)
        .alias("supplier_code"), F.lit("USD").alias("currency_code"),
        F.col("site").alias("purchase_site_code"))
    lines = i.porderq.join(got, key, "left").join(
        head.select("purchase_order_number", "purchase_site_code",
                    F.date_add("order_date", 14).alias("expected_receipt_date")),
        "purchase_order_number").withColumn(
        "received_qty", F.coalesce("received_qty", F.lit(0).cast(MONEY)))
    return facts.fct_purchase_order_line(lines, head)


@query("fct_inventory_movement", f"""
select l_orderkey * 10 + l_linenumber as stock_movement_id, {dkey('l_shipdate')}
    as movement_date_key, 'P' || l_partkey as item_code,
  coalesce(case when l_suppkey % 9 <> 0 then 'S' || l_suppkey end, 'UNKNOWN') as site_code,
  case l_returnflag when 'R' then 'Receipt' else 'Issue' end as movement_type,
  'SO' || l_orderkey as document_number, l_linestatus as document_type, 'LOT' || (l_partkey % 3)
    as lot_code, cast(l_shipdate as date) as movement_date,
  cast(case l_returnflag when 'R' then l_quantity else -l_quantity end as {M}) as movement_qty,
  l_returnflag <> 'R' as is_issue
from lineitem""")
def fct_inventory_movement(i):
    c = F.col
    back = c("l_returnflag") == "R"
    moves = i.raw("lineitem").select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("stock_movement_id"),
        c("l_shipdate").cast("date").alias("movement_date"),
        tag("P", c("l_partkey")).alias("item_code"),
        F.when(c("l_suppkey") % 9 != 0, tag("S", c("l_suppkey"))).alias("site_code"),
        F.when(back, "Receipt").otherwise("Issue").alias("movement_type"),
        tag("SO", c("l_orderkey")).alias("document_number"),
        c("l_linestatus").alias("document_type"), tag("LOT", c("l_partkey") % 3).alias("lot_code"),
        F.when(back, c("l_quantity")).otherwise(-c("l_quantity")).cast(MONEY)
        .alias("movement_qty"))
    return facts.fct_inventory_movement(moves)


@query("fct_inventory_balance", """
select site_code, item_code, lot_code, location_code, 'A' as stock_status,
  system_qty as on_hand_qty from stocountd""")
def fct_inventory_balance(i):
    return facts.fct_inventory_balance(i.stocountd.select(
        "site_code", "item_code", "lot_code", "location_code",
        F.lit("A").alias("stock_status"), F.col("system_qty").alias("on_hand_qty")))


@query("fct_gl_entry_line", f"""
select l.journal_entry_number, journal_line_number, {dkey('accounting_date')}
    as accounting_date_key, site_code, gl_account_code, 'SAL' as journal_code,
  currency_code as document_currency_code, accounting_date, amount_document_currency,
  amount_company_currency
from gl_line l join gl_header h on h.journal_entry_number = l.journal_entry_number""")
def fct_gl_entry_line(i):
    return facts.fct_gl_entry_line(i.gl_line, i.gl_header.withColumn("journal_code", F.lit("SAL")))


PLAN_SQL = """
select item_code, location_code, last_sync_date as period_start_date, forecast_qty,
  cast(case when n % 7 = 0 then 0 else forecast_qty - n % 5 end as decimal(18,4)) as actual_qty
from (select *, length(item_code) + length(location_code) * 3
        + cast(substr(item_code, 2) as bigint) as n from item_location)"""


def _actual(i):
    n = (F.length("item_code") + F.length("location_code") * 3
         + F.expr("substr(item_code, 2)").cast("bigint"))
    actual = F.when(n % 7 == 0, F.lit(0)).otherwise(F.col("forecast_qty") - n % 5).cast(MONEY)
    return i.item_location.select(
        "item_code", "location_code", F.col("last_sync_date").alias("period_start_date"),
        "forecast_qty", actual.alias("actual_qty"))


@query("fct_forecast", f"""
select item_code, location_code as site_code, {dkey('period_start_date')} as period_start_date_key,
  period_start_date, forecast_qty, case when keep then actual_qty end as actual_qty,
  case when keep then cast(abs(actual_qty - forecast_qty) as decimal(18,4)) end as abs_pct_error
from (select *, actual_qty > 10 as keep from ({PLAN_SQL}))""")
def fct_forecast(i):
    plan = _actual(i)
    accuracy = plan.where("actual_qty > 10").withColumn(
        "abs_pct_error", F.abs(F.col("actual_qty") - F.col("forecast_qty")).cast(MONEY))
    return facts.fct_forecast(plan.drop("actual_qty"), accuracy)


@query("fct_deal_stage_change", f"""
select 'D' || o_orderkey as deal_id, stage as deal_stage_id, {dkey('day')} as changed_at_date_key,
  day as changed_at_date, 'O' || o_custkey as changed_by_owner_id,
  case when o_orderkey % 10 <> 0 then cast(o_custkey as varchar) end as company_id,
  case when o_orderkey % 10 <> 0 then 'O' || (o_custkey % 7) end as owner_id,
  case when o_orderkey % 10 <> 0 then o_totalprice end as deal_amount,
  case when o_orderkey % 10 <> 0 then o_orderkey % 37 = 0 end as is_archived
from (select *, 'open' as stage, cast(o_orderdate as date) as day from orders
      union all select *, 'won', cast(o_orderdate as date) + 9 from orders where o_orderkey % 3 = 0)""")
def fct_deal_stage_change(i):
    o = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    steps = F.array(
        F.struct(F.lit("open").alias("stage"), day.alias("day")),
        F.when(o % 3 == 0, F.struct(F.lit("won").alias("stage"), F.date_add(day, 9).alias("day"))))
    history = i.raw("orders").withColumn("s", F.explode(steps)).where("s is not null").select(
        tag("D", o).alias("deal_id"), F.col("s.stage").alias("deal_stage_id"),
        F.col("s.day").alias("changed_at_date"),
        tag("O", F.col("o_custkey")).alias("changed_by_owner_id"))
    deals = i.raw("orders").where(o % 10 != 0).select(
        tag("D", o).alias("deal_id"), txt(F.col("o_custkey")).alias("company_id"),
        tag("O", F.col("o_custkey") % 7).alias("owner_id"),
        F.col("o_totalprice").alias("deal_amount"), (o % 37 == 0).alias("is_archived"))
    return facts.fct_deal_stage_change(history, deals)


@query("fct_payroll_earning", f"""
select 'C' || order_id as check_id, 'E' || line_no as earning_code, {dkey('order_date')}
    as check_date_key, coalesce(x.x3_site_code, 'UNKNOWN') as site_code,
  'E' || custkey as employee_code, 'DEP' || (order_id % 4) as department_code,
  'LAB' || (k % 3) as labor_allocation_code, order_date as check_date, qty as hours,
  amt as earning_amount
from ol left join crosswalk x on x.paycom_location_code = 'PAY' || nation""")
def fct_payroll_earning(i):
    c = F.col
    earnings = i.order_line.select(
        tag("C", c("order_id")).alias("check_id"), tag("E", c("line_no")).alias("earning_code"),
        tag("E", c("custkey")).alias("employee_code"),
        tag("LAB", c("k") % 3).alias("labor_allocation_code"), c("qty").alias("hours"),
        c("amt").alias("earning_amount"))
    checks = i.order.select(
        tag("C", c("order_id")).alias("check_id"), c("order_date").alias("check_date"),
        tag("PAY", c("nation")).alias("payroll_location_code"),
        tag("DEP", c("order_id") % 4).alias("department_code"))
    return facts.fct_payroll_earning(earnings, checks, i.crosswalk)


# ------------------------------------------------------------- type-2 history

SCD_COLS = list(scd2.SNAPSHOTS["bpcustomer"][1])


@query("scd2", """
with v1 as (select customer_code as c, primary_rep_code as r, payment_term_code as p,
              credit_limit_amount as l, customer_group_code as g from bpcustomer
            where cast(split_part(customer_code, '-', 1) as bigint) % 13 <> 0),
v2 as (select customer_code as c,
         case when cast(split_part(customer_code, '-', 1) as bigint) % 7 = 0 then '99' else primary_rep_code end as r,
         payment_term_code as p, case when cast(split_part(customer_code, '-', 1) as bigint) % 11 = 0 then null
           else credit_limit_amount end as l, customer_group_code as g from bpcustomer
       where cast(split_part(customer_code, '-', 1) as bigint) % 17 <> 0)
select v1.c as customer_code, v1.r as primary_rep_code, v1.l as credit_limit_amount,
  date '2024-01-01' as valid_from, case when v2.c is not null and (v1.r is distinct from v2.r
    or v1.l is distinct from v2.l) then date '2024-02-01' end as valid_to
from v1 left join v2 on v1.c = v2.c
union all
select v2.c, v2.r, v2.l, date '2024-02-01', null from v2 left join v1 on v1.c = v2.c
where v1.c is null or v1.r is distinct from v2.r or v1.l is distinct from v2.l""")
def scd2_customers(i):
    """Two looks at the customers: new, changed, unchanged and vanished keys."""
    n = F.split_part("customer_code", F.lit("-"), F.lit(1)).cast("bigint")
    cols = ["customer_code", *SCD_COLS]
    first = i.bpcustomer.select(*cols).where(n % 13 != 0)
    second = i.bpcustomer.select(*cols).where(n % 17 != 0).withColumns({
        "primary_rep_code": F.when(n % 7 == 0, "99").otherwise(F.col("primary_rep_code")),
        "credit_limit_amount": F.when(n % 11 != 0, F.col("credit_limit_amount"))})
    h = scd2.snapshot_scd2(first, None, ["customer_code"], SCD_COLS, dt.date(2024, 1, 1))
    h = scd2.snapshot_scd2(second, h, ["customer_code"], SCD_COLS, dt.date(2024, 2, 1))
    return h.select("customer_code", "primary_rep_code", "credit_limit_amount", "valid_from",
                    "valid_to")


@query("scd2_composite", """
select item_code, location_code, abc_class, date '2024-01-01' as valid_from,
  case when length(item_code) % 2 = 0 and abc_class <> 'C' then date '2024-02-01' end as valid_to
from item_location
union all
select item_code, location_code, 'C', date '2024-02-01', null from item_location
where length(item_code) % 2 = 0 and abc_class <> 'C'""")
def scd2_composite(i):
    """A composite key: planning classes per item and location."""
    key, cols = ["item_code", "location_code"], ["abc_class", "xyz_class", "stockout_risk"]
    first = i.item_location.select(*key, *cols)
    second = first.withColumn("abc_class", F.when(F.length("item_code") % 2 == 0, "C").otherwise(
        F.col("abc_class")))
    h = scd2.snapshot_scd2(first, None, key, cols, dt.date(2024, 1, 1))
    h = scd2.snapshot_scd2(second, h, key, cols, dt.date(2024, 2, 1))
    return h.select(*key, "abc_class", "valid_from", "valid_to")


@query("scd2_rep", """
with v2 as (select rep_code, case when rep_type_code = 1 then rep_name || ' Jr' else rep_name end as rep_name,
              case when length(rep_code) = 2 then 'N0' else site_code end as site_code, rep_type_code from represent),
kept as (select a.*, b.rep_name as new_name, b.site_code as new_site,
           a.rep_name is distinct from b.rep_name or a.site_code is distinct from b.site_code as changed
         from represent a join v2 b using (rep_code))
select rep_code, rep_name, site_code, rep_type_code, date '2024-01-01' as valid_from,
  case when changed then date '2024-02-01' end as valid_to from kept
union all
select rep_code, new_name, new_site, rep_type_code, date '2024-02-01', null from kept where changed""")
def scd2_rep(i):
    """Sales reps as their declared history keeps them: renamed ones, and ones that moved."""
    second = i.represent.withColumns({
        "rep_name": F.when(F.col("rep_type_code") == 1, F.concat("rep_name", F.lit(" Jr"))).otherwise(F.col("rep_name")),
        "site_code": F.when(F.length("rep_code") == 2, "N0").otherwise(F.col("site_code"))})
    h = scd2.snapshot("represent", i.represent, None, dt.date(2024, 1, 1))
    h = scd2.snapshot("represent", second, h, dt.date(2024, 2, 1))
    return h.drop("scd_id")
