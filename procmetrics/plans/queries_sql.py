"""Cleaning, join, aggregate, window and scalar operators on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import clean, keys
from ..functions.sequence import exact_median, lag_first, row_number, text_list
from ..operators import match, profile, staging
from ..operators.lines import order_line
from ..sources import landing
from .inputs import SENTINEL, tag, txt
from .registry import query

M = clean.MONEY

# ------------------------------------------------------------- staging


@query("stage_clean", f"""
select nullif(trim(rpad('SO' || o_orderkey, 20, ' ')), '') as sales_order_number,
  nullif(trim(case when o_orderkey % 7 = 0 then '   ' else o_orderpriority end), '')
    as primary_rep_code,
  cast(o_orderdate as date) as order_date,
  case when o_orderkey % 31 <> 0 then cast(o_orderdate as date) + 10 end as shipment_date,
  cast(o_totalprice as {M}) as order_total_amount, cast(o_orderkey % 9 as bigint) as update_tick
from orders""")
def stage_clean(i):
    """Padded keys, blanks and the sentinel date, staged by the derived spec."""
    o = F.col("o_orderkey")
    raw = i.raw("orders").select(
        F.rpad(tag("SO", o), 20, " ").alias("SOHNUM_0"),
        F.when(o % 7 == 0, "   ").otherwise(F.col("o_orderpriority")).alias("REP_0"),
        F.col("o_orderdate").cast("date").alias("ORDDAT_0"),
        F.when(o % 31 == 0, F.lit(SENTINEL)).otherwise(
            F.date_add(F.col("o_orderdate").cast("date"), 10)).alias("SHIDAT_0"),
        F.col("o_totalprice").cast(M).alias("TOTLINAMT_0"),
        (o % 9).alias("UPDTICK_0"))
    return staging.stage_table("erp", "SORDER", raw)


@query("stage_text_casts", f"""
select 'C' || o_orderkey as check_id,
  cast(try_strptime(case when o_orderkey % 13 = 0 then 'not a date' else
    month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) end, '%m/%d/%Y')
    as date) as check_date,
  case when o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0 then cast(o_totalprice as {M}) end
    as gross_pay_amount,
  cast(case when o_orderkey % 5 = 0 then null when o_orderkey % 19 = 0 then null
    else o_orderkey * 3 end as double) as annual_revenue,
  case when o_orderkey % 6 <> 0 then upper('First ' || o_custkey) end as full_name_normalized
from orders""")
def stage_text_casts(i):
    """Text dates and amounts, some bad; bad text becomes null, not an error."""
    o, d = F.col("o_orderkey"), F.col("o_orderdate")
    us = F.concat(txt(F.month(d)), F.lit("/"), txt(F.dayofmonth(d)), F.lit("/"), txt(F.year(d)))
    amount = F.when(o % 13 == 0, "n/a").when(o % 17 == 0, " ").otherwise(
        txt(F.col("o_totalprice").cast(M)))
    raw = i.raw("orders").select(
        tag("C", o).alias("check_id"), F.when(o % 13 == 0, "not a date").otherwise(us)
        .alias("check_date"), amount.alias("gross_pay"),
        F.when(o % 5 == 0, "").when(o % 19 == 0, "x1").otherwise(txt(o * 3)).alias("rev"),
        F.when(o % 6 != 0, "First").alias("f"), txt(F.col("o_custkey")).alias("l"))
    spec = staging.spec_for("payroll", "check", raw.select(
        "check_id", "check_date", "gross_pay").schema)
    return staging.stage(raw, spec, {
        "annual_revenue": clean.clean_hsnum(F.col("rev")),
        "full_name_normalized": F.upper(F.concat("f", F.lit(" "), "l"))})


@query("stage_flags", """
select 'N' || n_nationkey as site_code, n_name as site_name,
  cast(n_nationkey % 3 as bigint) as is_stock_site_code, n_nationkey % 3 = 2 as is_stock_site,
  n_nationkey % 2 + 1 = 2 as is_sales_site, n_nationkey % 5 = 2 as is_purchase_site, customers
from nation join (select c_nationkey, count(*) as customers from customer group by 1)
  on c_nationkey = n_nationkey""")
def stage_flags(i):
    """1/2 menu integers as flags, with the site's customer count."""
    n = F.col("n_nationkey").cast("bigint")
    raw = i.raw("nation").select(
        tag("N", n).alias("FCY_0"), F.col("n_name").alias("FCYNAM_0"),
        (n % 3).alias("FCYSTO_0"), (n % 2 + 1).alias("FCYSAL_0"), (n % 5).alias("FCYPUR_0"))
    sites = staging.stage_table("erp", "FACILITY", raw)
    n_cust = i.raw("customer").groupBy(tag("N", F.col("c_nationkey")).alias("_site")).agg(
        F.count(F.lit(1)).alias("customers"))
    return sites.join(n_cust, F.col("site_code") == F.col("_site")).select(
        "site_code", "site_name", "is_stock_site_code", "is_stock_site", "is_sales_site", "is_purchase_site",
        "customers")


@query("menu_decode", """
select 'SO' || o_orderkey as sales_order_number,
  case o_orderstatus when 'O' then 1 when 'F' then 2 else 9 end as order_status_code,
  case o_orderstatus when 'O' then 'label O' when 'F' then 'label F' end as order_status
from orders""")
def menu_decode(i):
    """Integer status to its label; a code without a label keeps its row."""
    code = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2)
    orders = i.raw("orders").select(
        tag("SO", F.col("o_orderkey")).alias("sales_order_number"),
        F.coalesce(code, F.lit(9)).cast("bigint").alias("order_status_code"))
    lang = F.explode(F.array(F.lit("ENG"), F.lit("FRA")))
    labels = i.raw("orders").where(code.isNotNull()).select(
        F.lit(415).alias("menu_chapter"), code.cast("bigint").alias("menu_code"),
        tag("label ", F.col("o_orderstatus")).alias("menu_label")).distinct().withColumn(
        "language_code", lang)
    return staging.decode_menu(orders, labels, "order_status_code", 415, "order_status")


@query("padded_join", """
select (select count(*) from part p join (select distinct p_brand as b from part) m
          on p.p_brand || '  ' = m.b) as naive_join_rows,
  (select count(*) from part p join (select distinct p_brand as b from part) m
     on trim(p.p_brand || '  ') = m.b) as trimmed_join_rows""")
def padded_join(i):
    padded = i.raw("part").select(F.concat("p_brand", F.lit("  ")).alias("brand"))
    return profile.padded_join(padded, "brand", i.raw("part").select("p_brand").distinct(),
                               "p_brand")


@query("typed_empty", """
select 'HS-' || c_custkey as customer_key, c_name as customer_name,
  cast(null as decimal(18,4)) as credit_limit_amount, cast(null as date) as erp_created_date
from customer""")
def typed_empty(i):
    """A projection padded with typed nulls, united with an empty typed frame."""
    schema = "customer_key string, customer_name string, credit_limit_amount decimal(18,4), " \
             "erp_created_date date"
    none = staging.empty(i.spark, schema)
    some = i.raw("customer").select(
        tag("HS-", F.col("c_custkey")).alias("customer_key"), F.col("c_name").alias("customer_name"))
    return none.unionByName(staging.pad_columns(some, none.schema))


# ------------------------------------------------------------- filters


@query("filter_predicates", """
select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem
where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1998-07-01'
  and l_quantity > 10 and l_quantity <= 45 and l_discount <> 0.05
  and l_returnflag in ('A', 'R') and l_linestatus not in ('X') and l_partkey is not null
  and not (l_tax = 0.08 or l_orderkey % 4 = 0)""")
def filter_predicates(i):
    """Every predicate form; the simple ones reach the Parquet scan."""
    c = F.col
    return i.raw("lineitem").where(
        (c("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (c("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz"))
        & (c("l_quantity") > 10) & (c("l_quantity") <= 45) & (c("l_discount") != 0.05)
        & c("l_returnflag").isin("A", "R") & ~c("l_linestatus").isin("X")
        & c("l_partkey").isNotNull() & ~((c("l_tax") == 0.08) | (c("l_orderkey") % 4 == 0))
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("null_safe_flag", """
select sales_order_number, sales_order_line_number,
  q.item_code is distinct from p.item_code as disagrees
from sorderq q join sorderp p using (sales_order_number, sales_order_line_number)""")
def null_safe_flag(i):
    key = ["sales_order_number", "sales_order_line_number"]
    p = i.sorderp.select(*key, F.col("item_code").alias("_other"))
    return i.sorderq.select(*key, "item_code").join(p, key).select(
        *key, clean.differs(F.col("item_code"), F.col("_other")).alias("disagrees"))


@query("classify_case", """
select size_class, l_returnflag, count(*) as lines, sum(cast(l_quantity as decimal(18,4))) as qty
from (select *, case when l_quantity < 5 then 'tiny' when l_extendedprice > 80000 then 'dear'
        when l_quantity >= 30 then 'bulk' else 'plain' end as size_class from lineitem)
group by all""")
def classify_case(i):
    size = (F.when(F.col("l_quantity") < 5, "tiny").when(F.col("l_extendedprice") > 80000, "dear")
            .when(F.col("l_quantity") >= 30, "bulk").otherwise("plain"))
    return i.raw("lineitem").groupBy(size.alias("size_class"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast(M)).alias("qty"))


@query("fk_unknown", """
with d as (select 'N' || n_nationkey as site_code, n_name as site_name from nation
           union all select 'UNKNOWN', 'Unresolved')
select d.site_code, d.site_name, count(c_custkey) as customers
from d left join (select c_custkey, coalesce('N' || case when c_custkey % 11 <> 0
    then c_nationkey end, 'UNKNOWN') as fk from customer) on fk = d.site_code
group by all""")
def fk_unknown(i):
    """Unresolved keys land on the UNKNOWN member, so an inner view loses nothing."""
    from ..operators.dims import with_unknown
    dim = with_unknown(i.facility.select("site_code", "site_name"), "site_code", "site_name")
    nation = F.when(F.col("c_custkey") % 11 != 0, txt(F.col("c_nationkey")))
    facts = i.raw("customer").groupBy(clean.fk(nation, "N").alias("site_code")).agg(
        F.count(F.lit(1)).alias("customers"))
    return dim.join(facts, "site_code", "left").withColumn(
        "customers", F.coalesce("customers", F.lit(0)))


# ------------------------------------------------------------- joins


@query("split_lines", "select * from int_line")
def split_lines(i):
    return order_line(i.sorderq, i.sorderp)


@query("left_composite", """
select p.supplier_invoice_number, p.supplier_invoice_line_number, r.received_qty, r.receipt_date
from pinvoiced p left join preceiptd r on r.receipt_number = p.receipt_number
  and r.purchase_order_number = p.purchase_order_number
  and r.purchase_order_line_number = p.purchase_order_line_number""")
def left_composite(i):
    on = ["receipt_number", "purchase_order_number", "purchase_order_line_number"]
    return i.pinvoiced.join(i.preceiptd, on, "left").select(
        "supplier_invoice_number", "supplier_invoice_line_number", "received_qty", "receipt_date")


@query("prefix_join", """
select company_id, s, count(customer_code) as matches, min(customer_code) as first_code
from hs left join x3 on length(s) >= 12 and starts_with(x3.a, s)
group by company_id, s""")
def prefix_join(i):
    """Prefix match with a length guard, as an equi join on folded prefixes."""
    left = i.company.select("company_id", keys.domain_stem(F.col("domain")).alias("s"))
    right = i.bpcustomer.select(
        "customer_code", keys.name_alnum(F.col("customer_name")).alias("a"))
    return match.prefix_match_counts(left, "s", right, "a", "customer_code")


@query("semi_window", """
select l_orderkey, l_linenumber, l_quantity from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderdate >= timestamp '2000-01-01')""")
def semi_window(i):
    """Lines whose order is inside the window; the window filter reaches the scan."""
    return landing.read_header_window(
        i.raw("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
        i.raw("orders"), "l_orderkey", "o_orderdate", dt.date(2000, 1, 1), "o_orderkey")


@query("children_for", """
select l_orderkey, l_linenumber, l_returnflag from lineitem
where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'P')""")
def children_for(i):
    parents = i.raw("orders").where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("l_orderkey"))
    return landing.children_for(
        i.raw("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), parents,
        "l_orderkey")


@query("anti_not_exists", """
select company_id, company_name from hs where not exists (select 1 from x3 where x3.a = hs.a)""")
def anti_not_exists(i):
    known = i.bpcustomer.select(keys.name_alnum(F.col("customer_name")).alias("a"))
    asked = i.company.select("company_id", "company_name",
                             keys.name_alnum(F.col("company_name")).alias("a"))
    return asked.join(known, "a", "left_anti").drop("a")


@query("orphan_left_null", """
select p_partkey, p_name from part left join
  (select distinct l_partkey from lineitem where year(l_shipdate) = 1995) on l_partkey = p_partkey
where l_partkey is null""")
def orphan_left_null(i):
    sold = i.raw("lineitem").where(F.year("l_shipdate") == 1995).select(
        F.col("l_partkey").alias("p_partkey"))
    return i.raw("part").select("p_partkey", "p_name").join(sold, "p_partkey", "left_anti")


@query("cross_one_row", """
select o_custkey, total, total / grand as share from (
  select o_custkey, cast(sum(cast(o_totalprice as decimal(18,4))) as double) as total
  from orders group by 1) cross join (
  select cast(sum(cast(o_totalprice as decimal(18,4))) as double) as grand from orders)""")
def cross_one_row(i):
    """Each customer against the grand total, which is one broadcast row."""
    per = i.raw("orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast(M)).alias("t"))
    grand = i.raw("orders").agg(F.sum(F.col("o_totalprice").cast(M)).alias("g"))
    return per.crossJoin(F.broadcast(grand)).select(
        "o_custkey", F.col("t").cast("double").alias("total"),
        (F.col("t").cast("double") / F.col("g").cast("double")).alias("share"))


@query("explode_refs", """
select deal_id, trim(part) as reference_part
from (select deal_id, unnest(string_split(erp_order_number_raw, '/')) as part from deal
      where erp_order_number_raw is not null)
where trim(part) <> ''""")
def explode_refs(i):
    part = F.trim(F.col("_p"))
    return i.deal.withColumn("_p", F.explode(F.split("erp_order_number_raw", "/"))).where(
        part != "").select("deal_id", part.alias("reference_part"))


@query("scalar_sub", """
select o_orderkey, o_totalprice * 2 as o_totalprice from orders where o_orderkey % 3 <> 0""")
def scalar_sub(i):
    """Rows of the newest of two loads; the newest id is a one-row join."""
    orders = i.raw("orders").select("o_orderkey", "o_totalprice")
    day = lambda n: F.lit(dt.date(2002, 1, n))
    old = orders.withColumns({"load_id": F.lit("0001"), "load_date": day(1)})
    new = orders.where("o_orderkey % 3 <> 0").withColumns({
        "o_totalprice": F.col("o_totalprice") * 2, "load_id": F.lit("0002"), "load_date": day(2)})
    return landing.project_replace(old.unionByName(new))


# ------------------------------------------------------------- aggregates


@query("agg_basic", f"""
select l_returnflag, l_linestatus, count(*) as lines, count(l_partkey) as parts,
  sum(cast(l_quantity as {M})) as qty, min(l_extendedprice) as low, max(l_extendedprice) as high,
  cast(sum(cast(l_discount as {M})) as double) / count(*) as mean_discount
from lineitem group by 1, 2""")
def agg_basic(i):
    return i.raw("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.count("l_partkey").alias("parts"),
        F.sum(F.col("l_quantity").cast(M)).alias("qty"),
        F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"),
        clean.ratio(F.sum(F.col("l_discount").cast(M)), F.count(F.lit(1))).alias("mean_discount"))


@query("agg_distinct", """
select l_returnflag, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts,
  count(distinct l_suppkey) as suppliers
from lineitem group by 1""")
def agg_distinct(i):
    return i.raw("lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"),
        F.countDistinct("l_suppkey").alias("suppliers"))


@query("agg_filter", f"""
select l_suppkey, sum(cast(l_quantity as {M})) filter (where l_returnflag = 'R') as returned,
  count(*) filter (where l_linestatus = 'O') as open_lines,
  max(l_extendedprice) filter (where l_discount > 0.05) as top_discounted
from lineitem group by 1""")
def agg_filter(i):
    c = F.col
    return i.raw("lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(c("l_returnflag") == "R", c("l_quantity").cast(M))).alias("returned"),
        F.count_if(c("l_linestatus") == "O").alias("open_lines"),
        F.max(F.when(c("l_discount") > 0.05, c("l_extendedprice"))).alias("top_discounted"))


@query("select_distinct", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def select_distinct(i):
    return i.raw("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("pivot_charges", """
select shipment_id,
  sum(charge_amount_usd) filter (where charge_code = 'FREIGHT') as freight,
  sum(charge_amount_usd) filter (where charge_code = 'FUEL') as fuel,
  sum(charge_amount_usd) filter (where charge_code = 'DETENTION') as detention
from charge group by 1""")
def pivot_charges(i):
    """A fixed value list keeps the pivot one aggregation, without a look at the data."""
    return (i.charge.groupBy("shipment_id").pivot("charge_code", ["FREIGHT", "FUEL", "DETENTION"])
            .agg(F.sum("charge_amount_usd"))
            .withColumnsRenamed({"FREIGHT": "freight", "FUEL": "fuel", "DETENTION": "detention"}))


@query("arg_min_max", """
select o_custkey, arg_min(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) as first_order,
  arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) as last_order,
  arg_max(case when o_orderkey % 2 = 0 then o_orderpriority end,
    struct_pack(d := o_orderdate, k := o_orderkey)) as last_even_priority
from orders group by 1""")
def arg_min_max(i):
    """Ties broken by key; a null value never wins, as its order key is left null."""
    at = F.struct("o_orderdate", "o_orderkey")
    even = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    return i.raw("orders").groupBy("o_custkey").agg(
        F.min_by("o_orderkey", at).alias("first_order"),
        F.max_by("o_orderkey", at).alias("last_order"),
        F.max_by(even, F.when(even.isNotNull(), at)).alias("last_even_priority"))


@query("bool_listagg", """
select n_regionkey, bool_or(n_nationkey % 7 = 0) as any_seventh, count(*) as n_items,
  string_agg(n_name, ',' order by n_name) as names, sum(customers)::bigint as customers
from nation join (select c_nationkey, count(*) as customers from customer group by 1)
  on c_nationkey = n_nationkey
group by 1""")
def bool_listagg(i):
    """Ordered text list per group, complete for every group."""
    n = i.raw("nation").join(
        i.raw("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
            F.count(F.lit(1)).alias("customers")), "n_nationkey")
    flags = n.groupBy("n_regionkey").agg(
        F.bool_or(F.col("n_nationkey") % 7 == 0).alias("any_seventh"),
        F.sum("customers").alias("customers"))
    return flags.join(text_list(n, ["n_regionkey"], "n_name", ",", "names"), "n_regionkey")


@query("median_by", """
select c_mktsegment, median(cast(c_acctbal as double)) as median_balance
from customer group by 1""")
def median_by(i):
    return exact_median(i.raw("customer"), ["c_mktsegment"], "c_acctbal", "median_balance")


@query("median_global", "select median(l_extendedprice) as median_price from lineitem")
def median_global(i):
    """A median over everything, without sorting everything in one task."""
    return exact_median(i.raw("lineitem"), [], "l_extendedprice", "median_price")


@query("having_dups", """
select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2
having count(*) > 1""")
def having_dups(i):
    return i.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("copies")).where("copies > 1")


@query("group_by_expr", """
select cast(date_trunc('month', o_orderdate) as date) as order_month, o_orderkey % 3 as third,
  count(*) as orders
from orders group by 1, 2""")
def group_by_expr(i):
    return i.raw("orders").groupBy(
        F.trunc("o_orderdate", "MM").alias("order_month"), (F.col("o_orderkey") % 3).alias("third")
    ).agg(F.count(F.lit(1)).alias("orders"))


@query("agg_global", f"""
select count(*) as lines, sum(cast(l_quantity as {M})) as qty,
  count(distinct l_suppkey) as suppliers from lineitem""")
def agg_global(i):
    return i.raw("lineitem").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast(M)).alias("qty"),
        F.countDistinct("l_suppkey").alias("suppliers"))


@query("ratio_of_sums", f"""
select l_returnflag, cast(sum(cast(l_extendedprice as {M}) * cast(l_discount as {M})) as double)
    / nullif(cast(sum(cast(l_extendedprice as {M})) as double), 0) as discount_rate,
  cast(1 as double) / nullif(cast(sum(case when l_quantity < 0 then 1 else 0 end) as double), 0)
    as guarded
from lineitem group by 1""")
def ratio_of_sums(i):
    price, disc = F.col("l_extendedprice").cast(M), F.col("l_discount").cast(M)
    none = F.sum(F.when(F.col("l_quantity") < 0, 1).otherwise(0))
    return i.raw("lineitem").groupBy("l_returnflag").agg(
        clean.ratio(F.sum(price * disc), F.sum(price)).alias("discount_rate"),
        clean.ratio(F.lit(1), none).alias("guarded"))


@query("weighted_ratio", f"""
select l_suppkey, cast(sum(cast(l_quantity as {M}) * cast(l_tax as {M})) as double)
  / cast(sum(cast(l_quantity as {M})) as double) as weighted_tax
from lineitem group by 1""")
def weighted_ratio(i):
    qty = F.col("l_quantity").cast(M)
    return i.raw("lineitem").groupBy("l_suppkey").agg(
        clean.ratio(F.sum(qty * F.col("l_tax").cast(M)), F.sum(qty)).alias("weighted_tax"))


@query("hll_rollup", """
select count(distinct o_custkey) as exact_customers, true as within_5_pct from orders""")
def hll_rollup(i):
    """Sketches per month merged upwards, against the exact distinct count."""
    monthly = i.raw("orders").groupBy(F.trunc("o_orderdate", "MM").alias("m")).agg(
        F.hll_sketch_agg("o_custkey", 14).alias("sketch"))
    merged = monthly.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx"))
    exact = i.raw("orders").agg(F.countDistinct("o_custkey").alias("exact_customers"))
    gap = F.abs(F.col("approx") - F.col("exact_customers"))
    return exact.crossJoin(F.broadcast(merged)).select(
        "exact_customers", (gap <= F.col("exact_customers") * 0.05).alias("within_5_pct"))


@query("stage_raw", """
select c_custkey as part_key, c_acctbal as balance, strftime(date '1992-01-01' + cast(c_custkey % 9 as int), '%Y-%m-%d')
  as seen_at, c_custkey % 2 = 0 as is_even from customer""")
def stage_raw(i):
    """Columns of types that no cleaning rule is for go through as they are, beside cleaned ones."""
    k = F.col("c_custkey")
    df = i.raw("customer").select(
        k.alias("PARTKEY_0"), F.col("c_acctbal").cast("double").alias("BAL_0"),
        F.to_timestamp(F.date_add(F.lit(dt.date(1992, 1, 1)), (k % 9).cast("int"))).alias("SEEN_0"), (k % 2 == 0).alias("EVEN_0"))
    spec = staging.spec_for("erp", "CUSTOM", df.schema, {
        "PARTKEY_0": "part_key", "BAL_0": "balance", "SEEN_0": "seen_at", "EVEN_0": "is_even"})
    assert [s.kind for s in spec] == ["int", "raw", "raw", "bool"]
    return staging.stage(df, spec).withColumn("seen_at", F.date_format("seen_at", "yyyy-MM-dd"))


# ------------------------------------------------------------- windows


@query("rank_flag", """
select o_orderkey, o_custkey, row_number() over w as order_rank, row_number() over w = 1
  as is_selected
from orders window w as (partition by o_custkey order by o_orderdate desc, o_orderkey)""")
def rank_flag(i):
    """All orders kept, ranked per customer; a customer with several tasks' share of the orders is ranked in pieces."""
    ranked = row_number(
        i.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"],
        ["-o_orderdate", "o_orderkey"], "order_rank")
    return ranked.select("o_orderkey", "o_custkey", "order_rank",
                         (F.col("order_rank") == 1).alias("is_selected"))


@query("rank_flag_split", """
select o_orderkey, o_custkey, row_number() over w as order_rank
from orders window w as (partition by o_custkey order by o_orderdate desc, o_orderkey)""")
def rank_flag_split(i):
    """The same ranking with so many cuts that most customers are ranked in pieces."""
    return row_number(
        i.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"],
        ["-o_orderdate", "o_orderkey"], "order_rank", parts=i.raw("orders").count() // 4).select("o_orderkey", "o_custkey", "order_rank")


@query("latest_per_key", """
select o_custkey, o_orderkey, o_orderdate, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def latest_per_key(i):
    """Newest row per key as a partial aggregate: one row per key leaves each task."""
    o = i.raw("orders")
    return o.groupBy("o_custkey").agg(F.max(F.struct(
        "o_orderdate", "o_orderkey", "o_totalprice")).alias("r")).select(
        "o_custkey", "r.o_orderkey", "r.o_orderdate", "r.o_totalprice")


@query("count_over", """
select o_orderkey, o_custkey, count(*) over (partition by o_custkey) as orders_of_customer
from orders""")
def count_over(i):
    """An unordered count per key: folded, then joined back, so no key is buffered."""
    o = i.raw("orders").select("o_orderkey", "o_custkey")
    n = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders_of_customer"))
    return o.join(n, "o_custkey")


LAG_SQL = """
select shipment_id, event_sequence, event_at,
  lag(event_at) over (partition by shipment_id order by event_sequence) as previous_at,
  first_value(event_at) over (partition by shipment_id order by event_sequence) as first_at
from event"""


@query("lag_gap", LAG_SQL)
def lag_gap(i):
    ev = i.event.select("shipment_id", "event_sequence", "event_at")
    return lag_first(ev, ["shipment_id"], "event_sequence", "event_at", "previous_at", "first_at")


@query("lag_gap_split", LAG_SQL)
def lag_gap_split(i):
    """The same with every key cut into short pieces; the pieces must join up."""
    ev = i.event.select("shipment_id", "event_sequence", "event_at")
    return lag_first(ev, ["shipment_id"], "event_sequence", "event_at", "previous_at", "first_at",
                     parts=400)


@query("first_in_key", """
select distinct shipment_id, first_value(event_code) over
  (partition by shipment_id order by event_sequence) as first_code from event""")
def first_in_key(i):
    return i.event.groupBy("shipment_id").agg(
        F.min_by("event_code", "event_sequence").alias("first_code"))


@query("order_by_key", """
select calendar_month, orders from (select month(o_orderdate) as calendar_month, count(*) as orders
  from orders group by 1) order by 1""")
def order_by_key(i):
    return i.raw("orders").groupBy(F.month("o_orderdate").alias("calendar_month")).agg(
        F.count(F.lit(1)).alias("orders")).orderBy("calendar_month")


# ------------------------------------------------------------- set operations


@query("union_probes", """
select company_id, 'exact_name' as probe from hs join (select distinct u from x3) using (u)
union all
select company_id, 'alnum_name' from hs join (select distinct a from x3) using (a)
union all
select company_id, 'core_name' from hs join (select distinct c from x3) using (c)""")
def union_probes(i):
    """Three probes stacked, each a semi join: which probes fire per company."""
    comp, cust = match.company_keys(i.company), match.customer_keys(i.bpcustomer)
    out = None
    for key, name in (("u", "exact_name"), ("a", "alnum_name"), ("c", "core_name")):
        one = comp.join(cust.select(key), key, "left_semi").select(
            "company_id", F.lit(name).alias("probe"))
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------- scalars


@query("string_funcs", """
select c_custkey, upper(trim('  ' || c_name || ' ')) as up, lower(c_name) as low,
  length(c_name) as len, starts_with(c_name, 'Customer#0000') as starts, strpos(c_name, '#') as at,
  string_split(c_name, '#')[2] as second, c_mktsegment || '-' || nullif(c_nationkey % 5, 0) as cat,
  concat_ws('-', c_mktsegment, nullif(c_nationkey % 5, 0)) as cat_ws,
  lpad(cast(c_nationkey as varchar), 4, '0') as padded,
  regexp_replace(c_name, '[0-9]', '', 'g') as no_digits,
  regexp_replace(c_name, '#.*$', '') as before_hash,
  regexp_matches(c_name, '^customer#[0-9]{8}[02468]$', 'i') as is_even,
  coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as seg
from customer""")
def string_funcs(i):
    n, seg = F.col("c_name"), F.col("c_mktsegment")
    five = F.nullif(F.col("c_nationkey") % 5, F.lit(0)).cast("string")
    return i.raw("customer").select(
        "c_custkey", F.upper(F.trim(F.concat(F.lit("  "), n, F.lit(" ")))).alias("up"),
        F.lower(n).alias("low"), F.length(n).alias("len"),
        F.startswith(n, F.lit("Customer#0000")).alias("starts"), F.instr(n, "#").alias("at"),
        F.split(n, "#")[1].alias("second"), F.concat(seg, F.lit("-"), five).alias("cat"),
        F.concat_ws("-", seg, five).alias("cat_ws"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("padded"),
        F.regexp_replace(n, "[0-9]", "").alias("no_digits"),
        F.regexp_replace(n, "#.*$", "").alias("before_hash"),
        n.rlike("(?i)^customer#[0-9]{8}[02468]$").alias("is_even"),
        F.coalesce(F.nullif(seg, F.lit("BUILDING")), F.lit("none")).alias("seg"))


@query("date_funcs", """
select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key,
  cast(try_strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') as date) as parsed,
  date_diff('day', cast(o_orderdate as date), date '2000-01-01') as days,
  cast(date_trunc('month', o_orderdate) as date) as m, cast(date_trunc('quarter', o_orderdate) as date)
    as q, cast(date_trunc('week', o_orderdate) as date) as w,
  cast(date_trunc('year', o_orderdate) as date) as y, year(o_orderdate) as yy,
  quarter(o_orderdate) as qq, month(o_orderdate) as mm, day(o_orderdate) as dd,
  week(o_orderdate) as ww, last_day(o_orderdate) as month_end, dayofweek(o_orderdate) as dow,
  monthname(o_orderdate) as month_name, dayname(o_orderdate) as day_name,
  cast(cast(o_orderdate as date) - to_months(3) as date) as three_back,
  cast(o_orderdate as date) <= date '1999-12-31' as is_past
from orders""")
def date_funcs(i):
    d = F.col("o_orderdate").cast("date")
    return i.raw("orders").select(
        "o_orderkey", clean.date_key(d).alias("date_key"),
        clean.clean_pdate(F.date_format(d, "MM/dd/yyyy")).alias("parsed"),
        F.datediff(F.lit(dt.date(2000, 1, 1)), d).alias("days"),
        F.trunc(d, "MM").alias("m"), F.trunc(d, "QUARTER").alias("q"),
        F.trunc(d, "WEEK").alias("w"), F.trunc(d, "YEAR").alias("y"), F.year(d).alias("yy"),
        F.quarter(d).alias("qq"), F.month(d).alias("mm"), F.dayofmonth(d).alias("dd"),
        F.weekofyear(d).alias("ww"), F.last_day(d).alias("month_end"),
        (F.dayofweek(d) - 1).alias("dow"), F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"), F.add_months(d, -3).alias("three_back"),
        (d <= F.lit(dt.date(1999, 12, 31))).alias("is_past"))


@query("date_range", """
select cast(d as date) as day, count(o_orderkey) as orders
from (select unnest(range(min(o_orderdate), max(o_orderdate) + interval 1 day, interval 1 day)) as d
      from orders) left join orders on o_orderdate = d
group by 1""")
def date_range(i):
    """Every day of the data's own span, with its orders."""
    o = i.raw("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"))
    days = o.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.join(o, "day", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("math_casts", f"""
select l_orderkey, l_linenumber, abs(l_quantity - 25) as off, round(l_extendedprice, 0) as rounded,
  cast(l_quantity as bigint) as whole, cast(l_extendedprice as {M}) as money,
  try_cast(case when l_orderkey % 7 = 0 then 'x' else cast(l_orderkey as varchar) end as bigint)
    as tried, l_extendedprice / nullif(l_quantity - 10, 0) as guarded,
  l_quantity is distinct from l_linenumber as differs
from lineitem""")
def math_casts(i):
    c = F.col
    text = F.when(c("l_orderkey") % 7 == 0, "x").otherwise(txt(c("l_orderkey")))
    return i.raw("lineitem").select(
        "l_orderkey", "l_linenumber", F.abs(c("l_quantity") - 25).alias("off"),
        F.round("l_extendedprice", 0).alias("rounded"), c("l_quantity").cast("bigint").alias("whole"),
        c("l_extendedprice").cast(M).alias("money"), text.try_cast("bigint").alias("tried"),
        (c("l_extendedprice") / F.nullif(c("l_quantity") - 10, F.lit(0.0))).alias("guarded"),
        clean.differs(c("l_quantity"), c("l_linenumber")).alias("differs"))


@query("surrogate_key", """
select c_custkey, md5(concat_ws('-', coalesce(cast(c_custkey as varchar),
  '_dbt_utils_surrogate_key_null_'), coalesce(nullif(c_mktsegment, 'BUILDING'),
  '_dbt_utils_surrogate_key_null_'))) as skey
from customer""")
def surrogate_key(i):
    return i.raw("customer").select("c_custkey", clean.surrogate_key(
        F.col("c_custkey"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("skey"))


@query("macro_keys", """
select company_id, u, a, c, s, upper(trim(industry) || ' ' || trim(country)) as person from hs""")
def macro_keys(i):
    n = F.col("company_name")
    return i.company.select(
        "company_id", keys.name_upper(n).alias("u"), keys.name_alnum(n).alias("a"),
        keys.name_core(n).alias("c"), keys.domain_stem(F.col("domain")).alias("s"),
        keys.person_key(F.col("industry"), F.col("country")).alias("person"))
