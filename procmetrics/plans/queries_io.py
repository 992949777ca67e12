"""Reading, landing, projecting, exporting and streaming, through shared storage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.joins import tasks_for
from ..session import scratch
from ..sources import landing, publish
from ..sources.catalog import TableSpec, table_spec
from ..sources.contract import check_drift, contract_schema, drift_frame, drift_impact, freeze
from ..streaming import jobs
from .inputs import Inputs, tag
from .models import Models
from .registry import query

DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
ORDERS = TableSpec("erp", "orders", "modified_date", ("o_orderkey",), "o_orderdate")
PARTS = TableSpec("planning", "part", "snapshot", ("p_partkey",))
SINCE = dt.date(2000, 1, 1)


@query("read_full", "select p_partkey, p_brand from part")
def read_full(i):
    """Pinned schema, enumerated columns: the scan reads two columns."""
    schema = i.raw("part").schema
    return landing.read_full(i.spark, f"{i.root}/part.parquet", schema, ["p_partkey", "p_brand"])


@query("read_modified", """
select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '2000-01-01'""")
def read_modified(i):
    return landing.read_modified_since(
        i.raw("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", SINCE)


@query("read_with_archived", """
select c_custkey, c_name, c_custkey % 37 = 0 as archived from customer where c_acctbal >= 0""")
def read_with_archived(i):
    """Live and archived passes, both inside the window, both kept."""
    c = i.raw("customer").withColumn("mark", F.when(F.col("c_acctbal") >= 0, F.lit(SINCE)))
    live, gone = c.where("c_custkey % 37 <> 0"), c.where("c_custkey % 37 = 0")
    return landing.read_with_archived(live, gone, "mark", SINCE).select(
        "c_custkey", "c_name", "archived")


@query("high_water", """
select 'erp' as source_name, 'orders' as table_name, cast(max(o_orderdate) as date)
  as high_water_mark, cast(max(o_orderdate) as date) - 90 as window_start from orders""")
def high_water(i):
    """The mark after two reads, the second one older: it does not move back."""
    spark = i.spark
    state = spark.createDataFrame([], landing.STATE_SCHEMA)
    state = landing.advance(state, ORDERS, i.raw("orders"), "o_orderdate")
    older = i.raw("orders").where("year(o_orderdate) < 1997")
    state = landing.advance(state, ORDERS, older, "o_orderdate")
    return state.withColumn("window_start", landing.late_window(
        F.col("high_water_mark"), ORDERS.lookback_days))


def _land_orders(i):
    """Two load packages: all orders, then the window with changed totals."""
    root = scratch(i.spark, "landing")
    o = i.raw("orders")
    landing.land(o, root, ORDERS, "20240101T000000", DAY1)
    changed = landing.read_modified_since(o, "o_orderdate", SINCE).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1)
    landing.land(changed, root, ORDERS, "20240102T000000", DAY2)
    return root, o.schema


@query("land_append", """
select load_date, count(*) as rows, 1 as load_packages from (
  select date '2024-01-01' as load_date from orders
  union all select date '2024-01-02' from orders where o_orderdate >= timestamp '2000-01-01')
group by 1""")
def land_append(i):
    root, schema = _land_orders(i)
    return landing.rows_by_load_date(landing.scan_landing(i.spark, root, ORDERS, schema))


@query("scan_pruned", """
select count(*) as rows from orders where o_orderdate >= timestamp '2000-01-01'""")
def scan_pruned(i):
    """Only the newer load_date folder is read."""
    root, schema = _land_orders(i)
    return landing.scan_landing(i.spark, root, ORDERS, schema, since=DAY2).agg(
        F.count(F.lit(1)).alias("rows"))


@query("project_merge", """
select o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
  case when o_orderdate >= timestamp '2000-01-01' then o_totalprice + 1 else o_totalprice end
    as o_totalprice
from orders""")
def project_merge(i):
    root, schema = _land_orders(i)
    return landing.project(landing.scan_landing(i.spark, root, ORDERS, schema), ORDERS)


@query("project_replace", "select * from part where p_partkey % 5 <> 0")
def project_replace(i):
    """Snapshot semantics: the newest package alone is the truth."""
    root = scratch(i.spark, "landing")
    p = i.raw("part")
    landing.land(p, root, PARTS, "0001", DAY1)
    landing.land(p.where("p_partkey % 5 <> 0"), root, PARTS, "0002", DAY2)
    return landing.current(i.spark, root, PARTS)


@query("project_replace_late", "select * from part where p_partkey % 5 <> 0")
def project_replace_late(i):
    """The newest load lies in the older folder, and was landed twice."""
    root = scratch(i.spark, "landing")
    p = i.raw("part")
    landing.land(p, root, PARTS, "0001", DAY2)
    for _ in range(2):
        landing.land(p.where("p_partkey % 5 <> 0"), root, PARTS, "0002", DAY1)
    return landing.current(i.spark, root, PARTS, p.schema)


@query("landing_status", """
select 'erp' as source_name, 'orders' as table_name, (select count(*) from orders) + (select count(*) from orders
    where o_orderdate >= timestamp '2000-01-01') as rows, 2 as load_packages, 2 as load_dates,
  date '2024-01-01' as first_load_date, date '2024-01-02' as last_load_date,
  (select max(o_orderdate)::date from orders) as high_water_mark
union all
select 'planning', 'part', (select count(*) from part), 1, 1, date '2024-01-02', date '2024-01-02', null
union all
select 'erp', 'customer', 0, 0, 0, null, null, null""")
def landing_status(i):
    """Two packages of the orders, one landed twice of the parts, which have no cursor, none of the customers."""
    root, _ = _land_orders(i)
    for _ in range(2):
        landing.land(i.raw("part"), root, PARTS, "20240102T000000", DAY2)
    return landing.landing_status(landing.ledger(i.spark, root), [
        ORDERS, PARTS, TableSpec("erp", "customer", "full_refresh", ("c_custkey",))])


@query("land_again", """
select date '2024-01-01' as load_date, count(*) as rows, 1 as load_packages from part""")
def land_again(i):
    """A package that is landed twice is there once; one that was lost on the way and comes under another date too."""
    root = scratch(i.spark, "landing")
    p = i.raw("part")
    lost = p.where("p_partkey % 3 = 0").withColumns({
        "load_id": F.lit("0001"), "load_date": F.lit(DAY2), "package": F.lit("p-0001")})
    lost.write.partitionBy("load_date", "package").parquet(landing.landing_path(root, PARTS))
    for _ in range(2):
        landing.land(p, root, PARTS, "0001", DAY1)
    return landing.rows_by_load_date(landing.scan_landing(i.spark, root, PARTS, p.schema))


@query("file_drop", """
select cast(c_custkey as varchar) as employee_code, nullif(c_mktsegment, 'BUILDING')
  as department_code from customer where c_custkey % 3 = 0""")
def file_drop(i):
    """The newest dated CSV of two, read by header, all text, blanks as null."""
    folder = scratch(i.spark, "drop")
    rows = i.raw("customer").select(
        F.col("c_custkey").cast("string").alias("employee_code"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
        .alias("department_code"))
    old = rows
    new = rows.where("cast(employee_code as bigint) % 3 = 0").select(
        "department_code", "employee_code")
    for day, df in (("20240101", old), ("20240102", new)):
        df.write.option("header", True).csv(f"{folder}/EMPLOYEE_{day}.csv")
    return landing.read_latest_drop(i.spark, folder, "employee", dt.date(2024, 1, 3))


@query("file_drop_breaks", """
select cast(c_custkey as varchar) as employee_code, c_name || chr(10) || '"' || c_mktsegment || '"' || chr(10) || ', end'
  as note, case when c_custkey % 4 > 0 then c_name end as label from customer""")
def file_drop_breaks(i):
    """A drop with quotes and line breaks in its fields, read in ranges."""
    folder = scratch(i.spark, "drop")
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('"\n, end'))
    rows = i.raw("customer").select(
        F.col("c_custkey").cast("string").alias("employee_code"), note.alias("note"),
        F.when(F.col("c_custkey") % 4 > 0, F.col("c_name")).alias("label"))
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{folder}/EMPLOYEE_20240102.csv")
    return landing.read_latest_drop(i.spark, folder, "employee", dt.date(2024, 1, 3))


@query("contract_read", """
select c_custkey, c_name, cast(c_acctbal as decimal(15,2)) as c_acctbal, cast(null as varchar) as c_note,
  cast(null as date) as c_since from customer""")
def contract_read(i):
    """Customers read by a contract that names types, and columns their files do not have yet."""
    contract = {"erp": {"customer": {
        "c_custkey": "bigint", "c_name": "text", "c_acctbal": {"data_type": "decimal", "precision": 15, "scale": 2},
        "c_note": "text", "c_since": "date"}}}
    path = scratch(i.spark, "customer")
    i.raw("customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(15,2)").alias("c_acctbal"),
                             "c_nationkey").write.parquet(path)
    return landing.read_full(i.spark, path, contract_schema(contract, "erp", "customer"))


@query("drift", """
select 'erp' as source_name, 'customer' as table_name, * from (
  select 'c_acctbal' as column_name, 'lost' as change, count(c_acctbal) as values_affected
  from customer
  union all
  select 'c_extra', 'new', count(*) filter (where c_custkey % 3 = 0) from customer)""")
def drift(i):
    """A lost and a new column against the frozen contract, with the values each concerns."""
    before = i.raw("customer")
    after = before.drop("c_acctbal").withColumn("c_extra", F.when(F.col("c_custkey") % 3 == 0, 1))
    found = check_drift(freeze({("erp", "customer"): before}), "erp", "customer", after)
    changes = drift_frame(i.spark, [found])
    counts = drift_impact(found, before, after)
    return changes.join(counts, ["column_name", "change"])


@query("reconcile_keys", """
select o_orderkey, case when o_orderkey % 7 = 0 then 'missing_here'
  when o_orderkey % 11 = 0 then 'deleted_in_source' else 'kept' end as state
from orders where not (o_orderkey % 7 = 0 and o_orderkey % 11 = 0)""")
def reconcile_keys(i):
    k = F.col("o_orderkey")
    o = i.raw("orders").select("o_orderkey")
    return landing.reconcile_keys(o.where(k % 7 != 0), o.where(k % 11 != 0), ["o_orderkey"])


@query("soft_delete", """
select c_custkey, c_name, c_custkey % 9 = 0 as is_deleted_in_source from customer""")
def soft_delete(i):
    c = i.raw("customer")
    return landing.soft_delete(c.select("c_custkey", "c_name"), c.where("c_custkey % 9 <> 0"),
                               ["c_custkey"])


@query("export", """
select 'dim_carrier' as table_name, count(*) as row_count, 7 as column_count from d_carrier
union all select 'dim_site', count(*), 14 from d_site
union all select 'mtr_inventory_accuracy', count(*), 8 from (
  select distinct count_date_key, site_code, item_code from f_count)""")
def export(i):
    m = Models(i)
    tables = {"dim_carrier": m.dim_carrier, "dim_site": m.dim_site,
              "mtr_inventory_accuracy": m.catalog().metric("inventory_accuracy")}
    return publish.export(tables, scratch(i.spark, "export"))


@query("publish_layers", """
select (select count(*) from customer) as staged, (select count(*) from customer) as as_view,
  (select count(*) from customer) as as_parquet""")
def publish_layers(i):
    """One frame as a view and as Parquet, both read back."""
    name = "procmetrics_customers"
    c = i.raw("customer").select("c_custkey", "c_name")
    view = publish.publish(c, name)
    files = publish.publish(c, f"{name}_files", "parquet", scratch(i.spark, "publish"))
    counted = lambda df, n: df.agg(F.count(F.lit(1)).alias(n))
    return counted(c, "staged").crossJoin(F.broadcast(counted(view, "as_view"))).crossJoin(
        F.broadcast(counted(files, "as_parquet")))


#: Source lines that one bucket of published lines holds about.
LINES_PER_BUCKET = 500_000


@query("publish_bucketed", """
select sales_order_number, sales_order_line_number, q.ordered_qty, l.line_net_amount, d.invoiced_amount
from sorderq q join sorderp l using (sales_order_number, sales_order_line_number)
left join (select sales_order_number, sales_order_line_number, sum(line_net_amount) as invoiced_amount
           from sinvoiced group by 1, 2) d using (sales_order_number, sales_order_line_number)""")
def publish_bucketed(i):
    """Order lines, their prices and invoice lines published in buckets of the line key; joined and folded without a shuffle."""
    key = ("sales_order_number", "sales_order_line_number")
    name = scratch(i.spark, "lines").rsplit("/", 1)[1].replace("-", "_")
    # a bucket is one task's work however many lines there are
    buckets = max(8, tasks_for(i.raw("lineitem").count(), LINES_PER_BUCKET))
    quantity, price, invoiced = (
        publish.publish(df.select(*key, *rest), f"{name}_{n}", "table", scratch(i.spark, "bucketed"), bucket_by=key,
                        buckets=buckets)
        for n, df, rest in (("q", i.sorderq, ["ordered_qty"]), ("p", i.sorderp, ["line_net_amount"]),
                            ("d", i.sinvoiced, ["line_net_amount"])))
    folded = invoiced.groupBy(*key).agg(F.sum("line_net_amount").alias("invoiced_amount"))
    return quantity.join(price.hint("merge"), list(key)).join(folded.hint("merge"), list(key), "left")


@query("seed_crosswalk", """
select c_custkey, coalesce(p, 'none') as paycom_location_code from customer left join (values
  (0, 'DAL-01'), (1, 'RNO-01'), (2, 'TOR-01')) t(n, p) on n = c_nationkey""")
def seed_crosswalk(i):
    """The packaged site crosswalk with pinned types, joined to the customers."""
    site = F.when(F.col("c_nationkey") == 0, "US001").when(F.col("c_nationkey") == 1, "US002").when(
        F.col("c_nationkey") == 2, "CA001")
    links = publish.load_seed(i.spark, "site_code_crosswalk").select(
        "x3_site_code", "paycom_location_code")
    return i.raw("customer").select("c_custkey", site.alias("x3_site_code")).join(
        links, "x3_site_code", "left").select(
        "c_custkey", F.coalesce("paycom_location_code", F.lit("none"))
        .alias("paycom_location_code"))


@query("trace", """
select (select count(*) from orders) as at_source, (select count(*) from orders)
    + (select count(*) from orders where o_orderdate >= timestamp '2000-01-01') as in_archive,
  (select count(*) from orders) as landed, (select count(*) from ord) as staged,
  (select count(*) from f_ship) as modelled""")
def trace(i):
    from ..operators.quality import layer_trace
    root, schema = _land_orders(i)
    archive = landing.scan_landing(i.spark, root, ORDERS, schema)
    return layer_trace(i.spark, {
        "at_source": i.raw("orders"), "in_archive": archive,
        "landed": landing.project(archive, ORDERS), "staged": i.order,
        "modelled": Models(i).model("fct_shipment", {"shipment_id"})})


@query("lossless_two_paths", """
select 0 as differing_rows, count(*) as metric_rows from (select distinct ship_date_key,
  customer_key, site_code, carrier_scac from f_ship)""")
def lossless_two_paths(i):
    """The shipment cost metric built from the sources and from the archive's projection."""
    from ..operators.quality import lossless
    archive, current = scratch(i.spark, "landing"), scratch(i.spark, "raw")
    for name in ("orders", "lineitem", "customer", "part", "events"):
        df = i.raw(name)
        spec = TableSpec("erp", name, "full_refresh", ())
        landing.land(df.limit(0), archive, spec, "0001", DAY1)
        landing.land(df, archive, spec, "0002", DAY2)
        publish.publish(landing.current(i.spark, archive, spec, df.schema), f"raw_{name}", "parquet",
                        f"{current}/{name}.parquet")
    rows = [Models(inputs).catalog().metric("cost_per_shipment")
            for inputs in (i, Inputs(i.spark, current))]
    # a metric row stands for an order at least
    tasks = tasks_for(2 * i.raw("orders").count())
    differing = lossless(*rows, tasks=tasks).agg(F.count(F.lit(1)).alias("differing_rows"))
    return differing.crossJoin(F.broadcast(rows[1].agg(F.count(F.lit(1)).alias("metric_rows"))))


@query("extract_by_strategy", """
select 'header' as part, count(*) as rows from orders where o_orderdate >= timestamp '2000-01-01'
union all
select 'line', count(*) from lineitem where l_orderkey in (
  select o_orderkey from orders where o_orderdate >= timestamp '2000-01-01')""")
def extract_by_strategy(i):
    """Header and lines of the declared order tables, windowed through the header's date."""
    head = i.raw("orders").select(
        tag("SO", F.col("o_orderkey")).alias("SOHNUM_0"),
        F.col("o_orderdate").cast("date").alias("ORDDAT_0"),
        F.col("o_orderdate").cast("date").alias("UPDDAT_0"))
    lines = i.raw("lineitem").select(
        F.rpad(tag("SO", F.col("l_orderkey")), 20, " ").alias("SOHNUM_0"),
        F.col("l_linenumber").alias("SOPLIN_0"))
    tables = {"SORDER": head, "SORDERQ": lines}
    out = None
    for part, name in (("header", "SORDER"), ("line", "SORDERQ")):
        one = landing.extract(table_spec("erp", name), tables, SINCE).agg(
            F.count(F.lit(1)).alias("rows")).select(F.lit(part).alias("part"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------- streams


def _event_files(i):
    """The events as three arriving packages, the last one repeating rows."""
    folder = scratch(i.spark, "events")
    ev = i.event.withColumn("at", F.col("event_at").cast("timestamp"))
    third = F.col("event_sequence") % 3
    for n, part in enumerate((ev.where(third == 0), ev.where(third != 0),
                              ev.where(F.col("event_sequence") % 10 == 0))):
        part.write.mode("append").parquet(f"{folder}/package={n}")
    return folder, ev.schema


@query("stream_upsert", """
select user_id, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by event_id desc) = 1""")
def stream_upsert(i):
    """The newest event per user, kept up over two runs of arriving packages."""
    folder, target, mark = (scratch(i.spark, n) for n in ("in", "current", "checkpoint"))
    cols = ["user_id", "event_id", "event_type", "value"]
    ev = i.raw("events").select(*cols)
    for part in (ev.where("event_id % 2 = 0"), ev.where("event_id % 2 = 1")):
        part.write.mode("append").parquet(folder)
        jobs.stream_upsert(jobs.file_stream(i.spark, folder, ev.schema), ["user_id"],
                           ["event_id"], target, mark)
    return jobs.read_current(i.spark, target, ev.schema)


@query("stream_dedup", """
select shipment_id, event_sequence, event_code from event""")
def stream_dedup(i):
    folder, schema = _event_files(i)
    target, mark = scratch(i.spark, "dedup"), scratch(i.spark, "checkpoint")
    stream = jobs.file_stream(i.spark, folder, schema)
    jobs.stream_dedup(stream, ["shipment_id", "event_sequence"], "at", "90 days", target, mark)
    return i.spark.read.schema(schema).parquet(target).select(
        "shipment_id", "event_sequence", "event_code")


@query("stream_milestones", """
select shipment_id, picked_up_date, departed_facility_date, arrived_facility_date,
  out_for_delivery_date, delivered_event_date, exception_date,
  coalesce(in_transit_scan_count, 0) as in_transit_scan_count, event_count, had_exception,
  delivered_event_date is not null as is_delivered, out_of_sequence_event_count,
  has_out_of_sequence_events
from mile""")
def stream_milestones(i):
    """Milestones and sequence flags kept as streaming state, over batches that arrive out of order, equal the batch answer."""
    folder, target, mark = (scratch(i.spark, n) for n in ("in", "miles", "checkpoint"))
    ev = i.event
    for part in (ev.where("event_sequence % 2 = 0"), ev.where("event_sequence % 2 = 1")):
        part.write.mode("append").parquet(folder)
        # short stretches, so that most shipments have several
        jobs.stream_milestones(jobs.file_stream(i.spark, folder, ev.schema), target, mark,
                               lambda seq: F.floor(seq / 500))
    return jobs.read_milestones(i.spark, target, ev.schema)
