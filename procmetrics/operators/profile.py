"""Profiling of the sources: censuses, agreement checks and hit rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..functions.sequence import exact_median, lag_first


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def census(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def cost_agreement(shipments: DataFrame, charges: DataFrame) -> DataFrame:
    """Header cost against the sum of charge lines."""
    total = charges.groupBy("shipment_id").agg(F.sum("charge_amount_usd").alias("charge_total"))
    head, lines = F.col("header_cost_usd"), F.col("charge_total")
    return shipments.join(total, "shipment_id", "left").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if(lines.isNull()).alias("no_charge_lines"),
        F.sum(head).alias("header_total"),
        F.sum(lines).alias("charge_total"),
        F.count_if(F.abs(head - lines) < 0.01).alias("agree_to_cent"),
        F.round(ratio(F.sum(lines - head), F.count(lines - head)), 2).alias("mean_diff"),
    )


def charge_mix(charges: DataFrame) -> DataFrame:
    return charges.groupBy("charge_code").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("charge_amount_usd").alias("amount_usd"),
        F.countDistinct("currency_code").alias("currencies"))


def on_time(df: DataFrame, delivered: str, promised: str) -> DataFrame:
    on = F.count_if(F.col(delivered) <= F.col(promised))
    both = df.where(F.col(delivered).isNotNull() & F.col(promised).isNotNull())
    return both.agg(F.count(F.lit(1)).alias("delivered"), on.alias("on_time")).withColumn(
        "pct", share(F.col("on_time"), F.col("delivered")))


def status_completeness(df: DataFrame, status: str, date_col: str) -> DataFrame:
    return df.groupBy(F.col(status).alias("status")).agg(
        F.count(F.lit(1)).alias("shipments"), F.count(date_col).alias("has_delivered_date"))


def settlement(invoices: DataFrame, invoiced: str, paid: str, sentinel) -> DataFrame:
    """Completeness, days to pay on settled invoices, and the mean if unguarded."""
    days = F.datediff(paid, invoiced)
    open_ = F.col(paid) == F.lit(sentinel)
    rows = invoices.select(
        days.alias("_days"), F.when(~open_, days).alias("_settled"), open_.alias("_open"))
    figures = rows.agg(
        F.count(F.lit(1)).alias("invoices"),
        F.count_if("_open").alias("sentinel_unpaid"),
        share(F.count_if("_open"), F.count(F.lit(1))).alias("pct_unpaid"),
        F.round(ratio(F.sum("_settled"), F.count("_settled")), 1).alias("mean_days"),
        F.min("_settled").alias("min_days"), F.max("_settled").alias("max_days"),
        F.round(ratio(F.sum("_days"), F.count("_days")), 1).alias("mean_days_unguarded"),
    )
    middle = exact_median(rows, [], "_settled", "median_days")
    return figures.join(F.broadcast(middle))


def padding_census(columns: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per column whose value changes when trimmed."""
    out = None
    for name, (df, col) in columns.items():
        one = df.agg(F.count_if(F.col(col) != F.trim(col)).alias("padded_rows")).select(
            F.lit(name).alias("column_name"), "padded_rows")
        out = one if out is None else out.unionByName(one)
    return out


def padded_join(rows: DataFrame, col: str, master: DataFrame, key: str) -> DataFrame:
    """How many join rows the raw key finds, and how many the trimmed one.

    Both sides are folded to counts per key, so no joined row is formed.
    """
    keys = master.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_m"))
    folded = rows.groupBy(F.col(col).alias("_raw")).agg(F.count(F.lit(1)).alias("_n"))

    def joined(expr, name):
        return folded.withColumn("_t", expr).join(keys, F.col("_t") == F.col("_k")).agg(
            F.coalesce(F.sum(F.col("_n") * F.col("_m")), F.lit(0)).alias(name))

    naive = joined(F.col("_raw"), "naive_join_rows")
    return naive.join(F.broadcast(joined(F.trim("_raw"), "trimmed_join_rows")))


def link_rate(name: str, left: DataFrame, key: Column, right: DataFrame, right_key: Column
              ) -> DataFrame:
    """Rows, null keys and rows that find a partner, for one crosswalk link."""
    there = right.select(right_key.alias("_rk")).where("_rk is not null").distinct()
    return (
        left.select(key.alias("_lk"))
        .join(there, F.col("_lk") == F.col("_rk"), "left")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_lk").isNull()).alias("null_keys"),
             F.count("_rk").alias("linked"))
        .select(F.lit(name).alias("link"), "*", share(F.col("linked"), F.col("rows")).alias("pct"))
    )


def colliding_keys(df: DataFrame, key: Column) -> DataFrame:
    return df.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").agg(
        F.count(F.lit(1)).alias("colliding_names"))


def currency_spread(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.groupBy(F.col("currency_code").alias("currency")).agg(
            F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "currency", "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def implied_rates(gl_lines: DataFrame, gl_headers: DataFrame) -> DataFrame:
    rate = F.round(ratio(F.col("amount_company_currency"), F.col("amount_document_currency")), 4)
    head = gl_headers.select("journal_entry_number", "currency_code")
    return gl_lines.join(head, "journal_entry_number").groupBy(
        F.col("currency_code").alias("document_currency"), rate.alias("implied_rate")
    ).agg(F.count(F.lit(1)).alias("lines"))


def out_of_sequence_share(events: DataFrame, parts: int | None = None) -> DataFrame:
    ev = lag_first(events.select("shipment_id", "event_sequence", "event_at"), ["shipment_id"],
                   "event_sequence", "event_at", lag_out="_prev", parts=parts)
    late = F.count_if(F.col("event_at") < F.col("_prev"))
    return ev.agg(F.count(F.lit(1)).alias("events"), late.alias("out_of_sequence")).withColumn(
        "pct", share(F.col("out_of_sequence"), F.col("events"), 2))


def label_counts(df: DataFrame, code: str, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Rows per code with the code's label; folded first, labelled after."""
    n = df.groupBy(F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("rows"))
    names = labels.select(F.col(key).alias("_key"), F.col(label).alias("label"))
    return n.join(names, F.col("code") == F.col("_key"), "left").select("code", "label", "rows")


def revenue_by_quarter(lines: DataFrame, site: str, date_col: str, amount: str) -> DataFrame:
    return lines.groupBy(
        F.col(site).alias("site_code"), F.trunc(date_col, "QUARTER").alias("quarter")
    ).agg(F.sum(amount).alias("revenue"), F.count(F.lit(1)).alias("lines"))


def forecast_error_by_class(
    accuracy: DataFrame, classes: DataFrame, keys: list[str], group: tuple[str, ...] = ("abc_class",)
) -> DataFrame:
    """Median absolute percentage error per planning class."""
    group = list(group)
    j = accuracy.where("abs_pct_error is not null").join(classes.select(*keys, *group), keys)
    return exact_median(j, group, "abs_pct_error", "median_error", "periods")


def lead_time(orders: DataFrame, site: str, ordered: str, shipped: str, sentinel) -> DataFrame:
    """Order-to-ship days per site, the sentinel date read as not shipped."""
    ship = F.nullif(F.col(shipped), F.lit(sentinel))
    days = F.datediff(ship, F.col(ordered))
    return orders.groupBy(F.col(site).alias("site_code")).agg(
        F.count(F.lit(1)).alias("orders"), F.count(ship).alias("shipped"),
        F.round(ratio(F.sum(days), F.count(days)), 1).alias("mean_days"),
        F.min(days).alias("min_days"), F.max(days).alias("max_days"))


def scorecard(a: DataFrame, b: DataFrame, on: list[str], a_name: str, b_name: str) -> DataFrame:
    """Two asked metrics side by side on their shared labels."""
    left = a.select(*on, F.col("value").alias(a_name))
    right = b.select(*on, F.col("value").alias(b_name))
    return left.join(right, on, "full")
