"""Exchange rates recovered from the ledger, and their lookup by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..functions.joins import BROADCAST_ROWS, measured_join
from ..policy import DEFAULT, Policy


def fx_rates(gl_lines: DataFrame, gl_headers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Volume-weighted rate per (currency, month) and per currency.

    The per-currency figures are folded from the monthly sums, not from the
    ledger again: currency × month rows instead of ledger lines. The output is
    bounded by currencies × months.
    """
    line = gl_lines.where("amount_document_currency <> 0").select(
        "journal_entry_number", "amount_document_currency", "amount_company_currency")
    head = gl_headers.where("accounting_date is not null").select(
        "journal_entry_number", "currency_code",
        F.trunc("accounting_date", "MM").alias("rate_month"))
    monthly = line.join(head, "journal_entry_number").groupBy("currency_code", "rate_month").agg(
        F.sum("amount_company_currency").alias("_local"),
        F.sum("amount_document_currency").alias("_doc"),
        F.count(F.lit(1)).alias("gl_line_count"),
    )
    # a currency's months are few rows: the ledger is joined and folded once
    whole = W.partitionBy("currency_code")
    rate = "decimal(18,6)"
    return monthly.select(
        "currency_code", "rate_month",
        ratio(F.col("_local"), F.col("_doc")).cast(rate).alias("rate_to_reporting_currency"),
        ratio(F.sum("_local").over(whole), F.sum("_doc").over(whole)).cast(rate).alias("fallback_rate"),
        "gl_line_count",
        F.lit(policy.reporting_currency).alias("reporting_currency"),
        F.lit(policy.fx_rate_source).alias("rate_source"),
    )


def with_fx(df: DataFrame, fx: DataFrame, currency: str, date_col: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """Adds ``fx_rate`` (month, else currency, else 1) and ``fx_rate_is_fallback``.

    The months of a currency are folded into one map, so a single join serves both the month and the fallback.
    A few currencies carry most lines, so ``df`` is never dealt by currency alone: ``fx``, a stored table, is
    measured, and either broadcast or met by (currency, month).
    """
    month = F.trunc(F.col(date_col), "MM")
    rates = fx.where("currency_code is not null").groupBy(F.col("currency_code").alias("_cur")).agg(
        F.map_from_entries(F.collect_list(
            F.struct("rate_month", "rate_to_reporting_currency"))).alias("_rates"),
        F.max("fallback_rate").alias("_fallback"),
    )
    joined = measured_join(df, rates, [(currency, "_cur")], month, "left", rows=fx.count(), most=most)
    return (
        joined.withColumn("_rate", F.try_element_at("_rates", month))
        .withColumns({
            "fx_rate": F.coalesce("_rate", "_fallback", F.lit(1).cast("decimal(18,6)")),
            "fx_rate_is_fallback": F.col("_rate").isNull(),
        })
        .drop("_rates", "_fallback", "_rate")
    )
