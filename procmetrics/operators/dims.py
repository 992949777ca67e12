"""Conformed dimensions. Each carries an UNKNOWN member, except the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import date_key
from ..policy import DEFAULT, Policy
from .staging import pad_columns


def with_unknown(df: DataFrame, key: str, label: str | None, policy: Policy = DEFAULT,
                 **values) -> DataFrame:
    """Append the UNKNOWN member: key, label, given values, typed nulls elsewhere."""
    row = {key: policy.unknown_key, **({label: policy.unknown_label} if label else {}), **values}
    one = df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()])
    return df.unionByName(pad_columns(one, df.schema))


def dim_carrier(carriers: DataFrame, shipments: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    volume = shipments.groupBy("carrier_scac").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        F.min("ship_date").alias("first_shipment_date"),
        F.max("ship_date").alias("last_shipment_date"),
    )
    dim = (
        carriers.select("carrier_scac", "carrier_name", "transport_mode")
        .join(volume, "carrier_scac", "left")
        .withColumn("is_active_carrier", F.col("shipment_count").isNotNull())
        .withColumn("shipment_count", F.coalesce("shipment_count", F.lit(0)))
    )
    return with_unknown(dim, "carrier_scac", "carrier_name", policy,
                        shipment_count=0, is_active_carrier=False)


def dim_site(facilities: DataFrame, companies: DataFrame, crosswalk: DataFrame,
             policy: Policy = DEFAULT) -> DataFrame:
    company = companies.select("company_code", "company_name", "legislation_code")
    links = crosswalk.select(F.col("x3_site_code").alias("_site"), "paycom_location_code",
                             "netstock_location_code")
    site = facilities.withColumnRenamed("company_code", "_company")
    dim = (
        site.join(company, F.col("_company") == F.col("company_code"), "left")
        .join(links, F.col("site_code") == F.col("_site"), "left")
        .select(
            "site_code", "site_short_name", "site_name", "city", "state_province",
            "country_code", "is_stock_site", "is_sales_site", "is_purchase_site",
            "company_code", "company_name", "legislation_code", "paycom_location_code",
            "netstock_location_code",
        )
    )
    return with_unknown(dim, "site_code", "site_name", policy,
                        site_short_name=policy.unknown_key, is_stock_site=False,
                        is_sales_site=False, is_purchase_site=False)


def dim_item(items: DataFrame, planning: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    plan = planning.groupBy(F.col("item_code").alias("_item")).agg(
        F.min("abc_class").alias("best_abc_class"),
        F.min("xyz_class").alias("best_xyz_class"),
        F.count(F.lit(1)).alias("planned_location_count"),
        F.bool_or(F.col("stockout_risk") == "HIGH").alias("has_high_stockout_risk"),
        F.max("last_sync_date").alias("netstock_last_sync_date"),
    )
    dim = items.join(plan, F.col("item_code") == F.col("_item"), "left").select(
        "item_code", "item_description", "item_description_2", "item_category_code",
        "statistical_group_1", "statistical_group_2", "statistical_group_3", "stock_unit",
        "item_status", (F.col("item_status") == "Active").alias("is_active_item"),
        "base_sales_price", "base_purchase_price", "item_weight", "ean_code",
        "created_date", "updated_date", "best_abc_class", "best_xyz_class",
        F.coalesce("planned_location_count", F.lit(0)).alias("planned_location_count"),
        F.coalesce("has_high_stockout_risk", F.lit(False)).alias("has_high_stockout_risk"),
        "netstock_last_sync_date",
        F.col("_item").isNotNull().alias("is_planned_in_netstock"),
    )
    return with_unknown(dim, "item_code", "item_description", policy, is_active_item=False,
                        planned_location_count=0, has_high_stockout_risk=False,
                        is_planned_in_netstock=False)


def calendar(days: DataFrame, as_of: dt.date, policy: Policy = DEFAULT) -> DataFrame:
    """Calendar and fiscal attributes for each ``date_day``."""
    d = F.col("date_day")
    f = F.add_months(d, -(policy.fiscal_year_start_month - 1))
    fy, fq = F.year(f), F.quarter(f)
    dow = F.dayofweek(d) - 1
    return days.select(
        "date_day", date_key(d).alias("date_key"),
        F.year(d).alias("calendar_year"), F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"), F.date_format(d, "MMMM").alias("calendar_month_name"),
        F.dayofmonth(d).alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.weekofyear(d).alias("iso_week"),
        F.trunc(d, "WEEK").alias("week_start_date"), F.trunc(d, "MM").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"), F.trunc(d, "QUARTER").alias("quarter_start_date"),
        F.trunc(d, "YEAR").alias("year_start_date"), dow.isin(0, 6).alias("is_weekend"),
        fy.alias("fiscal_year"), fq.alias("fiscal_quarter"),
        F.month(f).alias("fiscal_month_number"),
        F.lit(policy.fiscal_year_start_month).alias("fiscal_year_start_month"),
        F.concat(F.lit("FY"), fy).alias("fiscal_year_label"),
        F.concat(F.lit("FY"), fy, F.lit("-Q"), fq).alias("fiscal_quarter_label"),
        F.date_format(d, "yyyy-MM").alias("calendar_month_label"),
        (d <= F.lit(as_of)).alias("is_past_as_of_build"), F.lit(as_of).alias("built_on_date"),
        F.lit(policy.fiscal_year_start_month == 1).alias("fiscal_equals_calendar"),
    )


def dim_date(spark: SparkSession, as_of: dt.date, start: dt.date = dt.date(2024, 1, 1),
             end: dt.date = dt.date(2027, 12, 31), policy: Policy = DEFAULT) -> DataFrame:
    """One row per day, ``start`` to ``end`` inclusive; ``as_of`` is the build day."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day"))
    return calendar(days, as_of, policy)


def calendar_over(dates: DataFrame, col: str, as_of: dt.date, policy: Policy = DEFAULT) -> DataFrame:
    """The calendar of the whole years that ``col`` spans."""
    span = dates.agg(
        F.trunc(F.min(col), "YEAR").alias("lo"),
        F.date_sub(F.add_months(F.trunc(F.max(col), "YEAR"), 12), 1).alias("hi"),
    )
    return calendar(span.select(F.explode(F.sequence("lo", "hi")).alias("date_day")), as_of, policy)


def dim_customer(
    customers: DataFrame,
    partners: DataFrame,
    companies: DataFrame,
    matches: DataFrame,
    reps: DataFrame,
    policy: Policy = DEFAULT,
) -> DataFrame:
    """ERP customers with their CRM company, then CRM-only companies, then UNKNOWN.

    ``matches`` holds the selected match per company. One company survives per
    customer: highest confidence, then highest id, id and method taken together.
    The ERP wins on name and finance, the CRM on firmographics.
    """
    survivor = matches.groupBy("erp_customer_code").agg(
        F.max(F.struct("confidence", "crm_company_id", "match_method")).alias("best"),
        F.bool_or("is_ambiguous").alias("_ambiguous"),
        F.count(F.lit(1)).alias("_claims"),
    ).select("erp_customer_code", F.col("best.crm_company_id").alias("crm_company_id"),
             F.col("best.match_method").alias("match_method"),
             F.col("best.confidence").alias("match_confidence"), "_ambiguous", "_claims")
    crm = companies.select(
        F.col("company_id").alias("_company_id"), F.col("company_name").alias("crm_company_name"),
        "domain", "industry", "employee_count", "annual_revenue",
        F.col("country").alias("crm_country"), F.col("created_date").alias("crm_created_date"),
        F.col("is_archived").alias("crm_is_archived"))
    country = partners.select(F.col("partner_code").alias("_partner"), "country_code")
    rep = reps.select(F.col("rep_code").alias("_rep"), F.col("rep_name").alias("primary_rep_name"))
    claims = F.coalesce("_claims", F.lit(0))
    order = [
        "customer_key", "customer_code", "crm_company_id", "customer_name", "crm_company_name",
        "customer_group_code", "currency_code", "payment_term_code", "credit_limit_amount",
        "accounting_code", "primary_rep_code", "primary_rep_name", "secondary_rep_code",
        "country_code", "erp_created_date", "domain", "industry", "employee_count",
        "annual_revenue", "crm_country", "crm_created_date", "crm_is_archived", "source_scope",
        "match_method", "match_confidence", "match_is_ambiguous", "crm_candidate_count",
        "crm_company_count",
    ]
    erp = (
        customers.join(country, F.col("customer_code") == F.col("_partner"), "left")
        .join(survivor, F.col("customer_code") == F.col("erp_customer_code"), "left")
        .join(crm, F.col("crm_company_id") == F.col("_company_id"), "left")
        .join(rep, F.col("primary_rep_code") == F.col("_rep"), "left")
        .withColumns({
            "customer_key": F.concat(F.lit(policy.erp_key_prefix), "customer_code"),
            "erp_created_date": F.col("created_date"),
            "crm_is_archived": F.coalesce("crm_is_archived", F.lit(False)),
            "source_scope": F.when(F.col("crm_company_id").isNotNull(), "both")
            .otherwise("erp_only"),
            "match_is_ambiguous": F.coalesce("_ambiguous", F.lit(False)),
            "crm_candidate_count": claims,
            "crm_company_count": claims,
        })
        .select(*order)
    )
    matched = matches.select(F.col("crm_company_id").alias("_company_id"))
    only = crm.join(matched, "_company_id", "left_anti").withColumns({
        "customer_key": F.concat(F.lit(policy.crm_key_prefix), "_company_id"),
        "crm_company_id": F.col("_company_id"),
        "customer_name": F.col("crm_company_name"),
        "source_scope": F.lit("crm_only"),
        "match_is_ambiguous": F.lit(False),
        "crm_candidate_count": F.lit(0),
        "crm_company_count": F.lit(1),
    })
    both = erp.unionByName(pad_columns(only, erp.schema))
    return with_unknown(both, "customer_key", "customer_name", policy, crm_is_archived=False,
                        source_scope="unknown", match_is_ambiguous=False,
                        crm_candidate_count=0, crm_company_count=0)
