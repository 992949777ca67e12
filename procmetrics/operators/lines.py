"""Order lines rejoined from two tables, and shipment charges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import differs
from ..functions.joins import dealt

LINE_KEY = ["sales_order_number", "sales_order_line_number"]

# fixed values: charge codes with a column of their own
ACCESSORIALS = {"DETENTION": "detention_usd", "LIFTGATE": "liftgate_usd",
                "RESIDENTIAL": "residential_usd"}


def order_line(qty_side: DataFrame, price_side: DataFrame, tasks: int | None = None) -> DataFrame:
    """Lines from both sides, dealt by their order to ``tasks``."""
    price = price_side.withColumnRenamed("item_code", "item_code_price_side")
    return dealt(qty_side, LINE_KEY[0], tasks).join(dealt(price, LINE_KEY[0], tasks), LINE_KEY).withColumn(
        "item_code_disagrees", differs(F.col("item_code"), F.col("item_code_price_side")))


def with_charges(shipments: DataFrame, charges: DataFrame) -> DataFrame:
    """Shipments with their charges folded per code mix, next to the header's cost."""
    code, amount = F.col("charge_code"), F.col("charge_amount_usd")

    def total(pred):
        return F.sum(F.when(pred, amount))

    folded = charges.groupBy("shipment_id").agg(
        F.sum(amount).alias("charge_total_usd"),
        total(code == "FREIGHT").alias("freight_usd"),
        total(code == "FUEL").alias("fuel_surcharge_usd"),
        total(~code.isin("FREIGHT", "FUEL")).alias("accessorial_usd"),
        *[total(code == c).alias(name) for c, name in ACCESSORIALS.items()],
        F.count(F.lit(1)).alias("charge_line_count"),
    )
    sums = [c for c in folded.columns if c != "shipment_id"]
    return shipments.join(folded, "shipment_id", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in sums}
    ).withColumn("cost_variance_usd", F.col("charge_total_usd") - F.col("header_cost_usd"))


def shipment_charge(charges: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row per shipment: charge total and mix, zero when absent, and the variance."""
    return with_charges(shipments.select("shipment_id", "header_cost_usd"), charges)
