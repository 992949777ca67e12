"""Tracking events: milestones by sequence, and the event-level fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import date_key, fk
from ..functions.sequence import lag_first

# fixed values: event code and the milestone it dates
MILESTONES = {"PU": "picked_up_date", "DP": "departed_facility_date",
              "AR": "arrived_facility_date", "OD": "out_for_delivery_date",
              "DL": "delivered_event_date", "EX": "exception_date"}
SCAN, DELIVERED, EXCEPTION = "IT", "DL", "EX"


def milestones(events: DataFrame, parts: int | None = None) -> DataFrame:
    """First event per code by sequence, never by time, plus sequence integrity.

    After the lag, one fold per shipment yields every column; ``min_by`` is
    partial, so a shipment with very many events is reduced before the shuffle.
    Events without a value are passed over by leaving their order key null.
    """
    ev = lag_first(
        events.select("shipment_id", "event_sequence", "event_code", "event_at", "event_location"),
        ["shipment_id"], "event_sequence", "event_at", lag_out="_previous",
        parts=parts,
    )
    code, seq = F.col("event_code"), F.col("event_sequence")

    def first(value, wanted):
        return F.min_by(value, F.when((code == wanted) & F.col(value).isNotNull(), seq))

    late = F.col("_previous").isNotNull() & (F.col("event_at") < F.col("_previous"))
    out = ev.groupBy("shipment_id").agg(
        *[first("event_at", c).alias(name) for c, name in MILESTONES.items()],
        first("event_location", DELIVERED).alias("delivery_location"),
        F.sum(F.when(code == SCAN, F.lit(1))).alias("in_transit_scan_count"),
        F.count(F.lit(1)).alias("event_count"),
        F.bool_or(code == EXCEPTION).alias("had_exception"),
        F.count_if(late).alias("out_of_sequence_event_count"),
    )
    return out.withColumns({
        "has_out_of_sequence_events": F.col("out_of_sequence_event_count") > 0,
        "transit_days": F.datediff("delivered_event_date", "picked_up_date"),
    })


def shipment_event(
    events: DataFrame, shipments: DataFrame, parts: int | None = None
) -> DataFrame:
    """One row per tracking event, with its place in the sequence and its shipment."""
    ev = lag_first(
        events, ["shipment_id"], "event_sequence", "event_at",
        lag_out="_previous", first_out="_first", parts=parts)
    ctx = shipments.select(
        "shipment_id", "customer_key", "customer_code", "site_code", "carrier_scac",
        "sales_order_number", "service_level", "transport_mode")
    at, prev = F.col("event_at"), F.col("_previous")
    return ev.join(ctx, "shipment_id", "left").select(
        "shipment_id", "event_sequence",
        fk(F.col("customer_key")).alias("customer_key"), "customer_code",
        fk(F.col("site_code")).alias("site_code"),
        fk(F.col("carrier_scac")).alias("carrier_scac"),
        "sales_order_number", "service_level", "transport_mode",
        date_key(at).alias("event_date_key"),
        "event_code", "event_description", "event_at", "event_location",
        F.datediff(at, prev).alias("days_since_previous_event"),
        F.datediff(at, F.col("_first")).alias("days_since_first_event"),
        (prev.isNotNull() & (at < prev)).alias("is_out_of_sequence"),
        (F.col("event_code") == DELIVERED).alias("is_delivery_event"),
        (F.col("event_code") == EXCEPTION).alias("is_exception_event"),
    )
