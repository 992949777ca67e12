"""Process marts: a long table per process, one row per metric and dimension keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import empty, pad_columns
from .metrics import Metric, load_metrics

DEFINITIONS = Path(__file__).resolve().parent.parent / "definitions"

MART_SCHEMA = (
    "process_code string, slot string, display_order int, metric_name string, "
    "metric_label string, metric_status string, metric_format string, metric_direction string, "
    "date_key int, customer_key string, site_code string, item_code string, carrier_scac string, "
    "numerator decimal(38,6), denominator decimal(38,6), metric_value decimal(38,6), "
    "blocked_reason string"
)

Slot = tuple[str, str, str, int]


def shipped_metrics() -> dict[str, Metric]:
    return load_metrics(DEFINITIONS)


def slots_of(process_map: DataFrame) -> list[Slot]:
    """The process map, read whole on the driver: it is configuration, one row per slot of a dashboard."""
    rows = process_map.select("process_code", "metric_name", "slot", "display_order").collect()
    return sorted(((r[0], r[1], r[2], r[3]) for r in rows), key=lambda r: (r[0], r[3]))


def process_mart(
    spark: SparkSession,
    process: str,
    slots: Sequence[Slot],
    metrics: Mapping[str, Metric],
    rows_of: Callable[[Sequence[str]], DataFrame],
) -> DataFrame:
    """Long union of the metrics on a process's dashboard.

    ``rows_of(names)`` gives the long rows of several metrics, so those on one
    fact share a pass. Registry attributes are looked up in a literal map, so no
    join is needed. A blocked metric shows one row without numbers, and why. A
    process without metrics gives the empty typed frame, which is not the same
    as a missing one.
    """
    none = empty(spark, MART_SCHEMA)
    mine = [s for s in slots if s[0] == process]
    live = [s for s in mine if not metrics[s[1]].is_blocked]
    parts = [rows_of([s[1] for s in live])] if live else []
    blocked = [s[1] for s in mine if metrics[s[1]].is_blocked]
    if blocked:
        parts.append(spark.range(1).select(
            F.explode(F.array(*[F.lit(n) for n in blocked])).alias("metric_name")))
    out = none
    for p in parts:
        attrs = {"process_code": F.lit(process)}
        for name, value in (
            ("slot", lambda s, m: s[2]), ("display_order", lambda s, m: s[3]),
            ("metric_label", lambda s, m: m.label), ("metric_status", lambda s, m: m.status),
            ("metric_format", lambda s, m: m.format),
            ("metric_direction", lambda s, m: m.direction),
            ("blocked_reason", lambda s, m: m.blocked_reason),
        ):
            chosen = F.lit(None)
            for s in mine:
                chosen = F.when(F.col("metric_name") == s[1],
                                F.lit(value(s, metrics[s[1]]))).otherwise(chosen)
            attrs[name] = chosen
        block = pad_columns(p.withColumns(attrs), none.schema)
        out = block if out is none else out.unionByName(block)
    return out
