"""Pinned schemas: contract to StructType, freezing, and drift.

A contract is data a deployment brings: ``{source: {table: {column: type}}}``,
as a mapping or a JSON file. Types are the logical names below or any Spark
type string. Reading with a pinned schema keeps an all-null column from being
inferred away.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: logical contract types
LOGICAL = {
    "text": "string",
    "bool": "boolean",
    "bigint": "bigint",
    "double": "double",
    "date": "date",
    "timestamp": "timestamp",
    "binary": "binary",
    "decimal": "decimal(18,4)",
}

# bookkeeping columns the landing archive adds
BOOKKEEPING = ("load_id", "load_date")


class DriftError(RuntimeError):
    """A landed table lost a pinned column."""


def _spark_type(spec) -> str:
    if isinstance(spec, Mapping):
        name = spec["data_type"]
        if name == "decimal":
            return f"decimal({spec.get('precision', 18)},{spec.get('scale', 4)})"
        return LOGICAL.get(name, name)
    return LOGICAL.get(spec, spec)


def load_contract(path: str) -> dict:
    with open(path) as fh:
        return json.load(fh)


def contract_schema(contract: Mapping, source: str, table: str) -> T.StructType:
    columns = contract[source][table]
    return T.StructType.fromDDL(
        ", ".join(f"`{name}` {_spark_type(spec)}" for name, spec in columns.items())
    )


def freeze(tables: Mapping[tuple[str, str], DataFrame]) -> dict:
    """The contract of tables as they are, ready for json.dump."""
    out: dict = {}
    for (source, table), df in tables.items():
        out.setdefault(source, {})[table] = {
            f.name: f.dataType.simpleString() for f in df.schema if f.name not in BOOKKEEPING
        }
    return out


@dataclass(frozen=True)
class Drift:
    source: str
    table: str
    missing: tuple[str, ...]
    added: tuple[str, ...]

    @property
    def is_incident(self) -> bool:
        return bool(self.missing)


def check_drift(contract: Mapping, source: str, table: str, df: DataFrame) -> Drift | None:
    """Lost columns are an incident, new ones a notice; None when both are empty."""
    pinned = contract.get(source, {}).get(table)
    if pinned is None:
        return None
    seen = [c for c in df.columns if c not in BOOKKEEPING]
    missing = tuple(c for c in pinned if c not in set(seen))
    added = tuple(c for c in seen if c not in pinned)
    return Drift(source, table, missing, added) if missing or added else None


def require_no_incident(drifts) -> None:
    lost = [d for d in drifts if d and d.is_incident]
    if lost:
        raise DriftError(
            "; ".join(f"{d.source}.{d.table} lost {', '.join(d.missing)}" for d in lost)
        )


def drift_frame(spark, drifts) -> DataFrame:
    """One row per drifted column. Sized by the contract, not by the data."""
    rows = [
        (d.source, d.table, col, change)
        for d in drifts
        if d
        for change, cols in (("lost", d.missing), ("new", d.added))
        for col in cols
    ]
    return spark.createDataFrame(
        rows, "source_name string, table_name string, column_name string, change string"
    )


def drift_impact(drift: Drift, before: DataFrame, after: DataFrame) -> DataFrame:
    """Non-null values behind each change: lost ones as they were, new ones as they are."""
    out = None
    for df, change, cols in ((before, "lost", drift.missing), (after, "new", drift.added)):
        if not cols:
            continue
        counted = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(change).alias("change"),
                     F.col(f"n{i}").alias("values_affected")) for i, c in enumerate(cols)]))
        one = counted.select(rows.alias("r")).select("r.*")
        out = one if out is None else out.unionByName(one)
    return out
