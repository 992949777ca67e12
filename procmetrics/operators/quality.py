"""Data-quality checks. A check returns its failing rows; a suite counts them."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..functions.sequence import text_list
from ..plans.metrics import Catalog, is_reaggregatable

# ------------------------------------------------------ failing rows


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    return unique_combination(df.where(F.col(col).isNotNull()), [col])


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def relationships(child: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is missing in the parent; a null key is no orphan."""
    keys = parent.select(F.col(key).alias("_pk"))
    return child.where(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("_pk"), "left_anti")


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(col).isin(list(values)))


# ------------------------------------------------------ severity

_RULE = re.compile(r"\s*(>=|<=|!=|=|>|<)\s*(\d+)\s*")
_COMPARE = {
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, "=": lambda a, b: a == b, "!=": lambda a, b: a != b,
}


def _rule(n: Column, text: str) -> Column:
    m = _RULE.fullmatch(text)
    if not m:
        raise ValueError(f"cannot read threshold {text!r}")
    return _COMPARE[m.group(1)](n, F.lit(int(m.group(2))))


def status(n: Column, severity: str = "error", warn_if: str = "!=0", error_if: str = "!=0") -> Column:
    """pass, warn or error for a failing-row count."""
    warn = F.when(_rule(n, warn_if), "warn")
    if severity == "warn":
        return warn.otherwise("pass")
    return F.when(_rule(n, error_if), "error").when(_rule(n, warn_if), "warn").otherwise("pass")


# ------------------------------------------------------ suites


@dataclass(frozen=True)
class Check:
    """A named check; ``predicate`` marks a failing row, ``failing`` is a frame of them."""

    name: str
    predicate: Column | None = None
    failing: DataFrame | None = None
    severity: str = "error"
    warn_if: str = "!=0"
    error_if: str = "!=0"


def _line(df: DataFrame, check: Check, n: Column) -> DataFrame:
    return df.select(
        F.lit(check.name).alias("check_name"), n.cast("bigint").alias("failing_rows"),
        status(n, check.severity, check.warn_if, check.error_if).alias("status"))


def run_checks(tables: Sequence[tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """One row per check. All row predicates of a table are counted in one pass."""
    out = None
    for df, checks in tables:
        rows = [c for c in checks if c.predicate is not None]
        parts = []
        if rows:
            counted = df.agg(*[F.count_if(c.predicate).alias(f"n{i}") for i, c in enumerate(rows)])
            lines = F.explode(F.array(*[
                F.struct(
                    F.lit(c.name).alias("check_name"), F.col(f"n{i}").alias("failing_rows"),
                    status(F.col(f"n{i}"), c.severity, c.warn_if, c.error_if).alias("status"))
                for i, c in enumerate(rows)]))
            parts.append(counted.select(lines.alias("r")).select("r.*"))
        for c in checks:
            if c.failing is not None:
                one = c.failing.agg(F.count(F.lit(1)).alias("n"))
                parts.append(_line(one, c, F.col("n")))
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out


# ------------------------------------------------------ whole-model checks


def metric_parity(catalog: Catalog, tolerance: float = 1e-6) -> DataFrame:
    """Rolled-up metric rows against the aggregates on the fact, per metric.

    A metric that does not re-aggregate cannot fail: its rows are expected to
    differ, and whether they do is reported. Rows and aggregates of all metrics of a fact come from one pass over it.
    """
    live = [m for m in catalog.metrics.values() if not m.is_blocked]
    side = lambda c: F.sum(F.when(F.col("grain") == "declared", F.col(c)))
    found = catalog.rows_and_totals([m.name for m in live], lambda both: both.groupBy("metric_name").agg(
        ratio(side("numerator"), side("denominator")).alias("from_rows"),
        F.max(F.when(F.col("grain") == "total", F.col("metric_value"))).alias("from_fact")))
    names = found.sparkSession.createDataFrame([(m.name,) for m in live], "metric_name string")
    adds = F.col("metric_name").isin([m.name for m in live if is_reaggregatable(m)])
    gap = F.abs(F.col("from_rows") - F.col("from_fact"))
    agrees = F.coalesce(
        gap <= F.greatest(F.abs("from_rows"), F.abs("from_fact"), F.lit(1.0)) * tolerance,
        F.col("from_rows").isNull() & F.col("from_fact").isNull())
    return names.join(found, "metric_name", "left").select(
        "metric_name", "from_rows", "from_fact", adds.alias("is_reaggregatable"),
        agrees.alias("agrees"), (agrees | ~adds).alias("passes"))


def binding_orphans(
    facts: Mapping[str, DataFrame], dims: Mapping[str, DataFrame],
    bindings: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """Orphaned rows of every (fact, key, dimension, primary key) binding.

    Each fact is read once: its keys are stacked and folded to one row per
    binding and key value before they meet the stacked keys of the dimensions.
    """
    asked = known = None
    for fact, df in facts.items():
        own = [b for b in bindings if b[0] == fact]
        stacked = F.explode(F.array(*[
            F.struct(F.lit(f"{f}.{k}").alias("binding"), F.lit(d).alias("dim"),
                     F.col(k).cast("string").alias("key")) for f, k, d, _ in own]))
        one = df.select(stacked.alias("s")).select("s.*").groupBy("binding", "dim", "key").agg(
            F.count(F.lit(1)).alias("n"))
        asked = one if asked is None else asked.unionByName(one)
    for dim, pk in dict.fromkeys((b[2], b[3]) for b in bindings):
        one = dims[dim].select(F.lit(dim).alias("dim"), F.col(pk).cast("string").alias("key"),
                               F.lit(True).alias("found"))
        known = one if known is None else known.unionByName(one)
    lost = F.col("key").isNotNull() & F.col("found").isNull()
    return asked.join(known.distinct(), ["dim", "key"], "left").groupBy("binding").agg(
        F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("orphans"))


def lossless(a: DataFrame, b: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows whose multiplicity differs between two builds, with both counts.

    Counted in one shuffle of both sides together; equal rows cancel, so an
    empty result means the builds are equal as multisets. Builds that are dealt by some of their columns already are counted
    where they are, in as few tasks; ``tasks`` deals them by all columns to so many first.
    """
    if a.columns != b.columns:
        raise ValueError(f"column lists differ: {a.columns} and {b.columns}")
    both = a.withColumn("_side", F.lit(0)).unionByName(b.withColumn("_side", F.lit(1)))
    if tasks:
        both = both.repartition(tasks, *a.columns)
    return (
        both.groupBy(*a.columns)
        .agg(F.count_if(F.col("_side") == 0).alias("rows_in_first"),
             F.count_if(F.col("_side") == 1).alias("rows_in_second"))
        .where("rows_in_first <> rows_in_second")
    )


def blocked_with_logic(registry: DataFrame) -> DataFrame:
    return registry.where(
        (F.col("status") == "blocked") & F.nullif(F.col("sql_model"), F.lit("")).isNotNull()
    ).select("metric_name", "status", "sql_model")


def colliding_names(df: DataFrame, name: str, code: str) -> DataFrame:
    """Names that are equal after normalisation, with how many and which codes."""
    rows = df.select(F.upper(F.trim(name)).alias("name_upper"), F.col(code).alias("_code"))
    return text_list(rows, ["name_upper"], "_code", ", ", "codes").where(
        "n_items > 1").withColumnRenamed("n_items", "records")


def unmapped_processes(process_map: DataFrame, processes: DataFrame) -> DataFrame:
    return process_map.join(processes, "process_code", "left_anti").select("process_code")


def identity_rates(fx: DataFrame, reporting_currency: str) -> DataFrame:
    return fx.where(
        (F.col("currency_code") != reporting_currency) & (F.col("rate_to_reporting_currency") == 1)
    ).select("currency_code", "rate_month", "rate_to_reporting_currency")


def reconcile(a: DataFrame, a_col: str, b: DataFrame, b_col: str, tolerance: float = 1.0
              ) -> DataFrame:
    """One row when two grand totals differ by more than the tolerance, else none."""
    x = a.agg(F.sum(a_col).alias("first_amount"))
    y = b.agg(F.sum(b_col).alias("second_amount"))
    diff = F.col("first_amount") - F.col("second_amount")
    return x.join(F.broadcast(y)).withColumn("difference", diff).where(F.abs(diff) > tolerance)


def crowded_processes(process_map: DataFrame, limit: int = 4) -> DataFrame:
    return process_map.groupBy("process_code").agg(
        F.count(F.lit(1)).alias("metric_count")).where(F.col("metric_count") > limit)


def layer_trace(spark: SparkSession, layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the row count of one entity at each layer it passes."""
    out = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.join(F.broadcast(one))
    return out
