"""Publishing: layers as tables or views, versioned writes, export, seeds."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_DIR = Path(__file__).resolve().parent.parent / "seeds"

# fixed values: pinned seed types; free text stays text when every row is empty
SEEDS = {
    "legal_suffix": "suffix string, jurisdiction string, note string",
    "process": "process_code string, display_order int, is_active boolean",
    "process_metric_map": "process_code string, metric_name string, slot string, "
                          "display_order int",
    "site_code_crosswalk": "x3_site_code string, paycom_location_code string, "
                           "netstock_location_code string, site_name string, city string, "
                           "state_province string, country_code string",
}


def load_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed with pinned types.

    The packaged seeds are a few rows of package data, which executors cannot
    see as a path, so they go in as literal rows. A deployment's own seed file
    on shared storage is read by Spark.
    """
    if path:
        return spark.read.schema(SEEDS[name]).option("header", True).csv(path)
    with open(SEED_DIR / f"{name}.csv", newline="") as fh:
        lines = fh.read()
    head, *rows = csv.reader(io.StringIO(lines))
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in head))
    pinned = spark.createDataFrame([], SEEDS[name]).schema
    return raw.select(*[F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name)
                        for f in pinned])


def publish(df: DataFrame, name: str, kind: str = "view", path: str | None = None,
            partition_by: tuple[str, ...] = (), bucket_by: tuple[str, ...] = (), buckets: int = 0) -> DataFrame:
    """``view``: a temporary view. ``parquet``: files at ``path``. ``table``: the catalog.

    A table can be kept in ``buckets`` by the hash of ``bucket_by``, sorted by it: tables with the same number of buckets by
    the same key are joined, and folded by that key, without a shuffle. Choose the number so that a bucket
    of the largest table is one task's work.
    """
    if bucket_by and (kind != "table" or buckets < 1):
        raise ValueError("only tables have buckets, and they need a number of them")
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "parquet":
        if not path:
            raise ValueError("publishing Parquet needs a path")
        writer.parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
        back.createOrReplaceTempView(name)
        return back
    if kind == "table":
        if bucket_by:
            # one task a bucket, so that a bucket is one file
            writer = df.repartition(buckets, *bucket_by).write.mode("overwrite")
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
        return spark.table(name)
    raise ValueError(f"kind must be view, parquet or table, not {kind!r}")


def export(tables: Mapping[str, DataFrame], out: str) -> DataFrame:
    """Write each table as zstd Parquet and return the row-count manifest.

    Counts come from the written files, so the manifest states what is there.
    """
    manifest = None
    for name, df in tables.items():
        path = f"{out}/{name}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        back = df.sparkSession.read.schema(df.schema).parquet(path)
        one = back.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(len(df.columns)).alias("column_count"))
        manifest = one if manifest is None else manifest.unionByName(one)
    return manifest
