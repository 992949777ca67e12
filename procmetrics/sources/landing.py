"""Extract windows, the append-only landing archive, and its projections.

The archive is Parquet under ``<root>/<source>/<table>/load_date=…/package=…``; each load
package carries one ``load_id`` that sorts by time. A ledger beside the tables holds one row per
package, written once the package is complete: a package without a row is not read, and one with a row is not
landed again. Nothing else is rewritten. Current-state tables are projections of it and are published as new version
folders, so a table that is being read is never overwritten.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import is_there
from . import drops
from .catalog import TableSpec
from .contract import BOOKKEEPING

MAX_FILE_AGE_DAYS = 2


class StaleExportError(RuntimeError):
    """A file drop is missing or too old to be trusted."""


# ---------------------------------------------------------------- reading


def read_full(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Pinned schema and an enumerated column list; both reach the scan."""
    return spark.read.schema(schema).parquet(path).select(*(columns or schema.fieldNames()))


def read_jdbc(spark: SparkSession, url: str, table: str, schema: T.StructType,
              partition: Mapping[str, str] | None = None, **options: str) -> DataFrame:
    """A source database read in parallel; column list and filters are pushed down.

    ``partition`` holds partitionColumn, lowerBound, upperBound, numPartitions.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in {**(partition or {}), **options}.items():
        r = r.option(k, v)
    return r.load().select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_modified_since(df: DataFrame, cursor: str, since: dt.date | None) -> DataFrame:
    """Inclusive: a date cursor repeats its last day rather than lose half of it."""
    return df if since is None else df.where(F.col(cursor) >= F.lit(since))


def read_header_window(
    child: DataFrame,
    parent: DataFrame,
    on: str,
    date_col: str,
    since: dt.date | None,
    parent_on: str | None = None,
) -> DataFrame:
    """Child rows whose parent's business date is in range.

    A semi join, so repeated parents cannot repeat a child. Keys are compared
    trimmed because only the transaction side is padded.
    """
    if since is None:
        return child
    live = parent.where(F.col(date_col) >= F.lit(since)).select(
        F.trim(F.col(parent_on or on).cast("string")).alias("_parent_key")
    )
    return child.join(live, F.trim(child[on].cast("string")) == F.col("_parent_key"), "left_semi")


def read_with_archived(
    live: DataFrame, archived: DataFrame, cursor: str, since: dt.date | None
) -> DataFrame:
    """Both passes, each within the window; archived rows stay in, flagged."""
    both = live.withColumn("archived", F.lit(False)).unionByName(
        archived.withColumn("archived", F.lit(True))
    )
    return read_modified_since(both, cursor, since)


def children_for(child: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    """All children of the parents in scope, in one join."""
    return child.join(parents.select(on), on, "left_semi")


def read_latest_drop(
    spark: SparkSession,
    folder: str,
    table: str,
    as_of: dt.date,
    max_age_days: int = MAX_FILE_AGE_DAYS,
) -> DataFrame:
    """The newest ``TABLE_yyyymmdd….csv``, by header name, all text, '' as null.

    Only paths are listed to find the newest drop; the rows are read once, on
    the executors. A drop is a file, or a folder of parts with the same name. A
    missing or stale drop fails, because it looks exactly like a report without
    changes.
    """
    stem = r"/" + re.escape(table.upper()) + r"_(\d{8})[^/]*\.csv"
    drop = F.regexp_extract("path", f"^(.*{stem})(?:/[^/]*)?$", 1)
    stamp = F.regexp_extract("path", stem + r"(?:/[^/]*)?$", 1)
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(drop.alias("path"), stamp.alias("stamp"))
        .where("stamp <> ''")
    )
    # the path as tie-break: two drops on one day, the later name wins
    newest = listing.agg(F.max(F.struct("stamp", "path")).alias("n")).select("n.*").first()
    if newest is None or newest.path is None:
        raise StaleExportError(f"no {table.upper()}_*.csv in {folder}")
    day = dt.datetime.strptime(newest.stamp, "%Y%m%d").date()
    age = (as_of - day).days
    if age > max_age_days:
        raise StaleExportError(f"{newest.path} is {age} days old, limit {max_age_days}")
    return drops.read_csv(spark, newest.path)


# ------------------------------------------------------------- watermarks

STATE_SCHEMA = "source_name string, table_name string, high_water_mark date"


def window_start(state: DataFrame, spec: TableSpec, full_refresh: bool = False) -> dt.date | None:
    """Mark minus lookback; None on a first run, which means no predicate."""
    if full_refresh:
        return None
    row = (
        state.where((F.col("source_name") == spec.source) & (F.col("table_name") == spec.name))
        .agg(F.date_sub(F.max("high_water_mark"), spec.lookback_days).alias("d"))
        .first()
    )
    return row.d


def advance(state: DataFrame, spec: TableSpec, df: DataFrame, cursor: str) -> DataFrame:
    """The state with this table's mark raised to the newest cursor seen.

    A mark never moves back, and an empty read leaves it where it is.
    """
    seen = df.agg(F.max(F.col(cursor).cast("date")).alias("high_water_mark")).select(
        F.lit(spec.source).alias("source_name"), F.lit(spec.name).alias("table_name"),
        "high_water_mark",
    )
    return (
        state.unionByName(seen)
        .groupBy("source_name", "table_name")
        .agg(F.max("high_water_mark").alias("high_water_mark"))
        .where("high_water_mark is not null")
    )


def late_window(mark: Column, lookback_days: int) -> Column:
    return F.date_sub(mark, lookback_days)


# ---------------------------------------------------------------- archive


LEDGER = ("source_name string, table_name string, load_id string, load_date date, rows bigint, "
          "high_water_mark date")
STATUS = ("source_name string, table_name string, rows bigint, load_packages bigint, load_dates bigint, "
          "first_load_date date, last_load_date date, high_water_mark date")


def landing_path(root: str, spec: TableSpec) -> str:
    return f"{root}/{spec.source}/{spec.name}"


def ledger(spark: SparkSession, root: str, spec: TableSpec | None = None) -> DataFrame:
    """One row per complete package, of one table or of all: its id, date, rows and newest cursor value."""
    path = f"{root}/load_ledger"
    if not is_there(spark, path):
        return spark.createDataFrame([], LEDGER)
    # a package whose row was written twice counts once
    rows = spark.read.schema(LEDGER).parquet(path).dropDuplicates(["source_name", "table_name", "load_id"])
    return rows if spec is None else rows.where(
        (F.col("source_name") == spec.source) & (F.col("table_name") == spec.name))


def _package(load_id: str) -> str:
    return f"p-{load_id}"


def land(df: DataFrame, root: str, spec: TableSpec, load_id: str, load_date: dt.date) -> str:
    """Append one load package; values are kept as they came.

    Landing a package again changes nothing, whether it was complete (the ledger has it, and it is left as it is) or was lost
    on the way (its folder is written anew; what an earlier attempt left under another date has no row and is not read).
    """
    spark, path = df.sparkSession, landing_path(root, spec)
    if not ledger(spark, root, spec).where(F.col("load_id") == load_id).isEmpty():
        return path
    (
        df.withColumns({"load_id": F.lit(load_id), "load_date": F.lit(load_date), "package": F.lit(_package(load_id))})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_date", "package").parquet(path)
    )
    mark = spec.cursor_column if spec.cursor_column in df.columns else None
    counted = [F.count(F.lit(1)).alias("rows"),
               (F.max(F.col(mark).cast("date")) if mark else F.lit(None).cast("date")).alias("high_water_mark")]
    own = f"{path}/load_date={load_date}/package={_package(load_id)}"
    written = (spark.read.schema(df.schema).parquet(own) if is_there(spark, own) else spark.createDataFrame([], df.schema)).agg(*counted)
    (
        written.select(F.lit(spec.source).alias("source_name"), F.lit(spec.name).alias("table_name"),
                       F.lit(load_id).alias("load_id"), F.lit(load_date).alias("load_date"), "rows", "high_water_mark")
        .coalesce(1).write.mode("append").parquet(f"{root}/load_ledger")
    )
    return path


def scan_landing(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    schema: T.StructType | None = None,
    since: dt.date | None = None,
    load_id: str | None = None,
) -> DataFrame:
    """All complete packages, united by column name; ``since`` prunes load_date folders, ``load_id`` leaves one package.

    A pinned schema saves reading every footer; without one the footers are
    merged.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(
            T.StructType(schema.fields + [T.StructField("load_id", T.StringType()),
                                          T.StructField("load_date", T.DateType()),
                                          T.StructField("package", T.StringType())])
        )
    else:
        reader = reader.option("mergeSchema", True)
    df = reader.parquet(landing_path(root, spec))
    done = ledger(spark, root, spec)
    if load_id is not None:
        # one package: its folders are all that is listed against
        one = done.where(F.col("load_id") == load_id).first()
        df = df.where((F.col("load_date") == F.lit(one.load_date)) & (F.col("package") == _package(load_id)))
        return df.drop("package")
    if since is not None:
        df = df.where(F.col("load_date") >= F.lit(since))
    # as many rows as there are packages
    known = done.select(F.col("load_date").alias("_date"), F.concat(F.lit(_package("")), "load_id").alias("_package"))
    on = [F.col("load_date") == F.col("_date"), F.col("package") == F.col("_package")]
    return df.join(known, on, "left_semi").drop("package")


def newest_load(spark: SparkSession, root: str, spec: TableSpec) -> str | None:
    """The highest load id among the packages with rows, read off the ledger."""
    return ledger(spark, root, spec).where("rows > 0").agg(F.max("load_id").alias("m")).first().m


def project_replace(df: DataFrame, newest: str | None = None) -> DataFrame:
    """Rows of the newest load only, in whatever folder it lies.

    ``newest`` is its id, from the ledger, if ``df`` holds more than that load; an id that the caller does not have
    is looked for in the rows. It is one row, so it is broadcast.
    """
    if newest is None:
        top = df.agg(F.max("load_id").alias("_newest"))
        df = df.join(F.broadcast(top), F.col("load_id") == F.col("_newest")).drop("_newest")
    else:
        df = df.where(F.col("load_id") == newest)
    return df.drop(*BOOKKEEPING)


def project_merge(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest row per key.

    ``max_by`` folds the versions of a key before the shuffle, so a key with
    very many versions costs one row per input partition, not a sort. Rows of
    one key in one load are told apart by their content hash, so a rerun gives
    the same row.
    """
    values = [c for c in df.columns if c not in (*keys, *BOOKKEEPING)]
    packed = F.struct(*[F.col(c) for c in values]) if values else F.lit(None)
    order = F.struct(F.col("load_id"), F.xxhash64(*[F.col(c) for c in (values or keys)]))
    out = df.groupBy(*keys).agg(F.max_by(packed, order).alias("_row"))
    names = [c for c in df.columns if c not in BOOKKEEPING]
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in names])


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    return project_replace(df) if spec.disposition == "replace" else project_merge(
        df, spec.primary_key)


def current(spark: SparkSession, root: str, spec: TableSpec, schema: T.StructType | None = None) -> DataFrame:
    """The table as its packages leave it; of a replace table only the newest package is opened."""
    if spec.disposition != "replace":
        return project_merge(scan_landing(spark, root, spec, schema), spec.primary_key)
    newest = newest_load(spark, root, spec)
    return project_replace(scan_landing(spark, root, spec, schema, load_id=newest), newest)


def landing_status(loads: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """Rows, load packages, first and last load date and watermark of every table, landed or not.

    ``loads`` is the ledger; the archive itself is not opened. A table never landed has no rows and no dates, one without a
    cursor column, or whose cursor was never filled, has no watermark.
    """
    spark = loads.sparkSession
    every = spark.createDataFrame([(s.source, s.name) for s in specs], "source_name string, table_name string")
    known = loads.groupBy("source_name", "table_name").agg(
        F.sum("rows").alias("rows"),
        F.count_distinct("load_id").alias("load_packages"),
        F.count_distinct("load_date").alias("load_dates"),
        F.min("load_date").alias("first_load_date"),
        F.max("load_date").alias("last_load_date"),
        F.max("high_water_mark").alias("high_water_mark"),
    )
    names = T.StructType.fromDDL(STATUS).names
    return every.join(known, ["source_name", "table_name"], "left").fillna(
        0, ["rows", "load_packages", "load_dates"]).select(*names)


def rows_by_load_date(df: DataFrame) -> DataFrame:
    return df.groupBy("load_date").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("load_id").alias("load_packages")
    )


def reconcile_keys(
    current: DataFrame, source_keys: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Key sweep: rows gone from the source are flagged, keys never landed are listed.

    Output: the keys and ``state`` of kept / deleted_in_source / missing_here.
    One full join on the distinct keys of both sides.
    """
    a = current.select(*keys).distinct().withColumn("_here", F.lit(True))
    b = source_keys.select(*keys).distinct().withColumn("_there", F.lit(True))
    state = (
        F.when(F.col("_here") & F.col("_there"), "kept")
        .when(F.col("_here"), "deleted_in_source")
        .otherwise("missing_here")
    )
    return a.join(b, list(keys), "full").select(*keys, state.alias("state"))


def soft_delete(current: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows with ``is_deleted_in_source``; nothing is removed."""
    there = source_keys.select(*keys).distinct().withColumn("_there", F.lit(True))
    return current.join(there, list(keys), "left").withColumn(
        "is_deleted_in_source", F.col("_there").isNull()
    ).drop("_there")


def extract(
    spec: TableSpec,
    tables: Mapping[str, DataFrame],
    since: dt.date | None,
    archived: DataFrame | None = None,
) -> DataFrame:
    """One table's extract by its declared strategy; ``tables`` hold the live source."""
    df = tables[spec.name]
    if spec.strategy in ("full_refresh", "snapshot", "file_drop"):
        return df
    if spec.cursor_column:
        if archived is not None:
            return read_with_archived(df, archived, spec.cursor_column, since)
        return read_modified_since(df, spec.cursor_column, since)
    parent, on, date_col = spec.window_via
    if parent == spec.name:
        return read_modified_since(df, date_col, since)
    return read_header_window(df, tables[parent], on, date_col, since)


def project_all(
    spark: SparkSession, root: str, specs: Iterable[TableSpec],
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Lazy current-state frames for every spec; publishing is the caller's step."""
    return {
        s.name: current(spark, root, s, (schemas or {}).get(s.name))
        for s in specs
    }
