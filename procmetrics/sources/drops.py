"""CSV drops whose quoted fields may hold line breaks, read in splits.

Spark reads a CSV file in ranges if every line is a record, and in one task if a record may go on over several lines. Here
lines are read in ranges, and quotes tell which of them are whole records: a line starts a record if the
quotes before it in the file are even in number. The counts of the ranges before are summed over one row per range, so
no range has to know the lines of another. Lines that are a record by themselves, nearly all, are parsed where they
are; only the others are put together, each record in its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPTIONS = {"escape": '"'}


def _odd(quotes: Column) -> Column:
    return quotes % 2 == 1


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record) of every record under ``path`` but each file's first one, the header; blank lines are none.

    Quotes follow the usual rule: a field with quotes or line breaks is quoted, and quotes in it are doubled. A record
    that is never closed goes on to the end of its file. Line ends may be LF or CR LF.
    """
    value = F.col("value")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_at"), "value",
        (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))).cast("bigint").alias("_quotes"))
    in_block = W.partitionBy("file", "block").orderBy("_at")
    lines = lines.select(
        "file", "block", "value", F.row_number().over(in_block).alias("line"),
        F.sum("_quotes").over(in_block.rowsBetween(W.unboundedPreceding, 0)).alias("upto"), "_quotes").withColumn(
        "before", F.col("upto") - F.col("_quotes"))
    # a range's last start of a record, should the quotes before the range be even, or odd
    ranges = lines.groupBy("file", "block").agg(
        F.max("upto").alias("quotes"), F.max(F.when(~_odd(F.col("before")), F.col("line"))).alias("even"),
        F.max(F.when(_odd(F.col("before")), F.col("line"))).alias("odd"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("carry", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)))
    last = F.when(_odd(F.col("carry")), F.col("odd")).otherwise(F.col("even"))
    ranges = ranges.withColumn("own", F.when(last.isNotNull(), F.struct(F.col("block").alias("block"), last.alias("line"))))
    ranges = ranges.select("file", "block", "carry", F.last("own", True).over(earlier).alias("open"))
    lines = lines.join(ranges, ["file", "block"])
    starts, goes_on = ~_odd(F.col("before") + F.col("carry")), _odd(F.col("upto") + F.col("carry"))
    here = F.max(F.when(starts, F.col("line"))).over(
        W.partitionBy("file", "block").orderBy("line").rowsBetween(W.unboundedPreceding, 0))
    lines = lines.withColumns({"_whole": starts & ~goes_on, "_here": here})
    key = F.when(F.col("_here").isNotNull(), F.struct(F.col("block").alias("block"), F.col("_here").alias("line"))).otherwise(F.col("open"))
    whole = lines.where("_whole").select("file", F.struct("block", "line").alias("key"), F.col("value").alias("record"))
    pieces = lines.where("not _whole").select("file", key.alias("key"), F.struct("block", "line", "value").alias("piece"))
    joined = pieces.groupBy("file", "key").agg(F.sort_array(F.collect_list("piece")).alias("pieces")).select(
        "file", "key", F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("record"))
    header = F.struct(F.lit(0).cast("bigint").alias("block"), F.lit(1).alias("line"))
    return whole.unionByName(joined).where(F.col("key") != header).select(
        "file", F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The drop at ``path``, a file or a folder of files with the same header, by header name, all text, '' as null."""
    # only the header is looked at; without inference every column is text
    schema = spark.read.option("header", True).options(**OPTIONS).csv(path).schema
    parsed = F.from_csv("record", F.lit(", ".join(f"`{f.name}` string" for f in schema)), OPTIONS)
    return records(spark, path).select(parsed.alias("r")).select("r.*")
