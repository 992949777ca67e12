"""Helpers shared by the operators: tables, stored intermediates, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, shuffles_dropped, table

#: What separates words: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[ \t-\r]+"


def documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents")


def text_of(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    What was shuffled for it is gone from the disks when it is written.
    """
    path = scratch(df.sparkSession, f"llm-{label}")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete the files of a table written by ``store``, once nothing reads it any more."""
    context = stored.sparkSession.sparkContext
    for folder in {f.rpartition("/")[0] for f in stored.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few numbers each that are sent to every executor; a longer list is shuffled.
SMALL_ROWS = 500_000


def small(stored: DataFrame, rows: int | None = None) -> DataFrame:
    """``stored``, marked for broadcast if it has at most ``SMALL_ROWS`` rows (or ``rows``, where a row holds more).

    For stored tables of fixed-width columns. The join gives the same rows either way.
    """
    n = stored.count() if rows is None else rows
    return F.broadcast(stored) if n <= SMALL_ROWS else stored


#: Rows of a few numbers each that one task takes on.
TASK_ROWS = 250_000


def sized(stored: DataFrame) -> DataFrame:
    """``stored`` in as many partitions as its rows need: a small table joins and groups in one task, without shuffles."""
    return stored.coalesce(max(1, -(-stored.count() // TASK_ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, root) per node.

    ``root`` is the smallest node of the component. Distributed union-find by
    alternating stars: every round hangs the larger neighbours of each node on its
    smallest one, then the smaller ones, until nothing moves. Each round is
    two joins against a per-node minimum, so a hub's edges are never gathered;
    the join on a hub is split by adaptive execution. Loops and repeated edges
    are allowed; an edge with a null end is ignored.
    """
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = sized(store(e, "edges"))
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        e = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u <> v").distinct())
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        up = e.join(low, "u")
        e = (up.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = sized(store(e, "edges"))
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
