"""Incremental forms of the batch jobs, as Structured Streaming.

All of them are written so that a restart replays cleanly: a batch folds into the same
target rows however often it runs, and what it replaces is staged in full before the swap.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.events import DELIVERED, EXCEPTION, MILESTONES, SCAN
from ..session import is_there

#: Buckets of a target by the hash of its key, a partition column. A batch rewrites the buckets it has keys of, no others.
BUCKETS = 32
#: What the sink adds to a row: the run and the batch that wrote its bucket last.
STAMP = "_run string, _batch bigint, _bucket int"
#: Sequence numbers of a shipment whose events are kept together as one state.
CHUNK = 10_000


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stamps = T.StructType.fromDDL(STAMP)
    return spark.read.schema(T.StructType([*schema.fields, *stamps.fields])).parquet(path)


def read_current(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The newest row per key. To be read between batches: a swap replaces one bucket after the other."""
    if not is_there(spark, target):
        return spark.createDataFrame([], schema)
    return _stored(spark, target, schema).select(*schema.names)


def _run_of(spark: SparkSession, checkpoint: str | None) -> str:
    """What a query writes into its checkpoint once: another checkpoint is another run."""
    return spark.read.text(f"{checkpoint}/metadata").first().value if checkpoint else ""


def upsert_batches(target: str, keys: Sequence[str], order: Sequence[str], checkpoint: str | None = None,
                   buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that keeps the newest row per key.

    ``order`` are the columns that make a row newer; among equal values the row that
    arrived later wins, and within one batch the content hash decides. Each batch folds into
    the buckets it has keys of; their new content is written to a staging folder first and then put in
    their place by a dynamic partition overwrite. A batch that is run again after a loss in the middle of the swap
    is swapped from the staging folder, which is then complete and stamped with this run and batch; lost
    before that, the target is untouched and the batch is folded anew. Folding a batch twice changes nothing, so a
    lost checkpoint goes on from the state there is.
    """
    staging = f"{target}-staging"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        run = _run_of(spark, checkpoint)
        staged = None
        if is_there(spark, f"{staging}/_SUCCESS"):
            stamp = _stored(spark, staging, schema).select("_run", "_batch").first()
            staged = stamp and (stamp._run, stamp._batch)
        if staged != (run, batch_id):
            bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
            batch = batch.withColumn("_bucket", bucket).persist()
            # at most as many numbers as there are buckets
            touched = [r[0] for r in batch.select("_bucket").distinct().collect()]
            if not touched:
                batch.unpersist()
                return
            every = batch.withColumn("_late", F.lit(1))
            if is_there(spark, target):
                prior = _stored(spark, target, schema).where(F.col("_bucket").isin(touched))
                every = every.unionByName(prior.drop("_run", "_batch").withColumn("_late", F.lit(0)))
            rest = [c for c in schema.names if c not in keys]
            newer = F.struct(*order, "_late", F.xxhash64(*schema.names))
            newest = every.groupBy(*keys, "_bucket").agg(F.max_by(F.struct(*rest), newer).alias("_row"))
            newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in schema.names],
                          F.lit(run).alias("_run"), F.lit(batch_id).cast("bigint").alias("_batch"), "_bucket",
                          ).write.mode("overwrite").parquet(staging)
            batch.unpersist()
        # large buckets are split over tasks, small ones share one
        (_stored(spark, staging, schema).hint("rebalance", F.col("_bucket")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(target))

    return write


def stream_upsert(stream: DataFrame, keys: Sequence[str], order: Sequence[str], target: str,
                  checkpoint: str) -> None:
    """Fold every package that has arrived since the last run, then stop."""
    (stream.writeStream.foreachBatch(upsert_batches(target, keys, order, checkpoint))
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def stream_dedup(stream: DataFrame, keys: Sequence[str], time_col: str, lookback: str,
                 target: str, checkpoint: str) -> None:
    """Keep the first copy of each (entity, sequence) that arrives within the lookback."""
    once = stream.withWatermark(time_col, lookback).dropDuplicatesWithinWatermark(list(keys))
    (once.writeStream.format("parquet").outputMode("append").option("path", target)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def _chunk(seq: Column) -> Column:
    return F.floor(seq / F.lit(CHUNK))


def milestone_state(events: DataFrame, chunk: Callable[[Column], Column] = _chunk) -> DataFrame:
    """Milestones of each stretch of a shipment's sequence, as a fold that Spark can keep as streaming state.

    A state holds the (sequence, time) of its stretch's events in order, wherever they arrived, so an event that
    comes late moves in between its neighbours and the out-of-sequence count follows. ``chunk`` numbers the
    stretches by the sequence, which bounds a state and spreads a shipment with very many events. The times at both
    ends of the stretch are what ``shipment_milestones`` needs to compare it with the stretches beside it.
    """
    code, seq = F.col("event_code"), F.col("event_sequence")
    folded = events.groupBy("shipment_id", chunk(seq).cast("bigint").alias("chunk")).agg(
        *[F.min_by("event_at", F.when((code == c) & F.col("event_at").isNotNull(), seq)).alias(name)
          for c, name in MILESTONES.items()],
        F.count_if(code == SCAN).alias("in_transit_scan_count"),
        F.count(F.lit(1)).alias("event_count"),
        F.bool_or(code == EXCEPTION).alias("had_exception"),
        F.bool_or(code == DELIVERED).alias("is_delivered"),
        F.collect_list(F.struct(seq.alias("seq"), F.col("event_at").alias("at"))).alias("_line"),
    )
    line = F.transform(F.sort_array("_line"), lambda e: e["at"])
    rest = folded.columns[:-1]
    folded = folded.select(*rest, line.alias("_line"))
    late = F.zip_with(F.slice("_line", F.lit(2), F.size("_line")), F.slice("_line", F.lit(1), F.size("_line") - 1),
                      lambda at, before: F.when(at < before, 1).otherwise(0))
    return folded.select(
        *rest, F.aggregate(late, F.lit(0).cast("bigint"), lambda n, x: n + x).alias("out_of_sequence_event_count"),
        F.get("_line", F.lit(0)).alias("first_at"), F.get("_line", F.size("_line") - 1).alias("last_at"))


def shipment_milestones(stretches: DataFrame) -> DataFrame:
    """One row per shipment from the rows of ``milestone_state``: stretches are compared at their ends and folded."""
    along = W.partitionBy("shipment_id").orderBy(F.col("chunk").asc_nulls_last())
    s = stretches.withColumn("_before", F.lag("last_at").over(along))
    return s.groupBy("shipment_id").agg(
        *[F.min_by(name, F.when(F.col(name).isNotNull(), F.col("chunk"))).alias(name) for name in MILESTONES.values()],
        *[F.sum(c).alias(c) for c in ("in_transit_scan_count", "event_count")],
        *[F.bool_or(c).alias(c) for c in ("had_exception", "is_delivered")],
        (F.sum("out_of_sequence_event_count") + F.count_if(F.col("first_at") < F.col("_before"))
         ).alias("out_of_sequence_event_count"),
    ).withColumn("has_out_of_sequence_events", F.col("out_of_sequence_event_count") > 0)


def stream_milestones(events: DataFrame, target: str, checkpoint: str,
                      chunk: Callable[[Column], Column] = _chunk) -> None:
    """Updated stretches of each batch replace their row; more events is newer."""
    (milestone_state(events, chunk).writeStream.outputMode("update")
     .foreachBatch(upsert_batches(target, ["shipment_id", "chunk"], ["event_count"], checkpoint))
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def read_milestones(spark: SparkSession, target: str, events: T.StructType) -> DataFrame:
    """The milestones a stream over ``events`` keeps in ``target``."""
    state = milestone_state(spark.createDataFrame([], events)).schema
    return shipment_milestones(read_current(spark, target, state))
