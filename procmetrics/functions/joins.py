"""Joins of a large table with one that is usually, but not surely, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import CO_PARTITION, scratch, shuffles_dropped

#: Rows of a few numbers each that are sent to every executor; a larger side is shuffled.
BROADCAST_ROWS = 500_000
#: Tasks over which a key of the large table is dealt where the side is shuffled.
SALTS = 16
#: Rows of a derived table that one task folds or joins.
ROWS_PER_TASK = 100_000


def tasks_for(rows: int, per_task: int = ROWS_PER_TASK) -> int:
    return max(1, -(-rows // per_task))


def spread(df: DataFrame, per_task: int, *keys: str) -> DataFrame:
    """``df``, which should be cheap to count, dealt by ``keys`` to tasks of about ``per_task`` rows before each row is made many."""
    return df.repartition(tasks_for(df.count(), per_task), *keys)


def dealt(df: DataFrame, key: str | Sequence[str], tasks: int | None = None) -> DataFrame:
    """``df`` dealt by ``key`` (a column, or several) alone, if the session lets joins on this and further keys use that (see ``session.SETTINGS``).

    Joins on (order, line) and on the order then follow each other without another shuffle; all sides need the same
    ``tasks``, if they are more than the session's number, below which Spark deals again. Else ``df`` as it is, as every join
    would deal it again. The rows are the same either way.
    """
    conf = df.sparkSession.conf
    if conf.get(CO_PARTITION) != "false":
        return df
    keys = [key] if isinstance(key, str) else key
    return df.repartition(tasks, *keys) if (tasks or 0) > int(conf.get("spark.sql.shuffle.partitions")) else df.repartition(*keys)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df``, written to the shared folder and read back, so that it is computed once and can be measured.

    What was shuffled for it is gone from the disks when it is written.
    """
    path = scratch(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_join(fact: DataFrame, side: DataFrame, on: Sequence[tuple[str, str]], spread: Column, how: str = "inner",
                  rows: int | None = None, most: int = BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """``fact`` with the columns of ``side`` that are no keys.

    ``on`` pairs a column of ``fact`` with one of another name in ``side``, compared null-safely; ``side`` has one row per key
    and should be stored, since it is counted unless ``rows`` says how large it is. With at most ``most`` rows it is broadcast
    and ``fact`` stays where it is; otherwise each key of ``fact`` is dealt by ``spread`` over ``salts`` tasks, and
    ``side`` repeated for them. The rows are the same either way. Without ``on``, ``side`` is one row.
    """
    if not on:
        return fact.crossJoin(F.broadcast(side))
    equal = [F.col(a).eqNullSafe(F.col(b)) for a, b in on]
    names = [b for _, b in on]
    if (side.count() if rows is None else rows) <= most:
        return fact.join(F.broadcast(side), equal, how).drop(*names)
    fact = fact.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    side = side.withColumn("_dealt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return fact.join(side, [*equal, F.col("_salt") == F.col("_dealt")], how).drop("_salt", "_dealt", *names)
