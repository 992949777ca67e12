"""Session settings the jobs rely on, and where they may write.

The library never owns a cluster's session. ``local_session`` exists for tests
and the bench; on a cluster, apply ``SETTINGS`` in the submit command.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Whether what an action has shuffled goes from the disks when it ends; else it stays until the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Whether both sides of a join have to be dealt by all of its keys; see ``functions.joins.dealt``.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # run-time re-planning: coalesce small partitions, split skewed join
    # partitions, turn a join into a broadcast once its side is measured small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # lines dealt by their document meet it, and other lines of it, without another shuffle
    CO_PARTITION: "false",
}


def local_session(app: str = "procmetrics", cpus: int | str = "*", shuffle: int = 8) -> SparkSession:
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # the test tables are a few megabytes; without this they end up in one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a folder of
    this machine; a cluster without it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = os.environ.get("PROCMETRICS_SCRATCH")
        if not root:
            root = tempfile.mkdtemp(prefix="procmetrics-")
            os.environ["PROCMETRICS_SCRATCH"] = root
    return root.rstrip("/")


def is_there(spark: SparkSession, path: str) -> bool:
    """Whether something was written at ``path``."""
    try:
        spark.read.schema("value string").text(path)
    except AnalysisException as e:
        # every other error is one
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Actions inside leave no shuffle files behind once they have ended; the session's own setting comes back afterwards."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
