"""Registry of queries and their oracle SQL, filled by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import CO_PARTITION, SETTINGS
from .inputs import Inputs
from .views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, store_lines: bool = False, store_folds: bool = False):
    """Register ``fn(inputs) -> DataFrame`` under ``name`` with its oracle."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, root: str) -> DataFrame:
            # the queries follow the recommended settings in this too, whoever made the session
            spark.conf.set(CO_PARTITION, SETTINGS[CO_PARTITION])
            return fn(Inputs(spark, root, store_lines, store_folds))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
