"""All registered queries and oracles."""

from __future__ import annotations

import importlib

MODULES = ("queries_sql", "queries_staging", "queries_jobs", "queries_metrics", "queries_quality",
           "queries_io")


def load():
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
    from .registry import ORACLES, QUERIES

    return QUERIES, ORACLES
