"""The named query catalogue: one Spark query and (where SQL can say it) one
DuckDB oracle per operator of SURVEY section 2.

Each entry is ``fn(spark, sf_dir) -> DataFrame``. Queries read the driver's
tables (or the ``demand`` view Spark derives from ``lineitem``) in full; no
row caps, id subsets or samples.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if any) to the catalogue."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


MODULES = (
    "q_features",
    "q_clean",
    "q_rules",
    "q_profile",
    "q_evaluate",
    "q_drift",
    "q_store",
    "q_models",
    "q_stream",
    "q_io",
)


def load_all() -> None:
    """Import every catalogue module so their ``register`` calls run."""
    import importlib

    for m in MODULES:
        importlib.import_module(f"sparkcast.plans.{m}")
