"""Registry of this subpackage's queries and their oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

MODULES = (
    "mix",
    "quality",
    "chat",
    "packing",
    "simhash",
    "warc",
    "topk",
    "linedup",
    "suffix",
    "backoff",
    "binpack",
    "fim",
    "align",
)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"sparkcast.llm.{m}")
