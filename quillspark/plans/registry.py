"""Named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the
operator is expressible in SQL, the DuckDB oracle text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from . import attention_q, features_q, grading_q, prompting_q, sampling_q, sinks_q, trainlog_q  # noqa: F401
