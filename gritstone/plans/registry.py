"""All registered queries of the library's own operators, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Query name to the inventory ids it covers.
COVERS: dict[str, str] = {}
_MODULES = ("q_windows", "q_joins", "q_aggs", "q_scalars", "q_sources", "q_quality", "q_decision", "q_io", "q_identity", "q_models")
_loaded = False


class Tables:
    """The tables of a folder, read on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(covers: str, sql: str | None = None):
    """Register a function of ``Tables`` under its name."""

    def wrap(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = f.__name__
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        COVERS[name] = covers
        if sql:
            ORACLE[name] = sql
        return f

    return wrap


def load() -> None:
    global _loaded
    if not _loaded:
        for m in _MODULES:
            importlib.import_module(f"gritstone.plans.{m}")
        _loaded = True


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    load()
    return QUERIES["islands_sessions"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(ORACLE)
