"""The list of queries, filled by the modules next to this one."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

GROUPS = ("columns", "frames", "joins", "aggregates", "storage", "star")

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


class Tables:
    """The given tables of one scale factor, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` together with its oracle."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        _queries[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            _oracles[key] = sql
        return build

    return register


def _load() -> None:
    for group in GROUPS:
        import_module(f"tallymart.queries.{group}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
