"""Named queries over the benchmark tables, each beside an independent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The benchmark tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        return self.frame(
            name, lambda: self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        )

    def frame(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The frame of that name, declared once per query."""
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
