"""SRC-2: a stored star-schema warehouse (one parquet folder per table).

``StarTables`` exposes the same attributes as the driver-bound ``Warehouse``,
so every analytical plan and audit runs unchanged on a user's own tables,
e.g. the folder written by ``python -m ticklake rebuild``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ticklake.sources.bindings import STAR_TABLES


class StarTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def scan(self, name: str) -> DataFrame:
        """Full scan of a stored table by name (column pruning and pushdown apply)."""
        return self.spark.read.parquet(f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in STAR_TABLES:
            df = self.scan(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def preloaded_fact(self) -> DataFrame:
        return self.tick_event
