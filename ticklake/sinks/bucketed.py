"""A batch table whose files are dealt by the hash of a key (SNK-2, ING-9).

Rows of one key always lie in the same bucket, so a join on the key reads the
stored side where it is: only the other side is shuffled, to as many
partitions. The table stays a plain parquet folder, partitioned by batch and
any further columns; its number of buckets is written beside it and a session
that first meets the folder registers it in its catalog.

Buckets are the unit of a task in such a join: choose their number so that the
keys of the partitions read at once, divided by it, fit a task. Each batch
writes at most one file for a bucket and partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.sinks.tables import BATCH_COL, delete_batch, list_batches, path_exists

TRACK = "spark.sql.hive.manageFilesourcePartitions"


class BucketedTable:
    """The table at ``path``: ``columns``, partitioned by batch and ``partition_by``, bucketed by ``key``."""

    def __init__(self, spark: SparkSession, path: str, columns: T.StructType, key: Sequence[str],
                 partition_by: Sequence[T.StructField] = (), buckets: int = 64):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), columns
        self.key, self.partition_by, self.buckets = list(key), list(partition_by), buckets
        self.name = f"cubos_{hashlib.sha1(self.path.encode()).hexdigest()[:16]}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.columns.fields, T.StructField(BATCH_COL, T.StringType(), False), *self.partition_by])

    def stored_buckets(self) -> int | None:
        """Buckets of the stored table: what was written beside it; None for a folder without buckets."""
        if path_exists(self.spark, f"{self.path}/_layout"):
            return int(self.spark.read.text(f"{self.path}/_layout").head()[0])
        return None if list_batches(self.spark, self.path) else self.buckets

    def _register(self) -> int | None:
        """Make the folder known to the session's catalog; its partitions are read from the folder itself."""
        n = self.stored_buckets()
        if n is None:
            return None
        if not self.spark.catalog.tableExists(self.name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            parts = ", ".join(f"`{c}`" for c in [BATCH_COL, *(f.name for f in self.partition_by)])
            key = ", ".join(f"`{c}`" for c in self.key)
            before = self.spark.conf.get(TRACK)
            self.spark.conf.set(TRACK, "false")
            try:
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({fields}) USING parquet PARTITIONED BY ({parts}) "
                               f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {n} BUCKETS LOCATION '{self.path}'")
            finally:
                self.spark.conf.set(TRACK, before)
        self.spark.catalog.refreshTable(self.name)
        return n

    def read(self) -> DataFrame:
        """All rows; empty before the first write."""
        if not list_batches(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        if self._register() is None:
            return self.spark.read.schema(self.schema).parquet(self.path)
        return self.spark.table(self.name)

    def write_batch(self, rows: DataFrame, batch_id: str) -> None:
        """Put a batch's rows in place of what it wrote before."""
        delete_batch(self.spark, self.path, batch_id)
        columns = [f.name for f in self.schema.fields]
        n = self.stored_buckets()
        if n is None:
            (rows.select(*columns).write.mode("append")
             .partitionBy(BATCH_COL, *(f.name for f in self.partition_by)).parquet(self.path))
            return
        if not path_exists(self.spark, f"{self.path}/_layout"):
            self.spark.range(1).select(F.lit(str(n)).alias("value")).coalesce(1).write.text(f"{self.path}/_layout")
        self._register()
        # The hash of the partitioning is that of the buckets: a task writes one bucket.
        rows.select(*columns).repartition(n, *self.key).write.mode("append").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
