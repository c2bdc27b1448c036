"""Ranking, top-1 and dedup operators (WIN-2, WIN-3, WIN-4, TOP-1..3, FLT-9).

Windows over whole groups put each group in one task. Where only the first
rank is needed, the group extreme is computed with a (map-side combined)
aggregate and joined back, so a hot group is spread over many tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.session import scratch_path


def rank_first(df: DataFrame, group: Sequence[str], value: str, ascending: bool = True) -> DataFrame:
    """Rows with ``RANK() OVER (PARTITION BY group ORDER BY value) = 1``; ties kept."""
    agg = F.min(value) if ascending else F.max(value)
    ext = df.groupBy(*group).agg(agg.alias("__ext"))
    return (df.join(ext, on=list(group))
            .filter(F.col(value) == F.col("__ext")).drop("__ext"))


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rk") -> DataFrame:
    """``RANK()`` per group; for inputs already reduced to one row per item (WIN-3)."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*group).orderBy(*order)))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order``: the first row per key (TOP-3).

    A grouped min over a struct led by the ordering columns: partial
    aggregation combines copies map-side, so hot keys do not meet in one task.
    Ties on ``order`` are broken by the remaining columns (total order).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    m = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__first"))
    return m.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in (*order, *rest)]).select(*df.columns)


def arg_extreme(df: DataFrame, group: Sequence[str], value: str, item: str,
                prefix: str = "") -> DataFrame:
    """Per group: the ``item`` with the smallest and the largest ``value`` (TOP-1, TOP-2).

    Ties go to the smallest ``item`` in both directions.
    """
    neg = (-F.col(item)).alias("neg")
    return df.groupBy(*group).agg(
        F.min_by(item, F.struct(value, item)).alias(f"{prefix}argmin"),
        F.max_by(item, F.struct(F.col(value), neg)).alias(f"{prefix}argmax"))


def rank_distributed(df: DataFrame, group: Sequence[str], value: str, name: str = "rk",
                     ascending: bool = True) -> DataFrame:
    """``RANK() OVER (PARTITION BY group ORDER BY value)`` without one task per group.

    rank(v) = 1 + number of rows of the group with a smaller value. Rows are
    first reduced to (group, value, count), partially aggregated map-side. The
    counts are range-partitioned by (group, value) and stored with the number
    of their partition, so a group with many values is spread over partitions;
    a running sum within each partition starts from the sums of the same group
    in the partitions before it (one row per partition and group met there).
    """
    spark = df.sparkSession
    order = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__c"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"rank/{uuid.uuid4().hex}")
    counts.repartitionByRange(n, *group, order).withColumn("__pid", F.spark_partition_id()).write.parquet(path)
    counts = spark.read.parquet(path)
    sums = counts.groupBy(*group, "__pid").agg(F.sum("__c").alias("__s"))
    earlier = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "__pid", F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__off"))
    here = Window.partitionBy(*group, "__pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("__in", F.coalesce(F.sum("__c").over(here), F.lit(0)))
    ranks = within.join(sums, [*group, "__pid"]).select(*group, value, (F.col("__off") + F.col("__in") + 1).alias(name))
    return df.join(ranks, [*group, value], "left")
