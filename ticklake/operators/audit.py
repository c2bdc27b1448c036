"""Declared constraints re-aimed as audit jobs (AUD-1 ... AUD-5).

Spark does not enforce keys, so each constraint becomes a job that returns
its violations. All audits are grouped aggregates or anti joins: no
collect, no per-row driver work.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.schemas import TableKeys
from ticklake.session import scratch_path


def _key_text(cols: Sequence[str]):
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def unique_violations(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row (PRIMARY KEY / UNIQUE)."""
    name = f"uq_{table}_{'_'.join(key)}"
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("filas"))
            .filter(F.col("filas") > 1)
            .select(F.lit(table).alias("tabla"), F.lit(name).alias("restriccion"),
                    _key_text(key).alias("clave"), "filas"))


def foreign_key_violations(tables: Mapping[str, DataFrame], keys: Mapping[str, TableKeys]) -> DataFrame:
    """Non-NULL child keys missing from their parent, for every declared foreign key; NULL keys pass, as in SQL.

    One pass: a child is scanned once and gives a (constraint, key) row for
    each of its references, counted map-side; these are joined once with the
    keys of all parents, each scanned once. A hot key is one row after the
    count. Keys are compared as text.
    """
    wanted: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    counted = []
    for name, k in keys.items():
        refs = []
        for cols, parent, pcols in k.foreign:
            rule = f"fk_{name}_{'_'.join(cols)}"
            wanted.setdefault((parent, tuple(pcols)), []).append(rule)
            present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
            refs.append(F.when(present, F.struct(F.lit(name).alias("tabla"), F.lit(rule).alias("restriccion"), _key_text(cols).alias("clave"))))
        if refs:
            counted.append(tables[name].select(F.explode(F.filter(F.array(*refs), lambda r: r.isNotNull())).alias("r")).select("r.*"))
    found = reduce(DataFrame.unionByName, counted).groupBy("tabla", "restriccion", "clave").agg(F.count(F.lit(1)).alias("filas"))
    parents = []
    for (parent, pcols), rules in wanted.items():
        of_rule = F.explode(F.array(*[F.lit(r) for r in rules])).alias("restriccion")
        parents.append(tables[parent].select(_key_text(pcols).alias("clave"), of_rule, F.lit(True).alias("__there")))
    # An anti join would be pushed below the count, onto every row of every child.
    return (found.join(reduce(DataFrame.unionByName, parents), ["restriccion", "clave"], "left")
            .filter(F.col("__there").isNull()).select("tabla", "restriccion", "clave", "filas"))


def check_violations(df: DataFrame, table: str, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """Per CHECK: rows where the predicate is FALSE (NULL passes), as one-row counts."""
    if not checks:
        return None
    aggs = [F.count_if(~F.expr(expr)).alias(f"c{i}") for i, (_, expr) in enumerate(checks)]
    one = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("restriccion"), F.col(f"c{i}").alias("violaciones"))
                                for i, (n, _) in enumerate(checks)]))
    return one.select(stack.alias("s")).select(F.lit(table).alias("tabla"), "s.restriccion",
                                               "s.violaciones")


def not_null_length_violations(df: DataFrame, table: str, not_null: Sequence[str],
                               max_length: dict) -> DataFrame:
    """NOT NULL and VARCHAR(n) rules as counts per column (AUD-4)."""
    rules = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in not_null]
    rules += [(c, f"max_length_{n}", F.count_if(F.length(F.col(c)) > n)) for c, n in max_length.items()]
    one = df.agg(*[agg.alias(f"r{i}") for i, (_, _, agg) in enumerate(rules)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.lit(r).alias("regla"),
                                         F.col(f"r{i}").alias("violaciones"))
                                for i, (c, r, _) in enumerate(rules)]))
    return one.select(stack.alias("s")).select(F.lit(table).alias("tabla"), "s.columna", "s.regla",
                                               "s.violaciones")


def surrogate_keys(df: DataFrame, natural_key: Sequence[str], name: str, base: int | Column = 0,
                   partitions: int | None = None) -> DataFrame:
    """Dense ids ``base + 1 .. base + n`` in natural-key order (AUD-5).

    Equal to ``ROW_NUMBER() OVER (ORDER BY natural_key)`` but distributed: rows
    are range-partitioned by the key and written once with the number of their
    partition. Numbers within a partition and the counts of the partitions
    before it both come from that stored copy: two plans of a range shuffle
    may sample different bounds, and numbers would not fit. The offsets have
    one row per partition. The natural key must be unique.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"surrogate/{uuid.uuid4().hex}")
    df.repartitionByRange(n, *natural_key).withColumn("__pid", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    local = ranged.withColumn(
        "__rn", F.row_number().over(Window.partitionBy("__pid").orderBy(*natural_key)))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", (F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("__off"))
    start = base if isinstance(base, Column) else F.lit(base).cast("long")
    return (local.join(F.broadcast(offsets), "__pid")
            .withColumn(name, start + F.col("__off") + F.col("__rn"))
            .drop("__pid", "__rn", "__off"))


def row_numbers(stored: DataFrame, name: str, base: int | Column = 0) -> DataFrame:
    """Dense numbers ``base + 1 .. base + n`` for the rows of a written parquet table, without moving a row.

    A row's number is its place in its file plus the rows of the files before,
    in the order in which the tasks wrote them. ``stored`` reads the table
    directly; a filter may name its partition columns only. The sums over files
    have one row a file.
    """
    place = stored.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    files = place.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    task = F.regexp_extract("__file", r"part-(\d+)", 1).cast("long")
    before = F.sum("__n").over(Window.orderBy(task, "__file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = files.select("__file", F.coalesce(before, F.lit(0)).alias("__off"))
    start = base if isinstance(base, Column) else F.lit(base).cast("long")
    return (place.join(offsets, "__file").withColumn(name, start + F.col("__off") + F.col("__at") + 1)
            .drop("__file", "__at", "__off"))
