"""Sinks (SNK-1 ... SNK-6).

Writes are idempotent per batch: append-style tables are partitioned by
``id_lote``, and a batch replaces its own partition as a whole, also with
nothing, so a retried or corrected batch leaves no rows of an earlier run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.geometry import morton_key
from ticklake.operators.audit import surrogate_keys
from ticklake.schemas import TableKeys

BATCH_COL = "id_lote"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_batches(spark: SparkSession, path: str) -> dict:
    """The partition folder of each batch by its id, however the id is escaped in the folder's name."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return {}
    found = [(unquote(x.getPath().getName()), x.getPath()) for x in fs.listStatus(p)]
    return {name.removeprefix(f"{BATCH_COL}="): folder for name, folder in found if name.startswith(f"{BATCH_COL}=")}


def delete_batch(spark: SparkSession, path: str, batch_id: str) -> None:
    """Remove what a batch wrote before. An empty id has no folder of its own and is refused."""
    if not batch_id:
        raise ValueError("a batch needs an id")
    fs, _ = _path(spark, path)
    folder = list_batches(spark, path).get(batch_id)
    if folder is not None:
        fs.delete(folder, True)


def write_batch(df: DataFrame, path: str, batch_id: str, partition_by: Sequence[str] = ()) -> None:
    """Append one batch (SNK-1, SNK-2) in place of whatever it wrote before.

    ``df`` must not read from ``path``'s partition of this batch. Between the
    two steps readers see the table without the batch; a crash there leaves it
    absent, and its re-run completes it.
    """
    delete_batch(df.sparkSession, path, batch_id)
    df.write.mode("append").partitionBy(BATCH_COL, *partition_by).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists, on whatever file system the path names."""
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder once its rows are written elsewhere."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The stored table, or an empty frame of ``schema`` before its first write."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def insert_if_absent(incoming: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING`` (SRC-3, SNK-2): rows to append."""
    return incoming.dropDuplicates(list(key)).join(target.select(*key), list(key), "left_anti")


def reload(df: DataFrame, path: str) -> None:
    """``TRUNCATE`` + load (SNK-3): full overwrite."""
    df.write.mode("overwrite").parquet(path)


def dependents(table: str, keys: Mapping[str, TableKeys]) -> list[str]:
    """The tables that refer to ``table``, directly or through others, each before those it refers to."""
    refer = {name: {parent for _, parent, _ in k.foreign} for name, k in keys.items()}
    reach, more = set(), {table}
    while more:
        more = {name for name, parents in refer.items() if parents & more} - reach
        reach |= more
    reach.discard(table)
    order: list[str] = []
    while len(order) < len(reach):
        left = reach.difference(order)
        free = sorted(n for n in left if not any(n in refer[m] for m in left if m != n))
        if not free:
            raise ValueError(f"foreign keys form a cycle among {sorted(left)}")
        order += free
    return order


def reload_cascade(rows: DataFrame, root: str, table: str, keys: Mapping[str, TableKeys], id_col: str | None = None,
                   natural_key: Sequence[str] = ()) -> list[str]:
    """``TRUNCATE ... RESTART IDENTITY CASCADE`` + load (SNK-3) on stored tables, a folder each under ``root``.

    Tables that refer to ``table`` are emptied first, the farthest ones before
    those they refer to: a crash leaves no row without its parent. With
    ``id_col`` the new rows are numbered from 1 in the order of ``natural_key``.
    ``rows`` must not read the folder. Returns the emptied tables.
    """
    spark = rows.sparkSession
    emptied = [name for name in dependents(table, keys) if path_exists(spark, f"{root}/{name}")]
    for name in emptied:
        schema = spark.read.parquet(f"{root}/{name}").schema
        reload(spark.createDataFrame([], schema), f"{root}/{name}")
    reload(surrogate_keys(rows, natural_key, id_col).select(*rows.columns) if id_col else rows, f"{root}/{table}")
    return emptied


def materialize(df: DataFrame, path: str, sort_by=()) -> DataFrame:
    """Create or refresh a materialized result (SNK-5) and read it back.

    Each refresh writes a new version folder (optionally sorted inside files,
    the re-aimed index of the view) and then appends its number to the list of
    finished versions: readers see the newest finished one, and a refresh may
    read the version it replaces.
    """
    spark = df.sparkSession
    version = (current_version(spark, path) or 0) + 1
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode("overwrite").parquet(f"{path}/version={version}")
    spark.createDataFrame([(version,)], "finished long").coalesce(1).write.mode("append").parquet(f"{path}/_finished")
    return read_materialized(spark, path)


def current_version(spark: SparkSession, path: str) -> int | None:
    """Number of the newest finished version, if there is one."""
    if not path_exists(spark, f"{path}/_finished"):
        return None
    return spark.read.schema("finished long").parquet(f"{path}/_finished").agg(F.max("finished")).head()[0]


def read_materialized(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/version={current_version(spark, path)}")


def drop_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the newest ``keep`` finished versions and unfinished ones older than these."""
    newest = current_version(spark, path)
    if newest is None:
        return
    fs, p = _path(spark, path)
    for x in fs.listStatus(p):
        name = x.getPath().getName()
        if name.startswith("version=") and int(name.removeprefix("version=")) <= newest - keep:
            fs.delete(x.getPath(), True)


def clustered_layout(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                     cluster_by: Sequence[str | Column] = (), sort_by: Sequence[str | Column] = ()) -> DataFrame:
    """Lay data out for an access path (SNK-6, the re-aimed indexes).

    Rows are range-partitioned by ``cluster_by`` and sorted by ``sort_by`` inside
    each file, so parquet min/max statistics let scans skip files and row
    groups for filters on those keys. End ``cluster_by`` with a key that tells
    rows apart: then one value with many rows is spread over several files.
    ``partition_by`` gives directory pruning.
    """
    out = df.repartitionByRange(*cluster_by) if cluster_by else df
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def plane_layout(df: DataFrame, path: str, x: str, y: str, tie: str) -> DataFrame:
    """Lay data out by place in the plane: along the Z-order curve, so a box in x and y, or a range of
    either alone, skips files and row groups. ``tie`` tells rows at one place apart."""
    bounds = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    x0, x1, y0, y1 = (bounds.select(c).scalar() for c in ("x0", "x1", "y0", "y1"))
    key = "__morton"
    out = df.withColumn(key, morton_key(F.col(x), F.col(y), (x0, x1), (y0, y1)))
    out.repartitionByRange(key, tie).sortWithinPartitions(key, tie).drop(key).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW`` (SNK-4): a session temp view over the lazy plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def with_batch(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumn(BATCH_COL, F.lit(batch_id))
