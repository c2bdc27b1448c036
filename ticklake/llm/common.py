"""Helpers shared by the pipeline operators: shared scratch tables and row ids."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Row id that the operators add; it does not clash with columns of documents.
RID = "__rid"

#: The white space of all contracts: space and the controls 0x09 to 0x0D.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder of ``spark.checkpoint.dir``.

    Unset, a private folder is taken in local mode (tests); on a cluster that
    is an error, since executors would write to their own disks.
    """
    conf = spark.sparkContext.getConf()
    base = (spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
            or spark.sparkContext.getCheckpointDir())
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


#: Lists that note the scratch tables being written, innermost last.
_NOTED: list[list[str]] = []


@contextmanager
def noted(paths: list[str]):
    """Adds the scratch tables written inside to ``paths``, for ``remove``."""
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        _NOTED.pop()


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that no result depends on any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        p = jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(conf).delete(p, True)


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to shared scratch and read it back: lineage ends there."""
    path = scratch(df.sparkSession, name)
    if _NOTED:
        _NOTED[-1].append(path)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` plus a row id, stored: a later scan sees the same ids."""
    return stored(df.withColumn(RID, F.monotonically_increasing_id()), name, "zstd")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_space(text: Column) -> Column:
    """``text`` without the characters of SPACE."""
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with row ids) whose id is in ``kept``, without the id."""
    return docs.join(kept.select(RID), RID, "left_semi").drop(RID)
