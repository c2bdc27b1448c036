"""SparkSession construction and the session-level settings every job relies on.

Settings that change results (ANSI mode, UTC) are applied to any session handed
in; sizing knobs are only defaulted when the caller (a test, bench or the
cluster config) has not set them.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that the operators' semantics depend on.
SEMANTIC_CONF = {
    "spark.sql.ansi.enabled": "true",          # bad casts and /0 raise (T7): use try_cast/nullif
    "spark.sql.session.timeZone": "UTC",
}

# Runtime re-planning: coalesce small shuffles, split skewed join partitions,
# turn sort-merge joins into broadcast joins when a side is measured small.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}

# Sizing for one machine / tests. Pair joins turn a small input into a large
# output, and AQE sizes partitions by input bytes; a low floor for coalesced
# partitions keeps small inputs spread over the cores.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
}


# Sizing for a large cluster (hundreds of TB, ~1000 executors). Shuffles start
# with many partitions and AQE coalesces them to ~256 MB each (respecting the
# advisory size rather than maximising parallelism); scan splits are 512 MB;
# a partition counts as skewed above 1 GB and 5x the median and is split;
# dimension sides up to 64 MB (measured) are broadcast, nothing larger.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1GB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def configure(spark: SparkSession, profile: str | None = None) -> SparkSession:
    """Apply the semantic and adaptive settings (never sizing, unless a profile
    is named: ``"cluster"`` adds CLUSTER_CONF, ``"local"`` adds LOCAL_CONF)."""
    conf = {**SEMANTIC_CONF, **ADAPTIVE_CONF}
    conf.update({"cluster": CLUSTER_CONF, "local": LOCAL_CONF}.get(profile or "", {}))
    for k, v in conf.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def build(master: str = "local[8]", app: str = "ticklake", shuffle_partitions: int = 8,
          extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session and call ``configure``."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("TICKLAKE_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**SEMANTIC_CONF, **ADAPTIVE_CONF, **LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark, profile="local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is left alone. Only when
    it is unset in local mode (tests) a private scratch folder is created; on a
    cluster that is an error, since every executor would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ticklake-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
