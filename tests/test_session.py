"""Session settings: semantics always applied, sizing only by an explicit profile."""

from ticklake.session import CLUSTER_CONF, configure, ensure_checkpoint_dir


def test_profiles_and_per_query_configuration(spark):
    keys = list(CLUSTER_CONF)
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        configure(spark, profile="cluster")
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "512MB"
        configure(spark)                      # what every registered query runs
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "512MB"
        assert spark.conf.get("spark.sql.ansi.enabled") == "true"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        configure(spark, profile="local")


def test_checkpoint_dir_is_read_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    import pytest
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_events_of_a_day_that_has_no_number_are_refused(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F
    from ticklake.sources.bindings import Warehouse
    for name in ("region", "nation", "customer", "supplier"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(5)
    ev.withColumn("ts", F.col("ts") + F.expr("INTERVAL 400 DAYS")).write.parquet(str(tmp_path / "events.parquet"))
    with pytest.raises(Exception, match="events outside of 366 days"):
        Warehouse(spark, str(tmp_path)).session.collect()
