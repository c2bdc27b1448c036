"""The load: bucketed duplicate check, stored ids, observed counts."""

import random

import pytest
from pyspark.sql import functions as F

from ticklake.operators import classify as C
from ticklake.operators.audit import row_numbers
from ticklake.plans import ingest as ing
from ticklake.plans.ingest import IngestJob, IngestPaths
from ticklake.sinks.bucketed import BucketedTable

import seed
from test_ingest_edges import _rows, _staging


@pytest.fixture
def job(spark, tmp_path):
    w = seed.build(spark, 5)
    return IngestJob(spark, IngestPaths(fact=str(tmp_path / "fact"), log=str(tmp_path / "log"), buckets=8),
                     w.player, w.volunteer, w.session, w.sector)


@pytest.fixture(params=["4", "32"])
def no_broadcast(spark, request):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": request.param}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def above_scan(plan, table):
    """Nodes between the fact's scan and the join that reads it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    depth, out = lines[at].index("FileScan"), []
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if d < depth:
            out.append(line.strip(" :+-"))
            depth = d
        if "Join" in line and d <= depth:
            break
    return lines[at], out


def test_the_fact_is_not_shuffled(spark, job, no_broadcast):
    job.run(_rows(spark, *({"raw_tic": str(t)} for t in range(9))), "b1")
    own = C.classify_primary(_rows(spark, *({"raw_tic": str(t)} for t in range(5, 14))), job.player, job.volunteer,
                             job.session, job.sector).filter(F.col("_reason") == C.CANDIDATE)
    flagged = C.flag_duplicates(own, job.current_fact("b2", own), job.fact.stored_buckets())
    scan, above = above_scan(flagged._jdf.queryExecution().executedPlan().toString(), job.fact.name)
    assert "Bucketed: true" in scan and "rango" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert any("SortMergeJoin" in x for x in above) and not any("Exchange" in x for x in above)
    assert sorted(r.tic for r in flagged.filter("_dup_core").collect()) == [5, 6, 7, 8]


def test_more_ranges_than_are_named(spark, job, monkeypatch):
    monkeypatch.setattr(ing, "RANGE", 1)
    monkeypatch.setattr(ing, "MOST_RANGES", 1)
    rows = [{"raw_id_partida": "1"}, {"raw_id_partida": "2", "raw_id_jugador": "3", "raw_id_sector": "3"}]
    job.run(_rows(spark, *rows), "b1")
    keys = job.current_fact("b2", spark.createDataFrame([(1,), (2,), (9,)], "id_partida int"))
    assert sorted(r.id_partida for r in keys.collect()) == [1, 2]
    assert job.run(_rows(spark, *rows), "b2")["accepted"] == 0


def test_log_ids_and_counts(spark, job):
    a = job.run(_staging(spark), "b1")
    b = job.run(_rows(spark, {"raw_tic": "x"}, {"raw_tic": ""}, {"raw_tic": "77"}), "b2")
    log, fact = spark.read.parquet(job.paths.log), spark.read.parquet(job.paths.fact)
    for out in (a, b):
        of = F.col("id_lote") == out["batch"]
        assert (log.filter(of).count(), fact.filter(of).count()) == (out["rejects"], out["accepted"])
    n = a["rejects"] + b["rejects"]
    assert sorted(r.id_log for r in log.collect()) == list(range(1, n + 1))
    assert sorted(r.id_evento for r in fact.collect()) == list(range(1, a["accepted"] + b["accepted"] + 1))
    assert {r.id_log for r in log.filter("id_lote = 'b2'").collect()} == set(range(a["rejects"] + 1, n + 1))
    job.run(_rows(spark, {"raw_tic": "x"}), "b2")               # a corrected run numbers on from the other batches
    assert sorted(r.id_log for r in spark.read.parquet(job.paths.log).collect()) == list(range(1, a["rejects"] + 2))


def test_top_of_the_log_needs_no_shuffle_of_it(spark, job):
    job.run(_staging(spark), "b1")
    top = ing.recent_rejects(spark.read.parquet(job.paths.log), 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    n = spark.read.parquet(job.paths.log).count()
    assert [r.id_log for r in top.collect()] == [n, n - 1, n - 2]


def test_row_numbers_follow_the_files(spark, tmp_path):
    rng = random.Random(1)
    values = [rng.randrange(1000) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v int").repartitionByRange(13, "v").sortWithinPartitions("v")
    rows.write.parquet(str(tmp_path / "whole"))
    got = row_numbers(spark.read.parquet(str(tmp_path / "whole")), "n", 100).orderBy("n").collect()
    assert [(r.n, r.v) for r in got] == list(enumerate(sorted(values), 101))
    rows.withColumn("part", F.col("v") % 2).write.partitionBy("part").parquet(str(tmp_path / "parts"))
    for part in (0, 1):
        got = row_numbers(spark.read.parquet(str(tmp_path / "parts")).filter(f"part = {part}"), "n").collect()
        assert sorted(r.n for r in got) == list(range(1, len(got) + 1))
        assert sorted(r.v for r in got) == sorted(v for v in values if v % 2 == part)


def test_a_table_without_buckets_stays_readable_and_writable(spark, job, tmp_path):
    first = IngestJob(spark, IngestPaths(str(tmp_path / "old"), str(tmp_path / "oldlog")), job.player, job.volunteer, job.session, job.sector)
    first.run(_rows(spark, {}), "b1")
    plain = str(tmp_path / "plain")
    spark.read.parquet(first.paths.fact).write.partitionBy("id_lote", "rango").parquet(plain)
    again = IngestJob(spark, IngestPaths(plain, str(tmp_path / "plainlog")), job.player, job.volunteer, job.session, job.sector)
    assert again.run(_rows(spark, {}, {"raw_tic": "11"}), "b2")["accepted"] == 1
    assert sorted(r.id_evento for r in spark.read.parquet(plain).collect()) == [1, 2]


def test_a_new_session_finds_the_buckets(spark, job):
    job.run(_rows(spark, {}), "b1")
    spark.sql(f"DROP TABLE {job.fact.name}")
    again = BucketedTable(spark, job.paths.fact, job.fact.columns, job.fact.key, job.fact.partition_by, buckets=99)
    assert again.read().count() == 1
    assert spark.sql(f"DESCRIBE EXTENDED {again.name}").filter("col_name = 'Num Buckets'").first().data_type == "8"


def test_files_follow_the_rows_not_the_spread_of_the_sessions(spark, job, monkeypatch):
    monkeypatch.setattr(ing, "RANGE", 1)
    one, two = {"raw_id_partida": "1"}, {"raw_id_partida": "2", "raw_id_jugador": "3", "raw_id_sector": "3"}
    rows = [r | {"raw_tic": str(t)} for r in (one, two) for t in range(3)]
    ranges = lambda batch: spark.read.parquet(job.paths.fact).filter(F.col("id_lote") == batch).select("rango").distinct().count()
    assert job.run(_rows(spark, *rows), "b1")["accepted"] == 6
    assert ranges("b1") == 1
    monkeypatch.setattr(ing, "RANGE_ROWS", 1)                    # the next batch has narrow ranges
    assert job.run(_rows(spark, *rows, *(r | {"raw_tic": "7"} for r in (one, two))), "b2")["accepted"] == 2
    assert ranges("b2") == 2
    # What lies in ranges of either width is found by the next batch, and nothing of other sessions is read.
    again = _rows(spark, *rows, *(r | {"raw_tic": t} for r in (one, two) for t in ("7", "8")))
    assert job.run(again, "b3")["accepted"] == 2
    only = job.current_fact("b4", spark.createDataFrame([(1,)], "id_partida int"))
    assert sorted((r.id_partida, r.tic) for r in only.filter("tic > 3").collect()) == [(1, 7), (1, 8)]
    assert job.run(again, "b1")["accepted"] == 6
    assert spark.read.parquet(job.paths.fact).groupBy("id_partida", "id_jugador", "tic").count().filter("count > 1").count() == 0
