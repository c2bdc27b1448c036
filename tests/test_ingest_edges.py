"""Reject classification: one case per reason, plus the reference's hole,
double logging, overflow, leading zeros and a trailing newline (FIXTURES §3)."""

import datetime as dt
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.operators import classify as C
from ticklake.plans.ingest import IngestJob, IngestPaths
from ticklake.sources.tsv import read_staging

import seed

BASE = dict(raw_id_partida="1", raw_id_jugador="1", raw_tic="10", raw_pos_x="1.5", raw_pos_y="2.5",
            raw_pos_z="3.5", raw_angulo="0", raw_momentum_x="0", raw_momentum_y="0",
            raw_momentum_z="0", raw_fov="90", raw_salud="100", raw_armadura="50",
            raw_municion="20", raw_id_sector="1")
T0 = dt.datetime(2026, 1, 1, 12, 0, 0)

CASES = [  # (label, overrides, expected reasons)
    ("blank session", dict(raw_id_partida=""), ["MISSING_KEY"]),
    ("spaces session", dict(raw_id_partida="  "), ["MISSING_KEY"]),
    ("null session", dict(raw_id_partida=None), ["MISSING_KEY"]),
    ("player 12x", dict(raw_id_jugador="12x", raw_tic="11"), ["BAD_TYPE"]),
    ("session ' 5'", dict(raw_id_partida=" 5", raw_tic="12"), ["BAD_TYPE"]),
    ("health empty", dict(raw_salud="", raw_tic="13"), ["BAD_TYPE"]),
    ("fov abc", dict(raw_fov="abc", raw_tic="14"), ["BAD_TYPE"]),
    ("tick -1", dict(raw_tic="-1"), ["OUT_OF_RANGE"]),
    ("session newline", dict(raw_id_partida="1\n", raw_tic="15"), ["BAD_TYPE"]),
    ("health null", dict(raw_salud=None, raw_tic="16"), ["UNCLASSIFIED"]),
    ("health null + 12x", dict(raw_salud=None, raw_id_jugador="12x", raw_tic="17"), ["BAD_TYPE"]),
    ("health overflow", dict(raw_salud="99999999999", raw_tic="18"), ["OVERFLOW"]),
    ("pos_x 9 digits", dict(raw_pos_x="123456789.5", raw_tic="19"), ["OVERFLOW"]),
    ("sector blank", dict(raw_id_sector="", raw_tic="20"), []),
    ("sector null", dict(raw_id_sector=None, raw_tic="21"), []),
    ("sector other map", dict(raw_id_sector="3", raw_tic="22"), ["FK_SECTOR"]),
    ("player+session unknown", dict(raw_id_jugador="99", raw_id_partida="99", raw_tic="23"), ["FK_PLAYER"]),
    ("session unknown", dict(raw_id_partida="99", raw_tic="24"), ["FK_SESSION"]),
    ("no consent + bad sector", dict(raw_id_jugador="7", raw_id_sector="3", raw_tic="25"), ["FK_SECTOR"]),
    ("no consent", dict(raw_id_jugador="7", raw_tic="26"), ["NO_CONSENT"]),
    ("leading zero first", dict(raw_id_partida="001", raw_id_jugador="2", raw_tic="30"), []),
    ("leading zero dup", dict(raw_id_partida="1", raw_id_jugador="2", raw_tic="30"), ["DUP_BATCH"]),
    ("in core, first copy", dict(raw_id_jugador="3", raw_tic="40"), ["DUP_CORE"]),
    ("in core, second copy", dict(raw_id_jugador="3", raw_tic="40"), ["DUP_BATCH", "DUP_CORE"]),
]


def _staging(spark):
    rows = []
    for i, (_, over, _) in enumerate(CASES):
        r = {**BASE, **over}
        rows.append(tuple(r[f] for f in S.RAW_FIELDS) + ("batch.tsv", T0, i))
    schema = S.T.StructType([*S.STAGING.fields, S.T.StructField("_row_id", S.L, False)])
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def star(spark):
    w = seed.build(spark, 5)
    w.volunteer = w.volunteer.unionByName(spark.createDataFrame(
        [(7, "USR_7", 30, None, "x", False, T0)], S.VOLUNTEER))
    w.player = w.player.unionByName(spark.createDataFrame([(7, "alias_7", 7)], S.PLAYER))
    w.fact = spark.createDataFrame([(1, 3, 40)], "id_partida int, id_jugador long, tic int")
    return w


@pytest.fixture(scope="module")
def classified(spark, star):
    return C.classify(_staging(spark), star.player, star.volunteer, star.session, star.sector,
                      star.fact).cache()


def test_each_case(classified):
    log = C.reject_log(classified).groupBy("linea_raw").agg(F.collect_list("motivo").alias("m"))
    got = {r.linea_raw: sorted(r.m) for r in log.collect()}
    for label, over, expected in CASES:
        line = "\t".join(v for v in ({**BASE, **over}[f] for f in S.RAW_FIELDS) if v is not None)
        if label == "in core, first copy":
            continue    # identical lines: checked together below
        if label == "in core, second copy":
            assert sorted(got[line]) == ["DUP_BATCH", "DUP_CORE", "DUP_CORE"], label
            continue
        assert sorted(got.get(line, [])) == sorted(expected), label


def test_accepted_rows(classified):
    acc = C.accepted(classified).collect()
    keys = sorted((r.id_partida, r.id_jugador, r.tic, r.id_sector) for r in acc)
    # blank and NULL sector (ticks 20, 21) and the first of the leading-zero pair (tick 30)
    assert keys == [(1, 1, 20, None), (1, 1, 21, None), (1, 2, 30, 1)]


def test_every_row_accounted(classified):
    counts = Counter(r._reason for r in classified.select("_reason").collect())
    assert sum(counts.values()) == len(CASES)
    assert "UNCLASSIFIED" in counts


def test_tsv_column_count_and_nulls(spark, star, tmp_path):
    path = tmp_path / "in.tsv"
    good = "\t".join(BASE[f] for f in S.RAW_FIELDS)
    short = "\t".join(BASE[f] for f in S.RAW_FIELDS[:14])
    long = good + "\textra"
    null_health = "\t".join(r"\N" if f == "raw_salud" else BASE[f] for f in S.RAW_FIELDS)
    header = "\t".join(f.removeprefix("raw_") for f in S.RAW_FIELDS)
    path.write_text("\n".join([header, good, short, long, null_health]) + "\n")
    stg = read_staging(spark, str(path))
    cls = C.classify(stg, star.player, star.volunteer, star.session, star.sector, star.fact)
    reasons = sorted(r._reason for r in cls.select("_reason").collect())
    assert reasons == ["BAD_COLUMN_COUNT", "BAD_COLUMN_COUNT", "CANDIDATE", "UNCLASSIFIED"]


def test_job_is_idempotent(spark, star, tmp_path):
    paths = IngestPaths(fact=str(tmp_path / "fact"), log=str(tmp_path / "log"))
    job = IngestJob(spark, paths, star.player, star.volunteer, star.session, star.sector,
                    seed_fact=star.fact)
    first = job.run(_staging(spark), "b1")
    again = job.run(_staging(spark), "b1")
    assert first == again
    assert first["accepted"] == 3
    assert first["rejects"] == len(CASES) - 3 + 1   # one row carries two reasons
    # a second, different batch sees b1's rows as already loaded
    second = job.run(_staging(spark), "b2")
    assert second["accepted"] == 0


def _rows(spark, *overrides):
    schema = S.T.StructType([*S.STAGING.fields, S.T.StructField("_row_id", S.L, False)])
    return spark.createDataFrame([tuple({**BASE, **o}[f] for f in S.RAW_FIELDS) + ("b.tsv", T0, i)
                                  for i, o in enumerate(overrides)], schema)


def test_first_batch_without_rejects(spark, star, tmp_path):
    paths = IngestPaths(fact=str(tmp_path / "fact"), log=str(tmp_path / "log"))
    job = IngestJob(spark, paths, star.player, star.volunteer, star.session, star.sector)
    assert job.run(_rows(spark, {}, {"raw_tic": "11"}), "b1") == {"batch": "b1", "staging": 2, "rejects": 0, "accepted": 2}
    # A batch of rejects only, and an empty one.
    assert job.run(_rows(spark, {"raw_tic": ""}), "b2")["accepted"] == 0
    assert job.run(_rows(spark, {}).limit(0), "b3") == {"batch": "b3", "staging": 0, "rejects": 0, "accepted": 0}
    assert spark.read.parquet(paths.fact).count() == 2


def test_corrected_rerun_leaves_nothing_behind(spark, star, tmp_path):
    paths = IngestPaths(fact=str(tmp_path / "fact"), log=str(tmp_path / "log"))
    job = IngestJob(spark, paths, star.player, star.volunteer, star.session, star.sector)
    job.run(_rows(spark, {"raw_tic": ""}, {"raw_tic": "12"}), "b0")
    job.run(_rows(spark, {}, {"raw_tic": "x"}), "b1")
    assert job.run(_rows(spark, {}), "b1") == {"batch": "b1", "staging": 1, "rejects": 0, "accepted": 1}
    assert spark.read.parquet(paths.log).filter("id_lote = 'b1'").count() == 0
    job.run(_rows(spark, {"raw_tic": "x"}), "b1")
    assert spark.read.parquet(paths.fact).filter("id_lote = 'b1'").count() == 0
    assert spark.read.parquet(paths.log).count() == 2


def test_event_ids_go_on_and_the_fact_is_pruned(spark, star, tmp_path):
    paths = IngestPaths(fact=str(tmp_path / "fact"), log=str(tmp_path / "log"))
    job = IngestJob(spark, paths, star.player, star.volunteer, star.session, star.sector)
    job.run(_rows(spark, *({"raw_tic": str(t)} for t in range(5))), "b1")
    job.run(_rows(spark, *({"raw_tic": str(t)} for t in range(3, 9))), "b2")
    assert sorted(r.id_evento for r in spark.read.parquet(paths.fact).collect()) == list(range(1, 10))
    keys = job.current_fact("b3", _rows(spark, {}).select(F.lit(1).alias("id_partida")))
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "rango" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_two_jobs_with_one_batch_id(spark, star, tmp_path):
    jobs = [IngestJob(spark, IngestPaths(fact=str(tmp_path / k / "fact"), log=str(tmp_path / k / "log")),
                      star.player, star.volunteer, star.session, star.sector) for k in "ab"]
    jobs[0].run(_rows(spark, {}), "b1")
    jobs[1].run(_rows(spark, {}, {"raw_tic": "11"}), "b1")
    assert [spark.read.parquet(j.paths.fact).count() for j in jobs] == [1, 2]


def test_tsv_escapes(spark, star, tmp_path):
    from ticklake.sources.tsv import write_tsv
    # "5" + escaped newline in the session field: decodes to "5\n" -> BAD_TYPE (T2)
    fields = [r"5\n" if f == "raw_id_partida" else BASE[f] for f in S.RAW_FIELDS]
    header = "\t".join(f.removeprefix("raw_") for f in S.RAW_FIELDS)
    path = tmp_path / "esc.tsv"
    path.write_text(header + "\n" + "\t".join(fields) + "\n")
    stg = read_staging(spark, str(path))
    assert stg.first().raw_id_partida == "5\n"
    cls = C.classify(stg, star.player, star.volunteer, star.session, star.sector, star.fact)
    assert [r._reason for r in cls.select("_reason").collect()] == ["BAD_TYPE"]
    # round trip of awkward text through the writer and the reader
    odd = ["a\\b", "tab\there", "new\nline", "\\N", None, "", "  ", "back\\\\n", "cr\rx"]
    rows = []
    for i, v in enumerate(odd):
        r = dict(BASE, raw_pos_x=v, raw_tic=str(100 + i))
        rows.append(tuple(r[f] for f in S.RAW_FIELDS) + ("x", T0, i))
    schema = S.T.StructType([*S.STAGING.fields, S.T.StructField("_row_id", S.L, False)])
    out = tmp_path / "rt"
    write_tsv(spark.createDataFrame(rows, schema), str(out))
    back = sorted(((r.raw_tic, r.raw_pos_x) for r in read_staging(spark, str(out)).collect()))
    assert back == sorted((str(100 + i), v) for i, v in enumerate(odd))
