"""Continuous loading: files dropped into a landing folder go through the same
validated load, micro-batch by micro-batch."""

from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.plans.ingest import IngestJob, IngestPaths
from ticklake.streaming.landing import start_landing_stream

import seed

HEADER = "\t".join(f.removeprefix("raw_") for f in S.RAW_FIELDS)


def _line(session, player, tick, sector="1"):
    vals = dict(raw_id_partida=session, raw_id_jugador=player, raw_tic=tick, raw_pos_x="1.5",
                raw_pos_y="2.5", raw_pos_z="0", raw_angulo="0", raw_momentum_x="0",
                raw_momentum_y="0", raw_momentum_z="0", raw_fov="90", raw_salud="90",
                raw_armadura="10", raw_municion="5", raw_id_sector=sector)
    return "\t".join(vals[f] for f in S.RAW_FIELDS)


def test_landing_stream(spark, tmp_path):
    w = seed.build(spark, 3)
    land = tmp_path / "landing"
    land.mkdir()
    paths = IngestPaths(fact=str(tmp_path / "fact"), log=str(tmp_path / "log"))
    job = IngestJob(spark, paths, w.player, w.volunteer, w.session, w.sector)
    (land / "a.tsv").write_text("\n".join([HEADER, _line("1", "1", "100"), _line("1", "1", "100"),
                                           _line("", "1", "101")]) + "\n")
    q = start_landing_stream(spark, str(land), job, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    fact = spark.read.parquet(paths.fact)
    log = spark.read.parquet(paths.log)
    assert fact.count() == 1
    assert sorted(r.motivo for r in log.collect()) == ["DUP_BATCH", "MISSING_KEY"]
    # a later file: its duplicate of an already loaded key is DUP_CORE
    (land / "b.tsv").write_text("\n".join([HEADER, _line("1", "1", "100"), _line("2", "3", "7", sector="3")]) + "\n")
    q = start_landing_stream(spark, str(land), job, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    assert spark.read.parquet(paths.fact).count() == 2
    motivos = sorted(r.motivo for r in spark.read.parquet(paths.log).collect())
    assert motivos == ["DUP_BATCH", "DUP_CORE", "MISSING_KEY"]
    assert spark.read.parquet(paths.fact).select(F.countDistinct("id_lote")).first()[0] == 2


def test_two_streams_into_one_fact(spark, tmp_path):
    w = seed.build(spark, 3)
    paths = IngestPaths(fact=str(tmp_path / "fact"), log=str(tmp_path / "log"))
    job = IngestJob(spark, paths, w.player, w.volunteer, w.session, w.sector)
    for name, tick in (("a", "100"), ("b", "200")):
        land = tmp_path / name
        land.mkdir()
        (land / "x.tsv").write_text("\n".join([HEADER, _line("1", "1", tick)]) + "\n")
        start_landing_stream(spark, str(land), job, str(tmp_path / f"ckpt-{name}")).awaitTermination(300)
    assert sorted(r.tic for r in spark.read.parquet(paths.fact).collect()) == [100, 200]
