"""The hotspot view follows loads from the batch and the stored presence state alone."""

import os

from pyspark.sql import functions as F

from ticklake.plans import analytics as an
from ticklake.plans.hotspot_view import HotspotView

import seed

COLUMNS = ["id_partida", "id_jugador", "id_sector", "tic", "salud", "municion"]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def batch(spark, rows):
    return spark.createDataFrame(rows, "id_partida int, id_jugador long, id_sector long, tic int, salud int, municion int")


def test_several_loads_and_a_corrected_batch(spark, tmp_path):
    w = seed.build(spark, 6)
    view = HotspotView(spark, str(tmp_path), w.sector, w.map, w.episode)
    batches = {
        "b=0": w.tick_event.select(*COLUMNS),
        "b1": batch(spark, [(1, 1, 2, 900, 50, 1), (1, 2, 2, 900, None, 2), (2, 9, 3, 1, 70, None), (2, 9, None, 2, 70, 3)]),
        "b2": batch(spark, [(1, 1, 2, 901, 51, 1), (5, 1, 2, 902, 52, 9), (5, 7, 4, 1, 10, 10)]),
    }

    def check():
        fact = None
        for df in batches.values():
            fact = df if fact is None else fact.unionByName(df)
        assert rows_of(view.read()) == rows_of(an.hotspots(fact, w.sector, w.map, w.episode))

    for name, df in batches.items():
        view.load(df, name)
    check()
    batches["b1"] = batch(spark, [(1, 1, 2, 900, 50, 1)])      # corrected: players and a sector fall away
    view.load(batches["b1"], "b1")
    check()
    batches["b1"] = batch(spark, []).limit(0)                  # withdrawn
    view.load(batches["b1"], "b1")
    check()
    assert len([d for d in os.listdir(tmp_path / "view") if d.startswith("version=")]) == 2


def test_a_refresh_reads_the_batch_and_the_state_only(spark, tmp_path):
    w = seed.build(spark, 6)
    fact = str(tmp_path / "fact")
    w.tick_event.select(*COLUMNS).write.parquet(fact)
    view = HotspotView(spark, str(tmp_path / "mv"), w.sector, w.map, w.episode)
    view.load(spark.read.parquet(fact), "b0")
    view.load(batch(spark, [(1, 1, 2, 900, 50, 1)]), "b1")
    plan = view.refreshed(spark.createDataFrame([(2,)], "id_sector long"))
    files = plan.inputFiles()
    assert any("/mv/state" in f for f in files) and not any("/fact/" in f for f in files)
    read = {f.split("/mv/")[1].split("/")[0] for f in files if "/mv/" in f}
    assert read == {"state", "view"}


def test_state_of_a_union_is_the_union_of_states(spark):
    from ticklake.operators.presence import merged, presence_state
    a = batch(spark, [(1, 1, 1, 1, 5, 5), (1, 1, 1, 2, 6, None), (1, 2, 1, 1, None, 7)])
    b = batch(spark, [(1, 1, 1, 3, 5, 5), (2, 1, 1, 1, 9, 9), (2, 1, 4, 1, 9, 9)])
    whole = rows_of(presence_state(a.unionByName(b)).select("id_sector", "clase", "id", "eventos", "salud_n", "salud_suma"))
    parts = merged(presence_state(a).unionByName(presence_state(b)))
    assert rows_of(parts.select("id_sector", "clase", "id", "eventos", "salud_n", "salud_suma")) == whole
    assert parts.filter("clase = 'J'").agg(F.sum("eventos")).first()[0] == 6
