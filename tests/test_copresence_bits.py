"""Shared ticks as bits: equal to one row a tick, without such rows in the plan."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticklake.operators.pairs import co_presence, co_presence_bits, presence_bits
from ticklake.plans import analytics as an

import seed


def events(spark, rows):
    return spark.createDataFrame(rows, "id_partida int, tic int, id_sector long, id_jugador long")


def counted(bits):
    return {(r.id_partida, r.id_sector, r.a, r.b): r.n for r in
            bits.groupBy("id_partida", "id_sector", "a", "b").agg(F.sum(F.bit_count("shared")).alias("n")).collect()}


@pytest.mark.parametrize("width", [1, 8, 64])
def test_equal_to_one_row_a_tick(spark, width):
    rng = random.Random(3)
    rows = [(rng.randrange(3), rng.choice([rng.randrange(-70, 200), 63, 64, 127, 128, 2 ** 31 - 1, -2 ** 31]),
             rng.choice([None, 1, 2]), rng.randrange(8)) for _ in range(1500)]
    rows = sorted(set(rows), key=str) + rows[:50] + [(1, None, 1, 1)]     # repeated rows count once
    ev = events(spark, rows)
    want = Counter((r.id_partida, r.id_sector, r.a, r.b) for r in co_presence(ev.filter("tic IS NOT NULL")).collect())
    assert counted(co_presence_bits(ev, width=width)) == dict(want)


def test_crowded_sector_makes_a_row_a_pair_and_bucket(spark):
    """A third of the rows in one sector: 60 players over 640 ticks share 1,132,800 pair ticks."""
    crowd = spark.range(60 * 640).select(F.lit(1).alias("id_partida"), (F.col("id") % 640).cast("int").alias("tic"),
                                         F.lit(1).cast("long").alias("id_sector"), F.floor(F.col("id") / 640).alias("id_jugador"))
    others = spark.range(2 * 60 * 640).select((F.col("id") % 97 + 2).cast("int").alias("id_partida"), (F.col("id") % 640).cast("int").alias("tic"),
                                              (F.col("id") % 5).alias("id_sector"), F.col("id").alias("id_jugador"))
    ev = crowd.unionByName(others)
    assert presence_bits(crowd).count() == 60 * 10
    pairs = co_presence_bits(ev).filter("id_partida = 1")
    assert pairs.count() == 60 * 59 // 2 * 10
    assert pairs.agg(F.sum(F.bit_count("shared"))).first()[0] == 60 * 59 // 2 * 640


def test_no_row_a_shared_tick_in_the_plans(spark):
    w = seed.build(spark, 12)
    for df in (an.q6_copresence_pct(w), an.v_sector_copresence(w)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join Inner" in line and "a_bits" in line]
        assert joins and all("bucket" in line and "tic" not in line.replace("bucket", "") for line in joins)


def test_names_of_several_ids_unite_their_ticks(spark):
    """Two sector ids with one code and two players with one alias: shared ticks count once."""
    w = seed.build(spark, 3)
    w.sector = spark.createDataFrame([(1, 1, "S", None, None), (2, 1, "S", None, None)], w.sector.schema)
    w.player = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "y", 3)], w.player.schema)
    rows = [(1, 5, 1, 1), (1, 5, 1, 2), (1, 5, 1, 3), (1, 6, 2, 1), (1, 6, 2, 3), (1, 70, 1, 1), (1, 70, 1, 2)]
    w.tick_event = events(spark, rows)
    got = {(r.jugador_a, r.jugador_b): (r.tics_compartidos, float(r.pct_partida_juntos)) for r in an.q6_copresence_pct(w).collect()}
    assert got == {("x", "y"): (3, 100.0), ("y", "y"): (1, 33.33)}
