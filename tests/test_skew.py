"""A hot key holding a third of the rows is split across tasks, and results stay exact."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticklake.operators.pairs import co_presence, pair_proximity, proximity_candidates

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_events(spark, spread=4000):
    rnd = random.Random(1)
    rows = []
    # session 1, tick 0: a third of all rows, players within a spread/10-unit square
    for p in range(1200):
        rows.append((1, 0, p, Decimal(rnd.randint(0, spread)) / 10, Decimal(rnd.randint(0, spread)) / 10, 1))
    # the rest: many small (session, tick) groups
    for i in range(2400):
        rows.append((2 + i % 40, i % 60, 10000 + i, Decimal(rnd.randint(0, 4000)) / 10,
                     Decimal(rnd.randint(0, 4000)) / 10, 1 + i % 3))
    return spark.createDataFrame(rows, "id_partida int, tic int, id_jugador long, pos_x decimal(12,4), "
                                       "pos_y decimal(12,4), id_sector long") \
        .withColumn("pos_z", F.lit(0).cast("decimal(12,4)"))


def _final_plan(df):
    qe = df._jdf.queryExecution()
    n = qe.toRdd().count()
    return n, qe.executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_instant_spread_over_cells(spark, skew_conf):
    """Players spread out: the grid itself splits the hot instant over many cells."""
    ev = _hot_events(spark)
    grid = pair_proximity(ev, radius=20, grid=True)
    brute = pair_proximity(ev, radius=20, grid=False)
    assert sorted(grid.collect()) == sorted(brute.collect())
    cells = ev.filter("id_partida = 1 AND tic = 0").select(
        F.floor(F.col("pos_x") / 60).alias("cx"), F.floor(F.col("pos_y") / 60).alias("cy")).distinct()
    assert cells.count() >= 25


def test_hot_cell_is_split_by_aqe(spark, skew_conf):
    """Players packed into one cell: AQE splits the skewed join partition."""
    ev = _hot_events(spark, spread=300)
    grid = pair_proximity(ev, radius=50, grid=True)
    n, plan = _final_plan(grid.select("id_partida", "tic", "a", "b"))
    assert "SortMergeJoin(skew=true)" in plan
    assert n == pair_proximity(ev, radius=50, grid=False).count() > 0


def _candidates(ev, radius, crowd):
    return proximity_candidates(ev, ["id_partida", "tic"], "id_jugador", ("pos_x", "pos_y", "pos_z"), radius * 10 ** 4, True, 2, 4, [], 3, crowd)


def test_points_over_each_other_are_no_candidates(spark):
    """A third of the rows in one plane cell, spread over the height: candidates follow the near pairs."""
    rnd = random.Random(8)
    rows = [(1, 0, p, Decimal(rnd.randint(0, 290)) / 10, Decimal(rnd.randint(0, 290)) / 10, Decimal(rnd.randint(-20000, 20000)) / 10)
            for p in range(900)]
    rows += [(2 + i % 40, i % 30, 10000 + i, Decimal(rnd.randint(0, 4000)) / 10, Decimal(rnd.randint(0, 4000)) / 10, Decimal(0)) for i in range(1800)]
    ev = spark.createDataFrame(rows, "id_partida int, tic int, id_jugador long, pos_x decimal(12,4), pos_y decimal(12,4), pos_z decimal(12,4)")
    brute = sorted(pair_proximity(ev, radius=10, grid=False).collect())
    for crowd in (0, 5, 256, 10 ** 6):
        assert sorted(pair_proximity(ev, radius=10, crowd=crowd).collect()) == brute
    near = sum(r.id_partida == 1 for r in brute)
    whole, cut = (_candidates(ev, 10, c).filter("id_partida = 1").count() for c in (10 ** 6, 256))
    assert whole == 900 * 899 // 2 and cut < 20 * near < whole / 5


def test_crowded_cells_at_random(spark):
    rnd = random.Random(9)
    rows = [(1, t, p, *(Decimal(rnd.randint(-900, 900)) / 10 for _ in range(3))) for t in range(3) for p in range(150)]
    ev = spark.createDataFrame(rows, "id_partida int, tic int, id_jugador long, pos_x decimal(12,4), pos_y decimal(12,4), pos_z decimal(12,4)")
    brute = sorted(pair_proximity(ev, radius=20, grid=False).collect())
    for crowd in (0, 8):
        got = sorted(pair_proximity(ev, radius=20, crowd=crowd).collect())
        assert got == brute and len(got) > 100


def test_hot_place_copresence_is_split(spark, skew_conf):
    ev = _hot_events(spark)
    pairs = co_presence(ev)
    n, plan = _final_plan(pairs)
    assert "SortMergeJoin(skew=true)" in plan
    # 1200 players share (session 1, tick 0, sector 1): all pairs are co-present
    assert pairs.filter("id_partida = 1").count() == 1200 * 1199 // 2


def test_hot_copies_in_a_load(spark, skew_conf):
    """A third of a batch is copies of one key: one row is accepted, the rest are
    DUP_BATCH, and the join back to the per-key first row is split by AQE."""
    import datetime as dt

    from ticklake import schemas as S
    from ticklake.operators import classify as C

    import seed
    w = seed.build(spark, 3)
    base = dict(raw_id_partida="1", raw_id_jugador="1", raw_tic="7", raw_pos_x="1", raw_pos_y="2",
                raw_pos_z="3", raw_angulo="0", raw_momentum_x="0", raw_momentum_y="0",
                raw_momentum_z="0", raw_fov="90", raw_salud="50", raw_armadura="5",
                raw_municion="5", raw_id_sector="1")
    t0 = dt.datetime(2026, 1, 1)
    rows = [tuple(base[f] for f in S.RAW_FIELDS) + ("hot.tsv", t0, i) for i in range(1500)]
    for i in range(3000):
        r = dict(base, raw_id_jugador=str(1 + i % 2), raw_tic=str(100 + i))
        rows.append(tuple(r[f] for f in S.RAW_FIELDS) + ("cold.tsv", t0, 10000 + i))
    schema = S.T.StructType([*S.STAGING.fields, S.T.StructField("_row_id", S.L, False)])
    stg = spark.createDataFrame(rows, schema)
    primary = C.classify_primary(stg, w.player, w.volunteer, w.session, w.sector).cache()
    cls = C.mark_duplicates(primary, spark.createDataFrame([], "id_partida int, id_jugador long, tic int"))
    n, plan = _final_plan(cls)
    assert n == 4500
    assert "SortMergeJoin(skew=true)" in plan
    dup = cls.filter("_dup_batch").count()
    acc = C.accepted(cls).count()
    assert (dup, acc) == (1499, 3001)
