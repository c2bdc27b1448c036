"""Properties of the custom operators against their plain formulations."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.operators.audit import surrogate_keys
from ticklake.operators.pairs import co_presence, pair_proximity
from ticklake.operators.ranking import first_per_key, rank_distributed
from ticklake.operators.trajectory import lag_columns, path_length
from ticklake.plans import analytics as an

import seed


def _points(spark, n=600, seed_=7, spread=120.0, with_null=True):
    rnd = random.Random(seed_)
    rows = []
    for i in range(n):
        s, t = rnd.randint(1, 3), rnd.randint(0, 5)
        def c():
            # grid-aligned values exercise the "exactly at the radius" boundary
            return Decimal(rnd.choice([rnd.randint(0, 12) * 10, round(rnd.uniform(0, spread), 4)])).quantize(Decimal("0.0001"))
        x, y, z = c(), c(), c() / 4
        if with_null and i % 97 == 0:
            x = None
        rows.append((s, t, i, x, y, z))
    return spark.createDataFrame(rows, "id_partida int, tic int, id_jugador long, pos_x decimal(12,4), "
                                       "pos_y decimal(12,4), pos_z decimal(12,4)")


@pytest.mark.parametrize("axes,radius,factor", [(2, 50, 1), (2, 50, 2), (3, 50, 1), (3, 50, 3),
                                                (1, 30, 2), (2, 7.5, 1), (2, 7.5, 4)])
def test_grid_equals_brute_force(spark, axes, radius, factor):
    pts = _points(spark)
    cols = ["id_partida", "tic", "a", "b", "dist"]
    g = pair_proximity(pts, radius=radius, grid=True, grid_axes=axes, cell_factor=factor).select(*cols)
    b = pair_proximity(pts, radius=radius, grid=False).select(*cols)
    gs, bs = sorted(g.collect()), sorted(b.collect())
    assert len(gs) > 10 and gs == bs


def test_pairs_invariant_to_row_order(spark):
    pts = _points(spark)
    a = sorted(pair_proximity(pts).collect())
    b = sorted(pair_proximity(pts.orderBy(F.rand(3)).repartition(5)).collect())
    assert a == b


def _tracks(spark, n=400):
    rnd = random.Random(11)
    seen, rows = set(), []
    while len(rows) < n:
        p, s, t = rnd.randint(1, 4), rnd.randint(1, 3), rnd.randint(0, 60)
        if (p, s, t) in seen:
            continue
        seen.add((p, s, t))
        v = [Decimal(rnd.randint(0, 10000)) / 100 for _ in range(3)]
        if rnd.random() < 0.05:
            v[1] = None
        rows.append((p, s, t, *v))
    return spark.createDataFrame(rows, "id_jugador long, id_partida int, tic int, pos_x decimal(12,4), "
                                       "pos_y decimal(12,4), pos_z decimal(12,4)")


def test_chunked_lag_equals_window(spark):
    d = _tracks(spark)
    w = Window.partitionBy("id_jugador", "id_partida").orderBy("tic")
    plain = d.select("id_jugador", "id_partida", "tic", *[F.lag(c).over(w).alias(f"prev_{c}")
                                                           for c in ("pos_x", "pos_y", "pos_z")])
    for chunk in (1, 3, 7, 1 << 16):
        got = lag_columns(d, ["id_jugador", "id_partida"], "tic", ["pos_x", "pos_y", "pos_z"], chunk=chunk) \
            .select(*plain.columns)
        assert sorted(got.collect()) == sorted(plain.collect()), chunk


def test_chunked_path_length_equals_window(spark):
    d = _tracks(spark)
    w = Window.partitionBy("id_jugador", "id_partida").orderBy("tic")
    sq = sum(((F.col(c) - F.lag(c).over(w)) ** 2 for c in ("pos_x", "pos_y", "pos_z")), F.lit(0))
    plain = (d.select("id_jugador", "id_partida", "tic", F.sqrt(sq).alias("s"))
             .groupBy("id_jugador", "id_partida").agg(F.sum("s").alias("s"), F.count("tic").alias("n")))
    exp = {(r.id_jugador, r.id_partida): (r.s, r.n) for r in plain.collect()}
    for chunk in (2, 5, 1 << 16):
        got = {(r.id_jugador, r.id_partida): (r.steps_sum, r.n_rows)
               for r in path_length(d, chunk=chunk).collect()}
        assert got.keys() == exp.keys()
        for k, (s, n) in exp.items():
            assert got[k][1] == n
            assert (got[k][0] is None) == (s is None)
            if s is not None:
                assert abs(float(got[k][0]) - s) < 1e-6 * n


def test_rank_distributed_equals_rank(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(rnd.randint(1, 4), rnd.randint(0, 20), i) for i in range(300)],
                               "g int, v int, id int")
    w = Window.partitionBy("g").orderBy("v")
    exp = sorted(df.withColumn("rk", F.rank().over(w).cast("long")).collect())
    got = sorted(rank_distributed(df, ["g"], "v", "rk").select("g", "v", "id", "rk").collect())
    assert got == exp


def test_surrogate_keys_equal_row_number(spark):
    rnd = random.Random(9)
    keys = list({(rnd.randint(0, 50), rnd.randint(0, 50)) for _ in range(400)})
    df = spark.createDataFrame(keys, "a int, b int")
    exp = sorted(df.withColumn("id", F.row_number().over(Window.orderBy("a", "b")).cast("long")).collect())
    got = sorted(surrogate_keys(df, ["a", "b"], "id", partitions=5).select("a", "b", "id").collect())
    assert got == exp


def test_first_per_key_equals_row_number(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.randint(0, 9), rnd.randint(0, 5), f"l{rnd.randint(0, 99)}", i)
                                for i in range(300)], "k int, t int, line string, rid int")
    w = Window.partitionBy("k").orderBy("t", "line", "rid")
    exp = sorted(df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect())
    got = sorted(first_per_key(df, ["k"], ["t", "line", "rid"]).collect())
    assert got == exp


def test_copresence_counts_distinct_ticks(spark):
    rows = [(1, 1, 5, 10), (1, 1, 5, 11), (1, 1, 5, 11), (1, 2, 5, 10), (1, 2, 5, 11), (1, 2, None, 12)]
    df = spark.createDataFrame(rows, "id_partida int, tic int, id_sector long, id_jugador long")
    got = sorted((r.tic, r.a, r.b) for r in co_presence(df).collect())
    assert got == [(1, 10, 11), (2, 10, 11)]


def test_equal_aliases_merge_in_q2_q6_not_v2(spark):
    w = seed.build(spark, 20)
    # a third player in session 1 with the alias of player 2, same positions
    extra = w.tick_event.filter("id_jugador = 2").withColumn("id_jugador", F.lit(9).cast("long")) \
        .withColumn("id_evento", F.col("id_evento") + 100000)
    w.tick_event = w.tick_event.unionByName(extra)
    w.player = w.player.unionByName(spark.createDataFrame([(9, "alias_2", 6)], S.PLAYER))
    q2 = [r for r in an.q2_pair_proximity(w).collect() if r.id_partida == 1]
    # pairs (1,2), (1,9) merge into (alias_1, alias_2); (2,9) is (alias_2, alias_2)
    assert sorted((r.jugador_a, r.jugador_b, r.tics_dentro_umbral) for r in q2) == \
        [("alias_1", "alias_2", 40), ("alias_2", "alias_2", 20)]
    q6 = [r for r in an.q6_copresence_pct(w).collect() if r.id_partida == 1]
    assert sorted((r.jugador_a, r.jugador_b, r.tics_compartidos) for r in q6) == \
        [("alias_1", "alias_2", 20), ("alias_2", "alias_2", 20)]
    v2 = [r for r in an.v_sector_copresence(w).collect() if r.id_partida == 1]
    assert sorted((r.jugador_a, r.jugador_b) for r in v2) == [(1, 2), (1, 9), (2, 9)]


def test_series_equals_sequence(spark):
    from ticklake.operators.series import series
    df = spark.createDataFrame([(1, 0, 23), (2, 5, 5), (3, 9, 4), (4, -3, 10000)], "k int, lo int, hi int")
    got = sorted((r.k, r.tic) for r in series(df, ["k"], "lo", "hi", chunk=7).collect())
    exp = sorted((k, t) for k, lo, hi in [(1, 0, 23), (2, 5, 5), (4, -3, 10000)] for t in range(lo, hi + 1))
    assert got == exp


def test_incremental_hotspot_refresh_equals_full_recompute(spark):
    w = seed.build(spark, 10)
    stored = an.hotspots(w.tick_event, w.sector, w.map, w.episode).cache()
    # new rows only in sector 3 (map 2): map 1's row must be kept, map 2 recomputed
    new_rows = (w.tick_event.filter("id_partida = 2")
                .withColumn("id_sector", F.lit(3).cast("long"))
                .withColumn("tic", F.col("tic") + 1000))
    fact = w.tick_event.unionByName(new_rows)
    inc = an.refresh_hotspots(stored, fact, new_rows, w.sector, w.map, w.episode)
    full = an.hotspots(fact, w.sector, w.map, w.episode)
    assert sorted(inc.collect()) == sorted(full.collect())
    assert sorted(r.id_mapa for r in inc.collect()) == [1, 2]


def test_distance_sums_do_not_depend_on_partitions(spark):
    d = _tracks(spark)
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(path_length(d.repartition(int(n))).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", keep)
    assert found[0] == found[1] == found[2]


def test_surrogate_keys_with_payload_are_dense(spark):
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("k"), F.sha1(F.col("id").cast("string")).alias("payload"))
    got = surrogate_keys(df, ["k"], "id", base=50, partitions=16)
    r = got.agg(F.count_distinct("id"), F.min("id"), F.max("id"), F.count_distinct("payload")).first()
    assert tuple(r) == (1_000_000, 51, 1_000_050, 1_000_000)


def test_rank_spreads_one_group_over_partitions(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), (F.col("id") % 1700).alias("v"))
    exp = df.withColumn("rk", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))).cast("long"))
    assert rank_distributed(df, ["g"], "v", "rk", ascending=False).select("g", "v", "rk").exceptAll(exp).isEmpty()


def test_materialized_result_is_refreshed_in_place(spark, tmp_path):
    from ticklake.sinks import tables as SK
    path = str(tmp_path / "view")
    one = SK.materialize(spark.range(3).toDF("n"), path)
    two = SK.materialize(one.select((F.col("n") + 10).alias("n")), path)
    assert SK.current_version(spark, path) == 2
    assert sorted(r.n for r in two.collect()) == sorted(r.n for r in SK.read_materialized(spark, path).collect()) == [10, 11, 12]


def test_stored_tables_follow_their_sources(spark, tmp_path):
    import shutil

    from ticklake import registry
    root = tmp_path / "sf"
    root.mkdir()
    for name in ("region", "nation", "customer", "supplier"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", root / f"{name}.parquet")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.filter("event_id < 500").write.parquet(str(root / "events.parquet"))
    before = registry.queries()["src_scan"](spark, str(root)).count()
    events.filter("event_id >= 500").write.mode("append").parquet(str(root / "events.parquet"))
    after = registry.queries()["src_scan"](spark, str(root)).count()
    assert before <= 500 < after
