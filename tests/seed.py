"""A small star schema in Spark: two players walk together through each of three maps.

3 episodes / maps, 4 sectors, 6 volunteers and players, 3 sessions of 20, 50
and 5 minutes, 2 players per session, ticks 1..N per participation, every
event in sector 1, positions depending on the tick only (so the two players
of a session coincide), 10 survey items answered by every volunteer.
"""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from ticklake import schemas as S


def _ts(s):
    return dt.datetime.fromisoformat(s)


def build(spark, ticks: int = 3600):
    ep = spark.createDataFrame([(1, "Episode one"), (2, "Episode two"), (3, "Episode three")], S.EPISODE)
    mp = spark.createDataFrame([(1, 1, "M1", "Map one"), (2, 2, "M2", "Map two"), (3, 3, "M3", "Map three")], S.MAP)
    sec = spark.createDataFrame([(1, 1, "S_ENTRY", 10, 20), (2, 1, "S_FIELD", 310, 45),
                                 (3, 2, "S_LAKE", 75, 930), (4, 3, "S_HILL", 420, 15)],
                                "id_sector long, id_mapa int, codigo_sector string, x int, y int") \
        .select("id_sector", "id_mapa", "codigo_sector", F.col("x").cast(S.COORD).alias("coordenada_x"),
                F.col("y").cast(S.COORD).alias("coordenada_y"))
    vol = spark.createDataFrame([(i, f"USR_{i}", 20 + i, None, "x", True, _ts("2025-02-03 08:00:00"))
                                 for i in range(1, 7)], S.VOLUNTEER)
    pl = spark.createDataFrame([(i, f"alias_{i}", i) for i in range(1, 7)], S.PLAYER)
    ses = spark.createDataFrame([
        (1, 1, _ts("2025-03-01 09:00:00"), _ts("2025-03-01 09:20:00"), None),
        (2, 2, _ts("2025-03-02 09:00:00"), _ts("2025-03-02 09:50:00"), None),
        (3, 3, _ts("2025-03-03 09:00:00"), _ts("2025-03-03 09:05:00"), None)], S.SESSION)
    part = spark.createDataFrame([(i, (i + 1) // 2, i, None) for i in range(1, 7)], S.PARTICIPATION)
    t = F.col("tic")
    te = (part.select("id_partida", "id_jugador")
          .join(spark.range(1, ticks + 1).select(F.col("id").cast("int").alias("tic")))
          .select(F.monotonically_increasing_id().alias("id_evento"), "id_partida", "id_jugador",
                  F.lit(1).cast("long").alias("id_sector"), "tic",
                  (t * 3 % 17).cast(S.POS).alias("pos_x"), (t * 5 % 23).cast(S.POS).alias("pos_y"),
                  (t % 2).cast(S.POS).alias("pos_z"),
                  F.lit(0).cast(S.ANGLE).alias("angulo"),
                  F.lit(0).cast(S.MOMENTUM).alias("momentum_x"), F.lit(0).cast(S.MOMENTUM).alias("momentum_y"),
                  F.lit(0).cast(S.MOMENTUM).alias("momentum_z"), F.lit(90).cast(S.FOV).alias("fov"),
                  (100 - t % 40).cast("int").alias("salud"), (t % 60).cast("int").alias("armadura"),
                  (90 - t % 30).cast("int").alias("municion")))
    inst = spark.createDataFrame([(1, "UX_SURVEY", None)], S.INSTRUMENT)
    dims = ["dim_a", "dim_b", "dim_c", "dim_d", "dim_e"]
    items = spark.createDataFrame([(i, f"q{i}", dims[(i - 1) // 2], 1) for i in range(1, 11)], S.SURVEY_ITEM)
    resp = spark.createDataFrame([(u * 100 + i, _ts("2025-03-04 12:00:00"), u, i, 1, 1, None)
                                  for u in range(1, 7) for i in range(1, 11)], S.SURVEY_RESPONSE) \
        .withColumn("valor_respuesta", (F.col("id_item") % 5 + 1).cast(S.SCORE))
    ns = SimpleNamespace(spark=spark, episode=ep, map=mp, sector=sec, volunteer=vol, player=pl,
                         session=ses, participation=part, tick_event=te, instrument=inst,
                         survey_item=items, survey_response=resp)
    ns.table = lambda n: getattr(ns, n)
    return ns
