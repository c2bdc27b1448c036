"""Mergeable distinct state of who was in a sector, and when (AGG-3, AGG-4, SNK-5).

A distinct count cannot be updated, but the set it counts can: presence state
has one row for each (sector, player) and each (sector, session), with additive
columns. The state of a union of facts is the union of their states, so a load
adds the state of its batch and nothing else is read again. A sector's figures
are sums and counts over its state rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a state row is about.
PLAYER, SESSION = "J", "P"
STATE_SCHEMA = ("id_sector long, clase string, id long, eventos long, salud_n long, salud_suma decimal(38,0), "
                "municion_n long, municion_suma decimal(38,0)")


def presence_state(fact: DataFrame) -> DataFrame:
    """State rows of a fact: the fact is reduced once, to (sector, session, player)."""
    vitals = [x for c in ("salud", "municion")
              for x in (F.count(c).alias(f"{c}_n"), F.sum(F.col(c).cast("decimal(20,0)")).alias(f"{c}_suma"))]
    base = (fact.filter(F.col("id_sector").isNotNull()).groupBy("id_sector", "id_partida", "id_jugador")
            .agg(F.count(F.lit(1)).alias("eventos"), *vitals))
    none = [F.lit(0).cast("long").alias("salud_n"), F.lit(0).cast("decimal(38,0)").alias("salud_suma"),
            F.lit(0).cast("long").alias("municion_n"), F.lit(0).cast("decimal(38,0)").alias("municion_suma")]
    players = (base.groupBy("id_sector", F.lit(PLAYER).alias("clase"), F.col("id_jugador").cast("long").alias("id"))
               .agg(F.sum("eventos").alias("eventos")).select("*", *none))
    sums = [F.sum(f"{c}_{k}").cast("long" if k == "n" else "decimal(38,0)").alias(f"{c}_{k}")
            for c in ("salud", "municion") for k in ("n", "suma")]
    sessions = (base.groupBy("id_sector", F.lit(SESSION).alias("clase"), F.col("id_partida").cast("long").alias("id"))
                .agg(F.sum("eventos").alias("eventos"), *sums))
    return players.unionByName(sessions)


def merged(state: DataFrame) -> DataFrame:
    """One row for each (sector, class, id): the union of the states of several batches."""
    return state.groupBy("id_sector", "clase", "id").agg(
        F.sum("eventos").alias("eventos"),
        *[F.sum(c).cast("long" if c.endswith("_n") else "decimal(38,0)").alias(c)
          for c in ("salud_n", "salud_suma", "municion_n", "municion_suma")])


def sector_presence(state: DataFrame) -> DataFrame:
    """Per sector: events, distinct players and sessions, average vitals. ``state`` has one row a key."""
    session = F.col("clase") == SESSION

    def average(c):
        return F.try_divide(F.sum(f"{c}_suma").cast("decimal(28,6)"), F.sum(f"{c}_n").cast("decimal(20,0)")).alias(f"avg_{c}")
    return state.groupBy("id_sector").agg(
        F.sum(F.when(session, F.col("eventos"))).alias("total_eventos"),
        F.count_if(~session).alias("jugadores_unicos"), F.count_if(session).alias("partidas_con_presencia"),
        average("salud"), average("municion"))
