"""Goldens derivable from a seed-shaped star schema (FIXTURES §2)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticklake.plans import analytics as an

import seed

TICKS = 120   # the seed uses 3,600; the goldens below scale with it


@pytest.fixture(scope="module")
def w(spark):
    return seed.build(spark, TICKS)


def test_q1_durations(w):
    rows = an.q1_session_duration_by_map(w).collect()
    assert [(r.mapa, r.total_partidas) for r in rows] == [("M1", 1), ("M2", 1), ("M3", 1)]
    assert [r.duracion_promedio_min for r in rows] == [Decimal("20.00"), Decimal("50.00"), Decimal("5.00")]
    assert all(r.duracion_minima_min == r.duracion_promedio_min == r.duracion_maxima_min for r in rows)


def test_q2_coincident_players(w):
    rows = an.q2_pair_proximity(w).collect()
    assert len(rows) == 3
    assert all(r.tics_dentro_umbral == TICKS and r.distancia_promedio == 0 and r.distancia_minima == 0
               for r in rows)


def test_q3_all_equal(w):
    rows = an.q3_shortest_longest_path(w).collect()
    assert len(rows) == 6
    vals = {(r.trayectoria_mas_corta, r.trayectoria_mas_larga, r.trayectoria_promedio) for r in rows}
    assert len(vals) == 1
    mn, mx, av = vals.pop()
    assert mn == mx == av > 0
    assert all(r.total_partidas == 1 and r.partida_mas_corta == r.partida_mas_larga for r in rows)


def test_q4_empty_when_all_equal(w):
    assert an.q4_survey_above_avg(w).count() == 0


def test_q5_and_mv_single_sector(w):
    q5 = an.q5_sector_hotspots(w).collect()
    assert len(q5) == 1
    r = q5[0]
    assert (r.sector, r.total_presencias, r.jugadores_distintos) == ("S_ENTRY", 6 * TICKS, 6)
    assert r.presencias_por_jugador == Decimal(TICKS).quantize(Decimal("0.01"))
    mv = an.mv_sector_hotspots(w).collect()
    assert len(mv) == 1 and mv[0].partidas_con_presencia == 3 and mv[0].rank_en_mapa == 1


def test_q6_v2_full_copresence(w):
    q6 = an.q6_copresence_pct(w).collect()
    assert len(q6) == 3 and all(r.tics_compartidos == TICKS and r.pct_partida_juntos == Decimal("100.00")
                                for r in q6)
    v2 = an.v_sector_copresence(w).collect()
    assert len(v2) == 3 and all(r.tics_compartidos == TICKS for r in v2)


def test_q7_ties_kept(w):
    rows = an.q7_survey_of_shortest(w).collect()
    assert len(rows) == 30                      # 3 episodes x 2 tied players x 5 dimensions
    assert all(r.items_respondidos == 2 for r in rows)


def test_q8_and_v1(w):
    q8 = an.q8_distance_speed(w).collect()
    assert len(q8) == 6 and all(r.total_tics == TICKS and r.partidas_jugadas == 1 for r in q8)
    assert len({r.distancia_total_acumulada for r in q8}) == 1
    v1 = an.v_player_trajectory(w).collect()
    assert len(v1) == 6 and all((r.total_tics, r.tic_inicio, r.tic_fin) == (TICKS, 1, TICKS) for r in v1)


def test_table_counts(w):
    rows = {r.tabla: r.filas for r in an.rpt_table_counts(w).collect()}
    assert rows == {"evento_telemetria": 6 * TICKS, "jugador": 6, "usuario": 6, "partida": 3,
                    "sector": 4, "respuesta_ux": 60}


def test_tick_grid_gaps(w):
    te = w.tick_event.filter(~((F.col("id_jugador") == 1) & (F.col("tic") == 5)))
    w2 = seed.build(w.spark, TICKS)
    w2.tick_event = te
    gaps = an.tick_grid_gaps(w2).collect()
    assert [(r.id_partida, r.id_jugador, r.tic) for r in gaps] == [(1, 1, 5)]
