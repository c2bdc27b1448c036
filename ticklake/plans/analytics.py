"""The analytical jobs: Q1-Q8, the two views, the materialized hotspot view,
the table-count report and the expected tick grid.

Plan shape used throughout: reduce the fact first (partial aggregation by
ids), then join the descriptive dimensions to the small aggregate. Joining
names before aggregating would shuffle every fact row with its strings.
Output columns keep the reference's aliases.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions import avg_exact, epoch_minutes, ratio_round, round_to
from ticklake.operators.joins import scalar
from ticklake.operators.pairs import co_presence_bits, pair_proximity
from ticklake.operators.presence import presence_state, sector_presence
from ticklake.operators.ranking import rank_first, rank_within
from ticklake.operators.series import series
from ticklake.operators.trajectory import gap_intervals, path_length
from ticklake.sources.bindings import Warehouse

TICKS_PER_SECOND = 35      # fixed value: tick rate used for speed per second
NEAR_RADIUS = 50           # fixed value: proximity threshold in map units

# Large outputs are sorted with the remaining key columns as tie-breakers: the
# result is deterministic, and a range shuffle can split a run of equal
# leading sort values (one hot session) over several tasks.
PAIR_TIEBREAK = ("id_partida", "jugador_a", "jugador_b")


def _maps_with_episode(w: Warehouse) -> DataFrame:
    return w.map.join(w.episode, "id_episodio")


def _session_place(w: Warehouse) -> DataFrame:
    """Path P: session -> map -> episode."""
    return w.session.select("id_partida", "id_mapa").join(_maps_with_episode(w), "id_mapa")


def _sector_place(w: Warehouse) -> DataFrame:
    """Path S: sector -> map -> episode."""
    return w.sector.join(_maps_with_episode(w), "id_mapa")


def _player_names(w: Warehouse) -> DataFrame:
    return w.player.join(w.volunteer.select("id_usuario", "codigo_anonimo"), "id_usuario")


def _canonical(dim: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """(key, out): every id mapped to the smallest id carrying the same name.

    Grouping by the canonical id is grouping by the name, but on an integer
    key; the name is joined back onto the (much smaller) result.
    """
    canon = dim.groupBy(name).agg(F.min(key).alias(out))
    return dim.select(key, name).join(canon, name).select(key, out)


# ------------------------------------------------------------------ Q1
def q1_session_duration_by_map(w: Warehouse) -> DataFrame:
    p = w.session.filter(F.col("fecha_fin").isNotNull())
    mins = epoch_minutes("fecha_inicio", "fecha_fin")
    g = (p.groupBy("id_mapa")
         .agg(F.count("id_partida").alias("total_partidas"),
              F.avg(mins).alias("avg_m"), F.min(mins).alias("min_m"), F.max(mins).alias("max_m")))
    return (g.join(_maps_with_episode(w), "id_mapa")
            .orderBy("id_episodio", F.desc("avg_m"))
            .select(F.col("nombre_episodio").alias("episodio"),
                    F.col("codigo_mapa").alias("mapa"), "nombre_mapa", "total_partidas",
                    round_to("avg_m", 2).alias("duracion_promedio_min"),
                    round_to("min_m", 2).alias("duracion_minima_min"),
                    round_to("max_m", 2).alias("duracion_maxima_min")))


# ------------------------------------------------------------------ Q2 / Q2b
def near_pairs(w: Warehouse, radius=NEAR_RADIUS, grid: bool = True) -> DataFrame:
    return pair_proximity(w.tick_event, ("id_partida", "tic"), "id_jugador",
                          ("pos_x", "pos_y", "pos_z"), radius=radius, grid=grid)


def q2_pair_proximity(w: Warehouse, radius=NEAR_RADIUS, grid: bool = True) -> DataFrame:
    canon = _canonical(w.player, "id_jugador", "alias", "cj")
    ev = w.tick_event.select("id_partida", "tic", "id_jugador", "pos_x", "pos_y", "pos_z") \
        .join(canon, "id_jugador")
    pairs = pair_proximity(ev, ("id_partida", "tic"), "id_jugador", ("pos_x", "pos_y", "pos_z"),
                           radius=radius, grid=grid, carry=("cj",))
    # Grouped by alias through the canonical ids: equal aliases merge.
    g = (pairs.groupBy("id_partida", "a_cj", "b_cj")
         .agg(F.count(F.lit(1)).alias("tics_dentro_umbral"),
              avg_exact("dist").alias("avg_d"), F.min("dist").alias("min_d")))
    names = w.player.select("id_jugador", "alias")
    na = names.select(F.col("id_jugador").alias("a_cj"), F.col("alias").alias("jugador_a"))
    nb = names.select(F.col("id_jugador").alias("b_cj"), F.col("alias").alias("jugador_b"))
    return (g.join(na, "a_cj").join(nb, "b_cj")
            .select("id_partida", "jugador_a", "jugador_b", "tics_dentro_umbral",
                    round_to("avg_d", 4).alias("distancia_promedio"),
                    round_to("min_d", 4).alias("distancia_minima"))
            .orderBy("distancia_promedio", *PAIR_TIEBREAK))


def q2b_pair_distance_sample(w: Warehouse, radius=NEAR_RADIUS, limit: int | None = None) -> DataFrame:
    """Per-tick distance of near pairs. ``limit`` reproduces the reference's sample."""
    out = near_pairs(w, radius).select(
        "id_partida", F.col("a").alias("jugador_a"), F.col("b").alias("jugador_b"), "tic",
        round_to("dist", 4).alias("distancia_euclidiana"))
    return out.limit(limit) if limit else out


# ------------------------------------------------------------------ Q3a / Q3 / Q8
def session_paths(w: Warehouse) -> DataFrame:
    """Per (player, session): step sum and tick count, one pass over the lag."""
    return path_length(w.tick_event)


def q3a_session_path_length(w: Warehouse) -> DataFrame:
    p = session_paths(w).filter(F.col("steps_sum").isNotNull())
    return (p.select("id_jugador", "id_partida", round_to("steps_sum", 4).alias("distancia_total"))
            .orderBy("distancia_total", "id_jugador", "id_partida"))


def q3_shortest_longest_path(w: Warehouse) -> DataFrame:
    d = (session_paths(w).filter(F.col("steps_sum").isNotNull())
         .select("id_jugador", "id_partida", round_to("steps_sum", 4).alias("distancia_total")))
    # One aggregate per player: extremes, average and the arg-extremes (TOP-1/2),
    # ties going to the smallest session id.
    per_player = d.groupBy("id_jugador").agg(
        F.count_distinct("id_partida").alias("total_partidas"),
        F.min("distancia_total").alias("mn"), F.max("distancia_total").alias("mx"),
        F.avg("distancia_total").alias("av"),
        F.min_by("id_partida", F.struct("distancia_total", "id_partida")).alias("argmin"),
        F.max_by("id_partida", F.struct(F.col("distancia_total"), (-F.col("id_partida")).alias("n")))
        .alias("argmax"))
    return (per_player.join(_player_names(w), "id_jugador")
            .orderBy("av")
            .select(F.col("alias").alias("jugador"), "codigo_anonimo", "total_partidas",
                    round_to("mn", 4).alias("trayectoria_mas_corta"),
                    round_to("mx", 4).alias("trayectoria_mas_larga"),
                    round_to("av", 4).alias("trayectoria_promedio"),
                    F.col("argmin").alias("partida_mas_corta"),
                    F.col("argmax").alias("partida_mas_larga")))


def q8_distance_speed(w: Warehouse, ticks_per_second: int = TICKS_PER_SECOND) -> DataFrame:
    r = session_paths(w).select("id_jugador", "id_partida",
                                round_to("steps_sum", 4).alias("distancia_total"),
                                F.col("n_rows").alias("total_tics_registrados"))
    g = r.groupBy("id_jugador").agg(
        F.sum("distancia_total").alias("dist"),
        F.sum("total_tics_registrados").alias("ticks"),
        F.count_distinct("id_partida").alias("partidas_jugadas"))
    return (g.join(_player_names(w), "id_jugador")
            .orderBy(F.desc_nulls_first("dist"))
            .select(F.col("alias").alias("jugador"), "codigo_anonimo",
                    F.col("dist").cast("decimal(28,4)").alias("distancia_total_acumulada"),
                    F.col("ticks").alias("total_tics"), "partidas_jugadas",
                    ratio_round(F.col("dist"), F.col("ticks"), 6).alias("velocidad_promedio_por_tic"),
                    ratio_round(F.col("dist") * ticks_per_second, F.col("ticks"), 4)
                    .alias("velocidad_promedio_por_segundo")))


# ------------------------------------------------------------------ Q4
def q4_survey_above_avg(w: Warehouse) -> DataFrame:
    per = w.tick_event.groupBy("id_jugador", "id_partida").agg(F.count("tic").alias("total_tics"))
    avg_tics = per.agg(avg_exact("total_tics").alias("avg_tics"))
    above = per.filter(F.col("total_tics") > scalar(avg_tics, "avg_tics"))
    ans = w.survey_response.select("id_usuario", "id_partida", "id_item", "valor_respuesta")
    j = (above.join(w.player, "id_jugador")
         .join(w.volunteer.select("id_usuario", "codigo_anonimo"), "id_usuario")
         .join(ans, ["id_usuario", "id_partida"])
         .join(w.survey_item, "id_item"))
    return (j.orderBy(F.desc("total_tics"), "id_item", "id_jugador", "id_partida")
            .select(F.col("alias").alias("jugador"),
                    F.col("codigo_anonimo").alias("usuario_anonimo"),
                    F.col("total_tics").alias("tics_jugados"),
                    round_to(scalar(avg_tics, "avg_tics"), 2).alias("promedio_global_tics"),
                    F.col("texto_pregunta").alias("pregunta_ux"),
                    F.col("dimension").alias("dimension_bangs"),
                    F.col("valor_respuesta").alias("puntuacion")))


# ------------------------------------------------------------------ Q5 / MV
def q5_sector_hotspots(w: Warehouse) -> DataFrame:
    g = w.tick_event.groupBy("id_sector").agg(
        F.count("id_evento").alias("total_presencias"),
        F.count_distinct("id_jugador").alias("jugadores_distintos"))
    return (g.join(_sector_place(w), "id_sector")
            .orderBy("id_episodio", "id_mapa", F.desc("total_presencias"))
            .select(F.col("nombre_episodio").alias("episodio"), F.col("codigo_mapa").alias("mapa"),
                    "nombre_mapa", F.col("codigo_sector").alias("sector"),
                    F.col("coordenada_x").alias("coord_x"), F.col("coordenada_y").alias("coord_y"),
                    "total_presencias", "jugadores_distintos",
                    ratio_round("total_presencias", "jugadores_distintos", 2)
                    .alias("presencias_por_jugador")))


def hotspots_of_state(state: DataFrame, sector: DataFrame, map_: DataFrame, episode: DataFrame) -> DataFrame:
    """The hotspot view from presence state: per sector counts, vitals and rank in its map."""
    place = sector.join(map_.join(episode, "id_episodio"), "id_mapa")
    g = rank_within(sector_presence(state).join(place, "id_sector"), ["id_mapa"], [F.desc("total_eventos")], "rank_en_mapa")
    return g.select("id_episodio", "nombre_episodio", "id_mapa", "codigo_mapa", "nombre_mapa",
                    "id_sector", "codigo_sector", "coordenada_x", "coordenada_y",
                    "total_eventos", "jugadores_unicos", "partidas_con_presencia",
                    round_to("avg_salud", 2).alias("salud_promedio_en_sector"),
                    round_to("avg_municion", 2).alias("municion_promedio_en_sector"),
                    ratio_round("total_eventos", "jugadores_unicos", 2).alias("eventos_por_jugador"),
                    F.col("rank_en_mapa").cast("long").alias("rank_en_mapa"))


def hotspots(fact: DataFrame, sector: DataFrame, map_: DataFrame, episode: DataFrame) -> DataFrame:
    """The hotspot view over any fact."""
    return hotspots_of_state(presence_state(fact), sector, map_, episode)


def mv_sector_hotspots(w: Warehouse) -> DataFrame:
    return hotspots(w.tick_event, w.sector, w.map, w.episode)


def refresh_hotspots(stored: DataFrame, fact: DataFrame, new_rows: DataFrame, sector: DataFrame,
                     map_: DataFrame, episode: DataFrame) -> DataFrame:
    """Refresh of a stored view that has no presence state (``plans.hotspot_view`` keeps one):
    the maps whose sectors received rows are made anew from the fact of their
    sectors; every other stored row is kept."""
    touched = (new_rows.select("id_sector").distinct()
               .join(sector.select("id_sector", "id_mapa"), "id_sector").select("id_mapa").distinct())
    sectors = sector.join(touched, "id_mapa", "left_semi")
    fresh = hotspots(fact.join(sectors.select("id_sector"), "id_sector", "left_semi"),
                     sectors, map_, episode)
    return stored.join(touched, "id_mapa", "left_anti").select(*stored.columns).unionByName(fresh)


# ------------------------------------------------------------------ Q6 / V2
def q6_copresence_pct(w: Warehouse) -> DataFrame:
    # Grouped by codes and aliases through canonical ids (integer keys). A code
    # or alias may stand for several ids, whose shared ticks are then united:
    # bits are OR-ed per bucket before they are counted.
    cs = _canonical(w.sector, "id_sector", "codigo_sector", "cs")
    cp = _canonical(w.player, "id_jugador", "alias", "cj")
    pairs = co_presence_bits(w.tick_event)
    ca, cb = cp.toDF("a", "a_cj"), cp.toDF("b", "b_cj")
    named = pairs.join(cs, "id_sector").join(ca, "a").join(cb, "b")
    united = (named.groupBy("id_partida", "cs", "a_cj", "b_cj", "bucket")
              .agg(F.bit_count(F.bit_or("shared")).alias("n")))
    g = united.groupBy("id_partida", "cs", "a_cj", "b_cj").agg(F.sum("n").alias("tics_compartidos"))
    session_ticks = w.tick_event.groupBy("id_partida").agg(
        F.count_distinct("tic").alias("ticks_partida"))
    place = _session_place(w).select("id_partida", F.col("nombre_episodio").alias("episodio"),
                                     F.col("codigo_mapa").alias("mapa"))
    sec = w.sector.select(F.col("id_sector").alias("cs"), F.col("codigo_sector").alias("sector"))
    names = w.player.select("id_jugador", "alias")
    na = names.select(F.col("id_jugador").alias("a_cj"), F.col("alias").alias("jugador_a"))
    nb = names.select(F.col("id_jugador").alias("b_cj"), F.col("alias").alias("jugador_b"))
    return (g.join(place, "id_partida").join(session_ticks, "id_partida", "left")
            .join(sec, "cs").join(na, "a_cj").join(nb, "b_cj")
            .orderBy("id_partida", F.desc("tics_compartidos"), "cs", "a_cj", "b_cj")
            .select("id_partida", "episodio", "mapa", "sector", "jugador_a", "jugador_b",
                    "tics_compartidos",
                    ratio_round(F.col("tics_compartidos") * 100, "ticks_partida", 2)
                    .alias("pct_partida_juntos")))


def v_sector_copresence(w: Warehouse) -> DataFrame:
    # Buckets hold different ticks: the distinct shared ticks are a sum of bit counts.
    g = (co_presence_bits(w.tick_event).groupBy("id_partida", "id_sector", "a", "b")
         .agg(F.sum(F.bit_count("shared")).alias("tics_compartidos"))
         .filter(F.col("tics_compartidos") > 0))
    pa = w.player.select(F.col("id_jugador").alias("a"), F.col("alias").alias("alias_a"))
    pb = w.player.select(F.col("id_jugador").alias("b"), F.col("alias").alias("alias_b"))
    place = _session_place(w).select("id_partida", "nombre_episodio", "codigo_mapa")
    return (g.join(w.sector.select("id_sector", "codigo_sector"), "id_sector")
            .join(place, "id_partida").join(pa, "a").join(pb, "b")
            .orderBy(F.desc("tics_compartidos"), "id_partida", "id_sector", "a", "b")
            .select("id_partida", "id_sector", "codigo_sector", "nombre_episodio", "codigo_mapa",
                    F.col("a").alias("jugador_a"), "alias_a", F.col("b").alias("jugador_b"),
                    "alias_b", "tics_compartidos"))


# ------------------------------------------------------------------ Q7
def q7_survey_of_shortest(w: Warehouse) -> DataFrame:
    per_session = w.tick_event.groupBy("id_jugador", "id_partida").agg(F.count("tic").alias("n"))
    per_episode = (per_session.join(_session_place(w), "id_partida")
                   .groupBy("id_jugador", "id_episodio", "nombre_episodio")
                   .agg(F.sum("n").alias("total_tics")))
    shortest = rank_first(per_episode, ["id_episodio"], "total_tics", ascending=True)
    ans = w.survey_response.select("id_usuario", "id_respuesta", "id_item", "valor_respuesta")
    j = (shortest.join(w.player, "id_jugador")
         .join(w.volunteer.select("id_usuario", "codigo_anonimo"), "id_usuario")
         .join(ans, "id_usuario").join(w.survey_item.select("id_item", "dimension"), "id_item"))
    g = j.groupBy("nombre_episodio", "alias", "codigo_anonimo", "total_tics", "dimension").agg(
        avg_exact("valor_respuesta").alias("avg_v"), F.count("id_respuesta").alias("items_respondidos"))
    return (g.orderBy("nombre_episodio", "dimension")
            .select(F.col("nombre_episodio").alias("episodio"), F.col("alias").alias("jugador"),
                    F.col("codigo_anonimo").alias("usuario_anonimo"),
                    F.col("total_tics").alias("tics_trayectoria_corta"),
                    F.col("dimension").alias("dimension_bangs"),
                    round_to("avg_v", 2).alias("score_ux_promedio"), "items_respondidos"))


# ------------------------------------------------------------------ V1
def v_player_trajectory(w: Warehouse) -> DataFrame:
    g = w.tick_event.groupBy("id_partida", "id_jugador").agg(
        F.count("tic").alias("total_tics"),
        avg_exact("pos_x").alias("ax"), avg_exact("pos_y").alias("ay"),
        (F.max("pos_x") - F.min("pos_x")).alias("rx"), (F.max("pos_y") - F.min("pos_y")).alias("ry"),
        avg_exact("salud").alias("asal"), avg_exact("municion").alias("amun"),
        F.min("tic").alias("tic_inicio"), F.max("tic").alias("tic_fin"))
    place = _session_place(w).select("id_partida", "nombre_episodio", "codigo_mapa")
    return (g.join(_player_names(w), "id_jugador").join(place, "id_partida")
            .select("id_partida", "id_jugador", "alias", "codigo_anonimo", "nombre_episodio",
                    "codigo_mapa", "total_tics",
                    round_to("ax", 4).alias("pos_x_promedio"), round_to("ay", 4).alias("pos_y_promedio"),
                    round_to("rx", 4).alias("rango_x"), round_to("ry", 4).alias("rango_y"),
                    round_to("asal", 2).alias("salud_promedio"),
                    round_to("amun", 2).alias("municion_promedio"), "tic_inicio", "tic_fin"))


# ------------------------------------------------------------------ RPT / GRID
def rpt_table_counts(w: Warehouse, reject_log: DataFrame | None = None) -> DataFrame:
    parts = [("evento_telemetria", w.tick_event), ("jugador", w.player), ("usuario", w.volunteer),
             ("partida", w.session), ("sector", w.sector), ("respuesta_ux", w.survey_response)]
    if reject_log is not None:
        parts.append(("log_errores_carga", reject_log))
    frames = [df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
              for name, df in parts]
    return reduce(DataFrame.unionByName, frames).orderBy("tabla")


def tick_grid_gaps(w: Warehouse) -> DataFrame:
    """Ticks missing between a participation's first and last tick: only the gaps are expanded."""
    keys = ["id_partida", "id_jugador"]
    return series(gap_intervals(w.tick_event, keys), keys, "lo", "hi", "tic")
