"""One runnable query per inventory primitive.

Each takes the bound ``Warehouse`` and exercises one operator on the whole
bound tables. Keys that write (``src_*``/``snk_*``) write under the shared
checkpoint folder and return what they read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.functions import (
    DEC, INT, UINT, blank, dist3, epoch_minutes, matches, raw_line, ratio_round, rint_int,
    round_to, typed_or_null,
)
from ticklake.functions.numeric import avg_exact
from ticklake.operators import audit as AU
from ticklake.operators import classify as C
from ticklake.operators.joins import existence_flag, scalar, star_chain, with_scalar
from ticklake.operators.pairs import co_presence
from ticklake.operators.ranking import arg_extreme, first_per_key, rank_distributed, rank_first, rank_within
from ticklake.operators.series import series
from ticklake.operators.trajectory import lag_columns, path_length, step_distances
from ticklake.plans import analytics as an
from ticklake.plans import ingest as ing
from ticklake.plans.hotspot_view import HotspotView
from ticklake.session import scratch_path
from ticklake.sinks import tables as SK
from ticklake.sources.bindings import Warehouse
from ticklake.sources.tsv import read_staging, write_tsv

P = {}


def prim(name):
    def deco(fn):
        P[name] = fn
        return fn
    return deco


def typed_staging(w: Warehouse) -> DataFrame:
    return C.type_flags(w.staging)


def _uid(w: Warehouse, name: str) -> str:
    import uuid
    return scratch_path(w.spark, f"prim/{name}/{uuid.uuid4().hex}")


# ------------------------------------------------------------------ §2.1 sources and sinks
@prim("src_tsv_staging")
def src_tsv_staging(w):
    path = _uid(w, "tsv")
    write_tsv(w.staging, path)
    return read_staging(w.spark, path).select(*S.RAW_FIELDS)


@prim("src_scan")
def src_scan(w):
    return w.tick_event


@prim("src_insert_if_absent")
def src_insert_if_absent(w):
    """``INSERT ... ON CONFLICT (id) DO NOTHING`` of the players a batch references:
    the stored player table gets only the unknown ids, then it is read back."""
    path = _uid(w, "players")
    SK.reload(w.player, path)
    seen = typed_staging(w).filter(F.col("id_jugador").isNotNull()).select(
        "id_jugador", F.concat(F.lit("desconocido_"), F.col("id_jugador").cast("string")).alias("alias"),
        F.col("id_jugador").alias("id_usuario"))
    target = w.spark.read.parquet(path)
    SK.insert_if_absent(seen, target, ["id_jugador"]).write.mode("append").parquet(path)
    return w.spark.read.parquet(path)


@prim("src_series")
def src_series(w):
    """Every tick between each session's first and last tick."""
    span = w.tick_event.groupBy("id_partida").agg(F.min("tic").alias("lo"), F.max("tic").alias("hi"))
    return series(span, ["id_partida"], "lo", "hi", "tic")


@prim("snk_reject_log")
def snk_reject_log(w):
    path = _uid(w, "log")
    log = ing.numbered_log(w).withColumn("id_lote", F.lit("b1"))
    SK.write_batch(log, path, "b1")
    SK.write_batch(log, path, "b1")   # re-run: same rows
    return SK.read_or_empty(w.spark, path, S.REJECT_LOG).select(*ing.LOG_COLUMNS)


@prim("snk_insert_no_conflict")
def snk_insert_no_conflict(w):
    root = _uid(w, "load")
    job = ing.IngestJob(w.spark, ing.IngestPaths(fact=f"{root}/fact", log=f"{root}/log"),
                        w.player, w.volunteer, w.session, w.sector, seed_fact=w.preloaded_fact)
    job.run(w.staging, "b1")
    job.run(w.staging, "b1")            # idempotent re-run of the same batch
    return w.spark.read.parquet(f"{root}/fact").select(*C.ACCEPTED_COLUMNS)


@prim("snk_reload")
def snk_reload(w):
    """Stored sectors are loaded anew; the stored facts, which refer to them, are emptied."""
    root = _uid(w, "reload")
    SK.reload(w.sector, f"{root}/sector")
    SK.reload(w.tick_event, f"{root}/tick_event")
    SK.reload_cascade(w.sector, root, "sector", S.KEYS)
    return w.spark.read.parquet(f"{root}/sector")


@prim("snk_view")
def snk_view(w):
    SK.register_view(an.v_player_trajectory(w), "v_trayectoria_por_jugador")
    return w.spark.sql("SELECT * FROM v_trayectoria_por_jugador")


@prim("snk_materialize_refresh")
def snk_materialize_refresh(w):
    """Materialize the hotspot view on the pre-loaded fact, load the batch, then
    refresh it in place from the batch and the stored presence state."""
    view = HotspotView(w.spark, _uid(w, "mv"), w.sector, w.map, w.episode)
    view.load(w.preloaded_fact, "preloaded")
    return view.load(C.accepted(ing.classified(w)), "b1")


@prim("snk_clustered_layout")
def snk_clustered_layout(w):
    """By session, player and tick."""
    return _layout(w, "id_partida", "id_jugador", "tic")


@prim("snk_layout_sector")
def snk_layout_sector(w):
    """By sector; the event id spreads a sector with many rows over files."""
    return _layout(w, "id_sector", "id_evento")


@prim("snk_layout_position")
def snk_layout_position(w):
    """By place on the map: both coordinates at once."""
    return SK.plane_layout(w.tick_event, _uid(w, "layout"), "pos_x", "pos_y", "id_evento")


@prim("snk_layout_player")
def snk_layout_player(w):
    """By player and session."""
    return _layout(w, "id_jugador", "id_partida", "tic")


def _layout(w, *keys):
    return SK.clustered_layout(w.tick_event, _uid(w, "layout"), cluster_by=keys, sort_by=keys)


# ------------------------------------------------------------------ §2.2 projections
@prim("prj_select_alias")
def prj_select_alias(w):
    return w.session.select(F.col("id_partida").alias("partida"), F.col("id_mapa").alias("mapa"),
                            F.col("fecha_inicio").alias("inicio"), F.col("fecha_fin").alias("fin"))


@prim("prj_star")
def prj_star(w):
    return w.session.withColumn("duracion_min", round_to(epoch_minutes("fecha_inicio", "fecha_fin"), 2))


@prim("prj_literal")
def prj_literal(w):
    return w.tick_event.select("id_evento", F.lit(1).alias("id_sector_defecto"),
                               F.lit("evento_telemetria").alias("tabla"))


@prim("prj_typed_cast")
def prj_typed_cast(w):
    return w.staging.select(
        *[typed_or_null(f, t).alias(n) for f, _, t, n in C.MANDATORY + C.OPTIONAL])


@prim("prj_raw_line")
def prj_raw_line(w):
    return w.staging.select(raw_line(S.RAW_FIELDS).alias("linea_raw"))


# ------------------------------------------------------------------ §2.3 filters
@prim("flt_blank")
def flt_blank(w):
    return w.staging.filter(blank("raw_id_partida") | blank("raw_id_jugador") | blank("raw_tic")) \
        .select("raw_id_partida", "raw_id_jugador", "raw_tic")


@prim("flt_regex")
def flt_regex(w):
    return w.staging.filter(matches("raw_id_jugador", UINT) & matches("raw_tic", INT)
                            & matches("raw_pos_x", DEC)) \
        .select("raw_id_jugador", "raw_tic", "raw_pos_x")


@prim("flt_not_regex")
def flt_not_regex(w):
    return typed_staging(w).filter(F.col("_bad")).select("linea_raw")


@prim("flt_optional_regex")
def flt_optional_regex(w):
    ok = reduce(lambda a, b: a & b, [blank(f) | matches(f, p) for f, p, _, _ in C.OPTIONAL])
    return w.staging.filter(ok).select(raw_line(S.RAW_FIELDS).alias("linea_raw"))


@prim("flt_range")
def flt_range(w):
    return w.staging.filter(matches("raw_tic", INT) & (F.col("raw_tic").try_cast("int") < 0)) \
        .select("raw_tic", raw_line(S.RAW_FIELDS).alias("linea_raw"))


@prim("flt_boolean")
def flt_boolean(w):
    return w.volunteer.filter(~F.col("consentimiento")).select("id_usuario", "codigo_anonimo")


@prim("flt_not_null")
def flt_not_null(w):
    return w.session.filter(F.col("fecha_fin").isNotNull()).select("id_partida", "fecha_fin")


@prim("flt_distance")
def flt_distance(w):
    """Pairs of players within the radius at one instant, on the spatial grid."""
    return an.near_pairs(w).select(
        "id_partida", F.col("a").alias("jugador_a"), F.col("b").alias("jugador_b"), "tic",
        round_to("dist", 4).alias("distancia_euclidiana"))


@prim("flt_rank")
def flt_rank(w):
    per = (w.tick_event.groupBy("id_jugador", "id_partida").agg(F.count("tic").alias("n"))
           .join(an._session_place(w), "id_partida")
           .groupBy("id_jugador", "id_episodio").agg(F.sum("n").alias("total_tics")))
    return rank_first(per, ["id_episodio"], "total_tics").select("id_episodio", "id_jugador", "total_tics")


@prim("flt_having")
def flt_having(w):
    return (w.tick_event.groupBy("id_partida", "id_jugador").agg(F.count("tic").alias("total_tics"))
            .filter(F.col("total_tics") > 1))


@prim("flt_negated_disjunction")
def flt_negated_disjunction(w):
    return w.staging.filter(~(blank("raw_id_partida") | blank("raw_id_jugador") | blank("raw_tic"))) \
        .select(raw_line(S.RAW_FIELDS).alias("linea_raw"))


@prim("flt_correlated_equality")
def flt_correlated_equality(w):
    per_session = w.tick_event.groupBy("id_partida").agg(F.count("tic").alias("tics_partida"))
    return w.tick_event.select("id_partida", "id_jugador", "tic").join(per_session, "id_partida")


# ------------------------------------------------------------------ §2.4 joins
@prim("join_star_chain")
def join_star_chain(w):
    j = star_chain(w.tick_event.select("id_evento", "id_sector"),
                   (w.sector.select("id_sector", "id_mapa", "codigo_sector"), "id_sector"),
                   (w.map.select("id_mapa", "id_episodio", "codigo_mapa"), "id_mapa"),
                   (w.episode, "id_episodio"))
    return j.select("id_evento", "codigo_sector", "codigo_mapa", "nombre_episodio")


@prim("join_composite_key")
def join_composite_key(w):
    per = w.tick_event.groupBy("id_jugador", "id_partida").agg(F.count("tic").alias("total_tics"))
    ans = w.survey_response.select("id_respuesta", "id_usuario", "id_partida", "valor_respuesta")
    return per.withColumnRenamed("id_jugador", "id_usuario").join(ans, ["id_usuario", "id_partida"])


@prim("join_self_pairs")
def join_self_pairs(w):
    """Unordered pairs of players at one tick of a session (a bounded room), counted per tick."""
    pairs = co_presence(w.tick_event, ("id_partida",), "tic", unique=True)
    return pairs.groupBy("id_partida", "tic").agg(F.count(F.lit(1)).alias("pares"))


@prim("join_self_pairs_sector")
def join_self_pairs_sector(w):
    """The same within one sector."""
    pairs = co_presence(w.tick_event, ("id_partida", "tic"), "id_sector", unique=True)
    return pairs.groupBy("id_partida", "tic", "id_sector").agg(F.count(F.lit(1)).alias("pares"))


@prim("join_left_outer_filtered")
def join_left_outer_filtered(w):
    steps = step_distances(w.tick_event).filter(F.col("dist_al_anterior").isNotNull())
    return (w.tick_event.select("id_jugador", "id_partida", "tic")
            .join(steps, ["id_jugador", "id_partida", "tic"], "left")
            .select("id_jugador", "id_partida", "tic",
                    round_to("dist_al_anterior", 4).alias("dist_al_anterior")))


def _ticks_per_player_session(w):
    return w.tick_event.groupBy("id_jugador", "id_partida").agg(F.count("tic").alias("total_tics"))


@prim("join_cross_scalar")
def join_cross_scalar(w):
    per = _ticks_per_player_session(w)
    avg = per.agg(avg_exact("total_tics").alias("avg_tics"))
    return with_scalar(per, avg, "avg_tics").withColumn("avg_tics", round_to("avg_tics", 2))


@prim("join_theta_scalar")
def join_theta_scalar(w):
    per = _ticks_per_player_session(w)
    avg = per.agg(avg_exact("total_tics").alias("avg_tics"))
    return per.filter(F.col("total_tics") > scalar(avg, "avg_tics"))


@prim("join_cross_series")
def join_cross_series(w):
    """Every tick between a participation's first and last."""
    span = w.tick_event.groupBy("id_partida", "id_jugador").agg(F.min("tic").alias("lo"), F.max("tic").alias("hi"))
    return series(span, ["id_partida", "id_jugador"], "lo", "hi", "tic")


@prim("join_cross_product")
def join_cross_product(w):
    """Every volunteer x every item of the instrument: an equi-join on the
    instrument id; its items bound the rows of a volunteer."""
    items = w.survey_item.select("id_instrumento", "id_item")
    return (w.volunteer.select("id_usuario", F.lit(1).alias("id_instrumento"))
            .join(items, "id_instrumento").select("id_usuario", "id_item"))


@prim("join_semi")
def join_semi(w):
    players = w.tick_event.select(F.col("id_jugador").alias("id_usuario"))
    return w.survey_response.join(players, "id_usuario", "left_semi").select("id_respuesta", "id_usuario")


@prim("join_anti")
def join_anti(w):
    return typed_staging(w).join(w.player.select("id_jugador"), "id_jugador", "left_anti") \
        .select("linea_raw")


def _staging_maps(w):
    d = typed_staging(w)
    ses = w.session.select("id_partida", F.col("id_mapa").alias("mapa_partida"))
    sec = w.sector.select("id_sector", F.col("id_mapa").alias("mapa_sector"))
    return d.join(ses, "id_partida", "left").join(sec, "id_sector", "left")


@prim("join_anti_composite")
def join_anti_composite(w):
    d = _staging_maps(w).filter(matches("raw_id_sector", UINT))
    in_map = F.coalesce(F.col("mapa_partida") == F.col("mapa_sector"), F.lit(False))
    return d.filter(~in_map).select("linea_raw")


@prim("join_existence_or")
def join_existence_or(w):
    d = _staging_maps(w)
    in_map = F.coalesce(F.col("mapa_partida") == F.col("mapa_sector"), F.lit(False))
    return d.filter(blank("raw_id_sector") | in_map).select("linea_raw")


@prim("join_semi_core")
def join_semi_core(w):
    return typed_staging(w).join(w.preloaded_fact.select(*C.FACT_KEY), list(C.FACT_KEY), "left_semi") \
        .select("linea_raw")


@prim("join_cast_key")
def join_cast_key(w):
    return typed_staging(w).join(w.player.select("id_jugador", "alias"), "id_jugador") \
        .select("linea_raw", "alias")


# ------------------------------------------------------------------ §2.5 aggregations
@prim("agg_count_star")
def agg_count_star(w):
    return w.tick_event.groupBy("id_partida").agg(F.count(F.lit(1)).alias("filas"))


@prim("agg_count_col")
def agg_count_col(w):
    return w.tick_event.groupBy("id_partida").agg(F.count("id_sector").alias("con_sector"))


@prim("agg_count_distinct")
def agg_count_distinct(w):
    return w.tick_event.groupBy("id_partida").agg(F.count_distinct("id_jugador").alias("jugadores"))


@prim("agg_multi_distinct")
def agg_multi_distinct(w):
    g = w.tick_event.join(w.sector.select("id_sector", "id_mapa"), "id_sector").groupBy("id_mapa").agg(
        F.count_distinct("id_jugador").alias("jugadores_unicos"),
        F.count_distinct("id_partida").alias("partidas_con_presencia"),
        avg_exact("salud").alias("s"))
    return g.select("id_mapa", "jugadores_unicos", "partidas_con_presencia",
                    round_to("s", 2).alias("salud_promedio"))


@prim("agg_sum")
def agg_sum(w):
    return w.tick_event.groupBy("id_jugador").agg(F.sum("municion").alias("municion_total"))


@prim("agg_avg")
def agg_avg(w):
    g = w.tick_event.groupBy("id_partida").agg(avg_exact("salud").alias("s"), avg_exact("pos_x").alias("x"))
    return g.select("id_partida", round_to("s", 2).alias("salud_promedio"),
                    round_to("x", 4).alias("pos_x_promedio"))


@prim("agg_min_max")
def agg_min_max(w):
    return w.tick_event.groupBy("id_partida").agg(
        F.min("pos_x").alias("pos_x_min"), F.max("pos_x").alias("pos_x_max"),
        F.min("tic").alias("tic_min"), F.max("tic").alias("tic_max"))


@prim("agg_spread")
def agg_spread(w):
    return w.tick_event.groupBy("id_partida").agg(
        round_to(F.max("pos_x") - F.min("pos_x"), 4).alias("rango_x"))


@prim("agg_ratio")
def agg_ratio(w):
    g = w.tick_event.groupBy("id_sector").agg(F.count("id_evento").alias("n"),
                                              F.count_distinct("id_jugador").alias("d"))
    return g.select("id_sector", ratio_round("n", "d", 2).alias("presencias_por_jugador"))


@prim("agg_percent_of_group")
def agg_percent_of_group(w):
    te = w.tick_event
    part = te.filter(F.col("id_sector").isNotNull()).groupBy("id_partida", "id_sector") \
        .agg(F.count_distinct("tic").alias("tics_sector"))
    total = te.groupBy("id_partida").agg(F.count_distinct("tic").alias("tics_partida"))
    return part.join(total, "id_partida").select(
        "id_partida", "id_sector", ratio_round(F.col("tics_sector") * 100, "tics_partida", 2).alias("pct"))


@prim("agg_of_agg")
def agg_of_agg(w):
    per = _ticks_per_player_session(w)
    return per.groupBy("id_partida").agg(round_to(avg_exact("total_tics"), 2).alias("tics_promedio"))


@prim("agg_global")
def agg_global(w):
    per = _ticks_per_player_session(w)
    return per.agg(F.count(F.lit(1)).alias("sesiones_jugador"),
                   round_to(avg_exact("total_tics"), 2).alias("tics_promedio"))


@prim("agg_wide_key")
def agg_wide_key(w):
    per_session = w.tick_event.groupBy("id_partida").agg(F.count("id_evento").alias("n"))
    g = per_session.join(an._session_place(w), "id_partida").groupBy(
        "id_episodio", "nombre_episodio", "id_mapa", "codigo_mapa", "nombre_mapa").agg(
        F.sum("n").alias("eventos"))
    return g


@prim("agg_rate_scaled")
def agg_rate_scaled(w):
    p = path_length(w.tick_event).groupBy("id_jugador").agg(
        F.sum("steps_sum").alias("d"), F.sum("n_rows").alias("n"))
    return p.select("id_jugador", ratio_round(F.col("d") * an.TICKS_PER_SECOND, F.col("n"), 4)
                    .alias("velocidad_por_segundo"))


# ------------------------------------------------------------------ §2.6 windows
@prim("win_lag")
def win_lag(w):
    d = lag_columns(w.tick_event.select("id_jugador", "id_partida", "tic", "pos_x", "pos_y", "pos_z"),
                    ["id_jugador", "id_partida"], "tic", ["pos_x", "pos_y", "pos_z"])
    return d.select("id_jugador", "id_partida", "tic", "prev_pos_x", "prev_pos_y", "prev_pos_z")


@prim("win_rank")
def win_rank(w):
    per = (w.tick_event.groupBy("id_jugador", "id_partida").agg(F.count("tic").alias("n"))
           .join(an._session_place(w), "id_partida")
           .groupBy("id_jugador", "id_episodio").agg(F.sum("n").alias("total_tics")))
    return rank_distributed(per, ["id_episodio"], "total_tics", "rk") \
        .withColumn("rk", F.col("rk").cast("long"))


@prim("win_rank_over_agg")
def win_rank_over_agg(w):
    g = w.tick_event.join(w.sector.select("id_sector", "id_mapa"), "id_sector") \
        .groupBy("id_mapa", "id_sector").agg(F.count("id_evento").alias("total_eventos"))
    return rank_within(g, ["id_mapa"], [F.desc("total_eventos")], "rank_en_mapa") \
        .withColumn("rank_en_mapa", F.col("rank_en_mapa").cast("long"))


def _keyed_staging(w):
    return (typed_staging(w)
            .filter(F.col("id_partida").isNotNull() & F.col("id_jugador").isNotNull()
                    & F.col("tic").isNotNull())
            .select(*C.FACT_KEY, "cargado_en", "archivo_origen", "linea_raw", "_row_id"))


@prim("win_row_number_dedup")
def win_row_number_dedup(w):
    """Rows with row number > 1 per typed key in load order: all but the first copy."""
    d = _keyed_staging(w)
    order = F.struct("cargado_en", "archivo_origen", "linea_raw", "_row_id")
    first = d.groupBy(*C.FACT_KEY).agg(F.min(order).alias("_first"))
    return d.join(first, list(C.FACT_KEY)).filter(order != F.col("_first")) \
        .select(*C.FACT_KEY, "linea_raw")


@prim("win_named")
def win_named(w):
    return step_distances(w.tick_event).select(
        "id_jugador", "id_partida", "tic", round_to("dist_al_anterior", 4).alias("dist_al_anterior"))


# ------------------------------------------------------------------ §2.7 sort, limit, top-k
@prim("sort_multi_key")
def sort_multi_key(w):
    return w.session.orderBy("id_mapa", F.desc("fecha_inicio")).select("id_partida", "id_mapa", "fecha_inicio")


@prim("sort_by_aggregate")
def sort_by_aggregate(w):
    return w.tick_event.groupBy("id_jugador").agg(F.count(F.lit(1)).alias("eventos")) \
        .orderBy(F.desc("eventos"), "id_jugador")


@prim("sort_non_projected")
def sort_non_projected(w):
    return w.survey_item.orderBy("id_item").select("texto_pregunta", "dimension")


@prim("limit_sample")
def limit_sample(w):
    """The reference's 100-row sample of near pairs, made deterministic by a total order."""
    return an.q2b_pair_distance_sample(w).orderBy("id_partida", "tic", "jugador_a", "jugador_b").limit(100)


def _session_distances(w):
    return (path_length(w.tick_event).filter(F.col("steps_sum").isNotNull())
            .select("id_jugador", "id_partida", round_to("steps_sum", 4).alias("distancia_total")))


@prim("argmin_per_group")
def argmin_per_group(w):
    return arg_extreme(_session_distances(w), ["id_jugador"], "distancia_total", "id_partida") \
        .select("id_jugador", F.col("argmin").alias("partida_mas_corta"))


@prim("argmax_per_group")
def argmax_per_group(w):
    return arg_extreme(_session_distances(w), ["id_jugador"], "distancia_total", "id_partida") \
        .select("id_jugador", F.col("argmax").alias("partida_mas_larga"))


@prim("distinct_on_first")
def distinct_on_first(w):
    d = _keyed_staging(w)
    return first_per_key(d, list(C.FACT_KEY), ["cargado_en", "archivo_origen", "linea_raw", "_row_id"]) \
        .select(*C.FACT_KEY, "linea_raw")


# ------------------------------------------------------------------ §2.8 sets, subqueries, CTEs
@prim("union_all_counts")
def union_all_counts(w):
    parts = [("evento_telemetria", w.tick_event), ("jugador", w.player), ("usuario", w.volunteer),
             ("partida", w.session), ("respuesta_ux", w.survey_response)]
    frames = [df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(n).alias("tabla"), "filas")
              for n, df in parts]
    return reduce(DataFrame.unionByName, frames)


@prim("subq_scalar_correlated_agg")
def subq_scalar_correlated_agg(w):
    te = w.tick_event
    part = te.filter(F.col("id_sector").isNotNull()).groupBy("id_partida", "id_sector") \
        .agg(F.count_distinct("tic").alias("tics_sector"))
    total = te.groupBy("id_partida").agg(F.count_distinct("tic").alias("tics_partida"))
    return part.join(total, "id_partida", "left")


@prim("subq_scalar_correlated_topk")
def subq_scalar_correlated_topk(w):
    return arg_extreme(_session_distances(w), ["id_jugador"], "distancia_total", "id_partida") \
        .select("id_jugador", F.col("argmin").alias("partida_mas_corta"),
                F.col("argmax").alias("partida_mas_larga"))


@prim("subq_exists")
def subq_exists(w):
    d = typed_staging(w)
    d = existence_flag(d, w.player, ["id_jugador"], ["id_jugador"], "existe_jugador")
    d = existence_flag(d, w.session, ["id_partida"], ["id_partida"], "existe_partida")
    return d.select("linea_raw", "existe_jugador", "existe_partida")


@prim("cte_chain")
def cte_chain(w):
    per = _ticks_per_player_session(w)
    avg = per.agg(avg_exact("total_tics").alias("avg_tics"))
    above = per.filter(F.col("total_tics") > scalar(avg, "avg_tics"))
    return above.withColumn("promedio_global", round_to(scalar(avg, "avg_tics"), 2))


@prim("cte_insert")
def cte_insert(w):
    path = _uid(w, "cte_insert")
    SK.write_batch(C.reject_log(ing.classified(w), batch_id="b1")
                   .filter(F.col("motivo") == C.DUP_BATCH), path, "b1")
    return SK.read_or_empty(w.spark, path, S.REJECT_LOG).select(*ing.LOG_COLUMNS)


# ------------------------------------------------------------------ §2.9 scalar functions
@prim("fn_trim")
def fn_trim(w):
    return w.staging.select("raw_id_partida", F.trim("raw_id_partida").alias("recortado"))


@prim("fn_nullif")
def fn_nullif(w):
    return w.staging.select("raw_salud", F.nullif(F.trim("raw_salud"), F.lit("")).alias("salud_o_nulo"))


@prim("fn_concat_ws")
def fn_concat_ws(w):
    return w.staging.select(F.concat_ws("\t", "raw_id_partida", "raw_id_jugador", "raw_tic").alias("clave"))


@prim("fn_regex")
def fn_regex(w):
    return w.staging.select("raw_id_partida", matches("raw_id_partida", UINT).alias("es_entero"),
                            "raw_pos_x", matches("raw_pos_x", DEC).alias("es_decimal"))


@prim("fn_cast_int")
def fn_cast_int(w):
    return w.staging.select("raw_tic", F.when(matches("raw_tic", INT), F.col("raw_tic").try_cast("int"))
                            .alias("tic"))


@prim("fn_cast_decimal")
def fn_cast_decimal(w):
    return w.staging.select("raw_pos_x", F.when(matches("raw_pos_x", DEC),
                                                F.col("raw_pos_x").try_cast(S.POS)).alias("pos_x"))


@prim("fn_cast_float_int")
def fn_cast_float_int(w):
    return w.events.select("event_id", rint_int("value").alias("valor_entero"))


@prim("fn_cast_timestamp")
def fn_cast_timestamp(w):
    return w.events.select("event_id", F.col("ts").cast("string").cast(S.TS).alias("ts"))


@prim("fn_round")
def fn_round(w):
    return w.tick_event.select("id_evento", round_to("pos_x", 2).alias("x2"),
                               round_to(F.col("pos_x") / F.lit(3).cast("decimal(1,0)"), 6, 24).alias("x6"))


@prim("fn_sqrt_power")
def fn_sqrt_power(w):
    return w.tick_event.select("id_evento", F.sqrt(F.col("pos_x").cast("double")).alias("raiz_x"),
                               F.pow(F.col("pos_y").cast("double"), F.lit(2.0)).alias("y_cuadrado"))


@prim("fn_euclid3")
def fn_euclid3(w):
    origin = (F.lit(0), F.lit(0), F.lit(0))
    return w.tick_event.select("id_evento", round_to(dist3(origin, (F.col("pos_x"), F.col("pos_y"),
                                                                    F.col("pos_z"))), 4).alias("dist_origen"))


@prim("fn_trig")
def fn_trig(w):
    t = F.col("tic").cast("double")
    return w.tick_event.select("id_evento", round_to(F.sin(t), 10).alias("seno"), round_to(F.cos(t), 10).alias("coseno"))


@prim("fn_random")
def fn_random(w):
    """A value from 1 to 5 drawn by the key (a digest, so the same in any layout)."""
    grid = join_cross_product(w)
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", "id_usuario", "id_item")), 1, 8), 16, 10).cast("long") % 401
    return grid.select("id_usuario", "id_item", round_to(1 + draw.cast("decimal(10,0)") / 100, 2).alias("valor_respuesta"))


@prim("fn_epoch_minutes")
def fn_epoch_minutes(w):
    return w.session.select("id_partida", round_to(epoch_minutes("fecha_inicio", "fecha_fin"), 2)
                            .alias("duracion_min"))


@prim("fn_now_default")
def fn_now_default(w):
    fin = F.coalesce(F.col("fecha_fin"), F.localtimestamp())
    return w.session.select("id_partida", (fin >= F.col("fecha_inicio")).alias("cerrada_o_en_curso"))


@prim("fn_arith")
def fn_arith(w):
    return w.tick_event.select("id_evento",
                               ((F.col("pos_x") + F.col("pos_y")) * 2 - F.col("pos_z")).cast("decimal(20,4)").alias("combinado"),
                               (-F.col("pos_x")).alias("negado"))


@prim("fn_compare")
def fn_compare(w):
    return w.volunteer.select("id_usuario", F.col("edad").between(10, 99).alias("edad_valida"),
                              F.col("genero").isNull().alias("sin_genero"))


@prim("fn_default_fill")
def fn_default_fill(w):
    return w.staging.select(F.coalesce("raw_id_sector", F.lit("sin_origen")).alias("sector_o_defecto"))


# ------------------------------------------------------------------ §2.11 audits
def _tables(w):
    return {n: w.table(n) for n in S.KEYS}


@prim("audit_unique")
def audit_unique(w):
    t = _tables(w)
    parts = []
    for name, k in S.KEYS.items():
        for key in (k.primary, *k.unique):
            parts.append(AU.unique_violations(t[name], name, key))
    return reduce(DataFrame.unionByName, parts)


@prim("audit_foreign_key")
def audit_foreign_key(w):
    return AU.foreign_key_violations(_tables(w), S.KEYS)


@prim("audit_check")
def audit_check(w):
    t = _tables(w)
    parts = [AU.check_violations(t[name], name, k.checks) for name, k in S.KEYS.items() if k.checks]
    return reduce(DataFrame.unionByName, parts)


@prim("audit_not_null_length")
def audit_not_null_length(w):
    t = _tables(w)
    parts = [AU.not_null_length_violations(t[name], name, S.NOT_NULL[name], k.max_length)
             for name, k in S.KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


@prim("surrogate_key")
def surrogate_key(w):
    return AU.surrogate_keys(w.participation.select("id_partida", "id_jugador"),
                             ["id_partida", "id_jugador"], "id_participante")


@prim("surrogate_key_rows")
def surrogate_key_rows(w):
    """Whole fact rows numbered on from the largest event id."""
    base = scalar(w.read("events").agg(F.max("event_id").cast("long").alias("m")), "m")
    rows = w.tick_event.select("id_evento", "id_partida", "id_jugador", "tic", "id_sector", "pos_x", "salud")
    return AU.surrogate_keys(rows, ["id_partida", "id_jugador", "tic"], "id_nuevo", base=base)


@prim("rpt_table_counts")
def rpt_table_counts(w):
    return an.rpt_table_counts(w, ing.reject_log(w))

