"""DuckDB oracle SQL for the primitive keys."""

from __future__ import annotations

from ticklake import schemas as S
from ticklake.oracle.analytics import EPISODE_TICKS, NEAR, SECTOR_AT
from ticklake.oracle.analytics import SQL as A
from ticklake.oracle.analytics import STEPS as WALK
from ticklake.oracle.analytics import hotspots
from ticklake.oracle.ingest import RAW, SQL as G, STEPS
from ticklake.oracle.prelude import dbl_round, dec_avg_round, div_round, star

LINE = f"concat_ws(chr(9), {', '.join(RAW)})"
U, I, D = r"'^\d+$'", r"'^-?\d+$'", r"'^-?\d+(\.\d+)?$'"


def blank(c):
    return f"({c} IS NULL OR trim({c}) = '')"


TSTG = f"""
tstg AS (
  SELECT *, {LINE} AS linea_raw,
         TRY_CAST(raw_id_partida AS INTEGER) AS k_partida, TRY_CAST(raw_id_jugador AS BIGINT) AS k_jugador,
         TRY_CAST(raw_tic AS INTEGER) AS k_tic, TRY_CAST(NULLIF(trim(raw_id_sector), '') AS BIGINT) AS k_sector
  FROM staging)"""

PER_PS = "per_ps AS (SELECT id_jugador, id_partida, COUNT(tic) AS total_tics FROM tick_event GROUP BY id_jugador, id_partida)"

Q = {}

# §2.1 sources and sinks
Q["src_tsv_staging"] = star("", f"SELECT {', '.join(RAW)} FROM staging")
Q["src_scan"] = star("", "SELECT * FROM tick_event")
Q["src_insert_if_absent"] = star(TSTG, """
SELECT id_jugador, alias, id_usuario FROM player
UNION ALL
SELECT DISTINCT k_jugador, 'desconocido_' || CAST(k_jugador AS VARCHAR), k_jugador
FROM tstg WHERE k_jugador IS NOT NULL AND NOT EXISTS (SELECT 1 FROM player p WHERE p.id_jugador = k_jugador)""")
Q["src_series"] = star("", """
SELECT id_partida, CAST(UNNEST(generate_series(lo, hi)) AS INTEGER) AS tic
FROM (SELECT id_partida, MIN(tic) AS lo, MAX(tic) AS hi FROM tick_event GROUP BY id_partida)""")
Q["snk_reject_log"] = G["etl_reject_log"]
Q["snk_insert_no_conflict"] = G["etl_accept"]
Q["snk_reload"] = star("", "SELECT * FROM sector")
Q["snk_view"] = A["v_player_trajectory"]
Q["snk_materialize_refresh"] = star(SECTOR_AT + "," + STEPS + """,
fact_after AS (
  SELECT id_evento, id_partida, id_jugador, id_sector, tic, salud, municion FROM preloaded_fact
  UNION ALL
  SELECT -1, id_partida, id_jugador, id_sector, tic, salud, municion FROM accepted)""",
    hotspots("fact_after"))
for _layout in ("snk_clustered_layout", "snk_layout_sector", "snk_layout_position", "snk_layout_player"):
    Q[_layout] = star("", "SELECT * FROM tick_event")

# §2.2 projections
Q["prj_select_alias"] = star("", "SELECT id_partida AS partida, id_mapa AS mapa, fecha_inicio AS inicio, fecha_fin AS fin FROM session")
Q["prj_star"] = star("", f"""
SELECT s.*, {div_round("epoch_us(s.fecha_fin) - epoch_us(s.fecha_inicio)", "60000000", 2)} AS duracion_min FROM session s""")
Q["prj_literal"] = star("", "SELECT id_evento, 1 AS id_sector_defecto, 'evento_telemetria' AS tabla FROM tick_event")
_TYPED = [("raw_id_partida", "INTEGER", "id_partida"), ("raw_id_jugador", "BIGINT", "id_jugador"),
          ("raw_tic", "INTEGER", "tic"), ("raw_salud", "INTEGER", "salud"),
          ("raw_armadura", "INTEGER", "armadura"), ("raw_municion", "INTEGER", "municion"),
          ("raw_pos_x", "DECIMAL(12,4)", "pos_x"), ("raw_pos_y", "DECIMAL(12,4)", "pos_y"),
          ("raw_pos_z", "DECIMAL(12,4)", "pos_z"), ("raw_momentum_x", "DECIMAL(10,4)", "momentum_x"),
          ("raw_momentum_y", "DECIMAL(10,4)", "momentum_y"), ("raw_momentum_z", "DECIMAL(10,4)", "momentum_z"),
          ("raw_fov", "DECIMAL(6,2)", "fov"), ("raw_angulo", "DECIMAL(8,4)", "angulo"),
          ("raw_id_sector", "BIGINT", "id_sector")]
Q["prj_typed_cast"] = star("", "SELECT " + ", ".join(
    f"TRY_CAST(NULLIF(trim({f}), '') AS {t}) AS {n}" for f, t, n in _TYPED) + " FROM staging")
Q["prj_raw_line"] = star("", f"SELECT {LINE} AS linea_raw FROM staging")

# §2.3 filters
_MISSING = f"{blank('raw_id_partida')} OR {blank('raw_id_jugador')} OR {blank('raw_tic')}"
Q["flt_blank"] = star("", f"SELECT raw_id_partida, raw_id_jugador, raw_tic FROM staging WHERE {_MISSING}")
Q["flt_regex"] = star("", f"""
SELECT raw_id_jugador, raw_tic, raw_pos_x FROM staging
WHERE regexp_matches(raw_id_jugador, {U}) AND regexp_matches(raw_tic, {I}) AND regexp_matches(raw_pos_x, {D})""")
_MAND = [("raw_id_partida", U), ("raw_id_jugador", U), ("raw_tic", I), ("raw_salud", I), ("raw_armadura", I),
         ("raw_municion", I), ("raw_pos_x", D), ("raw_pos_y", D), ("raw_pos_z", D), ("raw_momentum_x", D),
         ("raw_momentum_y", D), ("raw_momentum_z", D)]
_OPT = [("raw_fov", D), ("raw_angulo", D), ("raw_id_sector", U)]
_BAD = " OR ".join([f"NOT regexp_matches({c}, {p})" for c, p in _MAND] +
                   [f"(NOT {blank(c)} AND NOT regexp_matches({c}, {p}))" for c, p in _OPT])
Q["flt_not_regex"] = star("", f"SELECT {LINE} AS linea_raw FROM staging WHERE {_BAD}")
Q["flt_optional_regex"] = star("", f"SELECT {LINE} AS linea_raw FROM staging WHERE " + " AND ".join(
    f"({blank(c)} OR regexp_matches({c}, {p}))" for c, p in _OPT))
Q["flt_range"] = star("", f"""
SELECT raw_tic, {LINE} AS linea_raw FROM staging
WHERE regexp_matches(raw_tic, {I}) AND TRY_CAST(raw_tic AS INTEGER) < 0""")
Q["flt_boolean"] = star("", "SELECT id_usuario, codigo_anonimo FROM volunteer WHERE consentimiento = FALSE")
Q["flt_not_null"] = star("", "SELECT id_partida, fecha_fin FROM session WHERE fecha_fin IS NOT NULL")
Q["flt_distance"] = A["q2b_pair_distance_sample"]
Q["flt_rank"] = star(EPISODE_TICKS, """
SELECT id_episodio, id_jugador, total AS total_tics FROM episode_ticks t
WHERE total = (SELECT min(total) FROM episode_ticks u WHERE u.id_episodio = t.id_episodio)""")
Q["flt_having"] = star("", """
SELECT id_partida, id_jugador, COUNT(tic) AS total_tics FROM tick_event
GROUP BY id_partida, id_jugador HAVING COUNT(tic) > 1""")
Q["flt_negated_disjunction"] = star("", f"SELECT {LINE} AS linea_raw FROM staging WHERE NOT ({_MISSING})")
Q["flt_correlated_equality"] = star("", """
SELECT t.id_partida, t.id_jugador, t.tic,
       (SELECT COUNT(u.tic) FROM tick_event u WHERE u.id_partida = t.id_partida) AS tics_partida
FROM tick_event t""")

# §2.4 joins
Q["join_star_chain"] = star("", """
SELECT et.id_evento, s.codigo_sector, m.codigo_mapa, e.nombre_episodio
FROM tick_event et JOIN sector s ON s.id_sector = et.id_sector
JOIN map m ON m.id_mapa = s.id_mapa JOIN episode e ON e.id_episodio = m.id_episodio""")
Q["join_composite_key"] = star(PER_PS, """
SELECT d.id_jugador AS id_usuario, d.id_partida, d.total_tics, r.id_respuesta, r.valor_respuesta
FROM per_ps d JOIN survey_response r ON r.id_usuario = d.id_jugador AND r.id_partida = d.id_partida""")
Q["join_self_pairs"] = star("", """
SELECT a.id_partida, a.tic, COUNT(*) AS pares
FROM tick_event a JOIN tick_event b ON a.id_partida = b.id_partida AND a.tic = b.tic AND a.id_jugador < b.id_jugador
GROUP BY a.id_partida, a.tic""")
Q["join_self_pairs_sector"] = star("", """
SELECT a.id_partida, a.tic, a.id_sector, COUNT(*) AS pares
FROM tick_event a JOIN tick_event b ON a.id_partida = b.id_partida AND a.tic = b.tic
     AND a.id_sector = b.id_sector AND a.id_jugador < b.id_jugador
GROUP BY a.id_partida, a.tic, a.id_sector""")
Q["join_left_outer_filtered"] = star(WALK, """
SELECT id_jugador, id_partida, tic, CAST(round(step, 4) AS DECIMAL(18,4)) AS dist_al_anterior
FROM tick_event LEFT JOIN (SELECT * FROM steps WHERE step IS NOT NULL) USING (id_jugador, id_partida, tic)""")
Q["join_cross_scalar"] = star(PER_PS + ", pg AS (SELECT SUM(total_tics) AS s, COUNT(*) AS n FROM per_ps)", f"""
SELECT d.id_jugador, d.id_partida, d.total_tics, {div_round("pg.s", "pg.n", 2)} AS avg_tics
FROM per_ps d CROSS JOIN pg""")
Q["join_theta_scalar"] = star(PER_PS + ", pg AS (SELECT SUM(total_tics) AS s, COUNT(*) AS n FROM per_ps)", """
SELECT d.id_jugador, d.id_partida, d.total_tics FROM per_ps d, pg WHERE d.total_tics * pg.n > pg.s""")
Q["join_cross_series"] = star("", """
SELECT id_partida, id_jugador, CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS tic
FROM (SELECT id_partida, id_jugador, min(tic) AS lo, max(tic) AS hi FROM tick_event GROUP BY ALL)""")
Q["join_cross_product"] = star("", "SELECT u.id_usuario, i.id_item FROM volunteer u CROSS JOIN survey_item i")
Q["join_semi"] = star("", """
SELECT r.id_respuesta, r.id_usuario FROM survey_response r
WHERE EXISTS (SELECT 1 FROM tick_event t WHERE t.id_jugador = r.id_usuario)""")
Q["join_anti"] = star(TSTG, "SELECT linea_raw FROM tstg WHERE NOT EXISTS (SELECT 1 FROM player p WHERE p.id_jugador = k_jugador)")
_IN_MAP = ("EXISTS (SELECT 1 FROM session p JOIN map m ON m.id_mapa = p.id_mapa JOIN sector sec ON sec.id_mapa = m.id_mapa "
           "WHERE p.id_partida = k_partida AND sec.id_sector = k_sector)")
Q["join_anti_composite"] = star(TSTG, f"SELECT linea_raw FROM tstg WHERE regexp_matches(raw_id_sector, {U}) AND NOT {_IN_MAP}")
Q["join_existence_or"] = star(TSTG, f"SELECT linea_raw FROM tstg WHERE {blank('raw_id_sector')} OR {_IN_MAP}")
Q["join_semi_core"] = star(TSTG, """
SELECT linea_raw FROM tstg WHERE EXISTS (SELECT 1 FROM preloaded_fact e
  WHERE e.id_partida = k_partida AND e.id_jugador = k_jugador AND e.tic = k_tic)""")
Q["join_cast_key"] = star(TSTG, "SELECT s.linea_raw, j.alias FROM tstg s JOIN player j ON j.id_jugador = s.k_jugador")

# §2.5 aggregations
Q["agg_count_star"] = star("", "SELECT id_partida, COUNT(*) AS filas FROM tick_event GROUP BY id_partida")
Q["agg_count_col"] = star("", "SELECT id_partida, COUNT(id_sector) AS con_sector FROM tick_event GROUP BY id_partida")
Q["agg_count_distinct"] = star("", "SELECT id_partida, COUNT(DISTINCT id_jugador) AS jugadores FROM tick_event GROUP BY id_partida")
Q["agg_multi_distinct"] = star("", f"""
SELECT s.id_mapa, COUNT(DISTINCT et.id_jugador) AS jugadores_unicos, COUNT(DISTINCT et.id_partida) AS partidas_con_presencia,
       {dec_avg_round("et.salud", 0, 2)} AS salud_promedio
FROM tick_event et JOIN sector s ON s.id_sector = et.id_sector GROUP BY s.id_mapa""")
Q["agg_sum"] = star("", "SELECT id_jugador, CAST(SUM(municion) AS BIGINT) AS municion_total FROM tick_event GROUP BY id_jugador")
Q["agg_avg"] = star("", f"""
SELECT id_partida, {dec_avg_round("salud", 0, 2)} AS salud_promedio, {dec_avg_round("pos_x", 4, 4)} AS pos_x_promedio
FROM tick_event GROUP BY id_partida""")
Q["agg_min_max"] = star("", """
SELECT id_partida, MIN(pos_x) AS pos_x_min, MAX(pos_x) AS pos_x_max, MIN(tic) AS tic_min, MAX(tic) AS tic_max
FROM tick_event GROUP BY id_partida""")
Q["agg_spread"] = star("", """
SELECT id_partida, CAST(ROUND(MAX(pos_x) - MIN(pos_x), 4) AS DECIMAL(18,4)) AS rango_x FROM tick_event GROUP BY id_partida""")
Q["agg_ratio"] = star("", f"""
SELECT id_sector, {div_round("COUNT(id_evento)", "COUNT(DISTINCT id_jugador)", 2)} AS presencias_por_jugador
FROM tick_event GROUP BY id_sector""")
Q["agg_percent_of_group"] = star("", f"""
SELECT t.id_partida, t.id_sector,
       {div_round("COUNT(DISTINCT t.tic) * 100", "(SELECT COUNT(DISTINCT u.tic) FROM tick_event u WHERE u.id_partida = t.id_partida)", 2)} AS pct
FROM tick_event t WHERE t.id_sector IS NOT NULL GROUP BY t.id_partida, t.id_sector""")
Q["agg_of_agg"] = star(PER_PS, f"SELECT id_partida, {dec_avg_round('total_tics', 0, 2)} AS tics_promedio FROM per_ps GROUP BY id_partida")
Q["agg_global"] = star(PER_PS, f"SELECT COUNT(*) AS sesiones_jugador, {dec_avg_round('total_tics', 0, 2)} AS tics_promedio FROM per_ps")
Q["agg_wide_key"] = star("", """
SELECT e.id_episodio, e.nombre_episodio, m.id_mapa, m.codigo_mapa, m.nombre_mapa, COUNT(et.id_evento) AS eventos
FROM tick_event et JOIN session p ON p.id_partida = et.id_partida JOIN map m ON m.id_mapa = p.id_mapa
JOIN episode e ON e.id_episodio = m.id_episodio
GROUP BY e.id_episodio, e.nombre_episodio, m.id_mapa, m.codigo_mapa, m.nombre_mapa""")
Q["agg_rate_scaled"] = star(WALK, f"""
SELECT id_jugador, {div_round("sum(step) * 1000000 * 35", "count(*) * 1000000", 4)} AS velocidad_por_segundo
FROM steps GROUP BY id_jugador""")

# §2.6 windows
Q["win_lag"] = star("", """
SELECT id_jugador, id_partida, tic, lag(pos_x) OVER w AS prev_pos_x, lag(pos_y) OVER w AS prev_pos_y,
       lag(pos_z) OVER w AS prev_pos_z
FROM tick_event WINDOW w AS (PARTITION BY id_jugador, id_partida ORDER BY tic)""")
Q["win_rank"] = star(EPISODE_TICKS, """
SELECT id_jugador, id_episodio, total AS total_tics, rank() OVER (PARTITION BY id_episodio ORDER BY total) AS rk
FROM episode_ticks""")
Q["win_rank_over_agg"] = star("", """
SELECT s.id_mapa, et.id_sector, COUNT(et.id_evento) AS total_eventos,
       RANK() OVER (PARTITION BY s.id_mapa ORDER BY COUNT(et.id_evento) DESC) AS rank_en_mapa
FROM tick_event et JOIN sector s ON s.id_sector = et.id_sector GROUP BY s.id_mapa, et.id_sector""")
_KEYED = TSTG + """,
keyed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k_partida, k_jugador, k_tic
                                      ORDER BY cargado_en, archivo_origen, linea_raw) AS rn
          FROM tstg WHERE k_partida IS NOT NULL AND k_jugador IS NOT NULL AND k_tic IS NOT NULL)"""
Q["win_row_number_dedup"] = star(_KEYED, """
SELECT k_partida AS id_partida, k_jugador AS id_jugador, k_tic AS tic, linea_raw FROM keyed WHERE rn > 1""")
Q["win_named"] = star(WALK, """
SELECT id_jugador, id_partida, tic, CAST(round(step, 4) AS DECIMAL(18,4)) AS dist_al_anterior FROM steps""")

# §2.7 sort, limit, top-k
Q["sort_multi_key"] = star("", "SELECT id_partida, id_mapa, fecha_inicio FROM session ORDER BY id_mapa, fecha_inicio DESC")
Q["sort_by_aggregate"] = star("", "SELECT id_jugador, COUNT(*) AS eventos FROM tick_event GROUP BY id_jugador ORDER BY eventos DESC, id_jugador")
Q["sort_non_projected"] = star("", "SELECT texto_pregunta, dimension FROM survey_item ORDER BY id_item")
Q["limit_sample"] = star(NEAR, """
SELECT id_partida, p AS jugador_a, q AS jugador_b, tic, CAST(round(dist, 4) AS DECIMAL(18,4)) AS distancia_euclidiana
FROM near ORDER BY id_partida, tic, p, q LIMIT 100""")
_ENDS = WALK + """,
ends AS (
  SELECT id_jugador, min({'d': total, 'p': id_partida}).p AS nearest, -max({'d': total, 'p': -id_partida}).p AS farthest
  FROM travel WHERE total IS NOT NULL GROUP BY id_jugador)"""
Q["argmin_per_group"] = star(_ENDS, "SELECT id_jugador, nearest AS partida_mas_corta FROM ends")
Q["argmax_per_group"] = star(_ENDS, "SELECT id_jugador, farthest AS partida_mas_larga FROM ends")
Q["distinct_on_first"] = star(TSTG, """
SELECT DISTINCT ON (k_partida, k_jugador, k_tic) k_partida AS id_partida, k_jugador AS id_jugador, k_tic AS tic, linea_raw
FROM tstg WHERE k_partida IS NOT NULL AND k_jugador IS NOT NULL AND k_tic IS NOT NULL
ORDER BY k_partida, k_jugador, k_tic, cargado_en, archivo_origen, linea_raw""")

# §2.8 sets, subqueries, CTEs
Q["union_all_counts"] = star("", """
SELECT 'evento_telemetria' AS tabla, COUNT(*) AS filas FROM tick_event
UNION ALL SELECT 'jugador', COUNT(*) FROM player
UNION ALL SELECT 'usuario', COUNT(*) FROM volunteer
UNION ALL SELECT 'partida', COUNT(*) FROM session
UNION ALL SELECT 'respuesta_ux', COUNT(*) FROM survey_response""")
Q["subq_scalar_correlated_agg"] = star("", """
SELECT t.id_partida, t.id_sector, COUNT(DISTINCT t.tic) AS tics_sector,
       (SELECT COUNT(DISTINCT u.tic) FROM tick_event u WHERE u.id_partida = t.id_partida) AS tics_partida
FROM tick_event t WHERE t.id_sector IS NOT NULL GROUP BY t.id_partida, t.id_sector""")
Q["subq_scalar_correlated_topk"] = star(
    _ENDS, "SELECT id_jugador, nearest AS partida_mas_corta, farthest AS partida_mas_larga FROM ends")
Q["subq_exists"] = star(TSTG, """
SELECT linea_raw, EXISTS (SELECT 1 FROM player p WHERE p.id_jugador = k_jugador) AS existe_jugador,
       EXISTS (SELECT 1 FROM session p WHERE p.id_partida = k_partida) AS existe_partida FROM tstg""")
Q["cte_chain"] = star(PER_PS + ", pg AS (SELECT SUM(total_tics) AS s, COUNT(*) AS n FROM per_ps)", f"""
SELECT d.id_jugador, d.id_partida, d.total_tics, {div_round("pg.s", "pg.n", 2)} AS promedio_global
FROM per_ps d, pg WHERE d.total_tics * pg.n > pg.s""")
Q["cte_insert"] = G["etl_dup_batch"]

# §2.9 scalar functions
Q["fn_trim"] = star("", "SELECT raw_id_partida, trim(raw_id_partida) AS recortado FROM staging")
Q["fn_nullif"] = star("", "SELECT raw_salud, NULLIF(trim(raw_salud), '') AS salud_o_nulo FROM staging")
Q["fn_concat_ws"] = star("", "SELECT concat_ws(chr(9), raw_id_partida, raw_id_jugador, raw_tic) AS clave FROM staging")
Q["fn_regex"] = star("", f"""
SELECT raw_id_partida, regexp_matches(raw_id_partida, {U}) AS es_entero,
       raw_pos_x, regexp_matches(raw_pos_x, {D}) AS es_decimal FROM staging""")
Q["fn_cast_int"] = star("", f"SELECT raw_tic, CASE WHEN regexp_matches(raw_tic, {I}) THEN TRY_CAST(raw_tic AS INTEGER) END AS tic FROM staging")
Q["fn_cast_decimal"] = star("", f"""
SELECT raw_pos_x, CASE WHEN regexp_matches(raw_pos_x, {D}) THEN TRY_CAST(raw_pos_x AS DECIMAL(12,4)) END AS pos_x FROM staging""")
Q["fn_cast_float_int"] = star("", "SELECT event_id, CAST(value AS INTEGER) AS valor_entero FROM events")
Q["fn_cast_timestamp"] = star("", "SELECT event_id, CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts FROM events")
Q["fn_round"] = star("", f"""
SELECT id_evento, CAST(ROUND(pos_x, 2) AS DECIMAL(18,2)) AS x2,
       {div_round("pos_x * 10000", "3 * 10000", 6, 24)} AS x6 FROM tick_event""")
Q["fn_sqrt_power"] = star("", "SELECT id_evento, sqrt(CAST(pos_x AS DOUBLE)) AS raiz_x, power(CAST(pos_y AS DOUBLE), 2.0) AS y_cuadrado FROM tick_event")
Q["fn_euclid3"] = star("", f"""
SELECT id_evento, CAST(round(CAST(sqrt(CAST(pos_x * pos_x + pos_y * pos_y + pos_z * pos_z AS DOUBLE)) AS DECIMAL(18,6)), 4)
                      AS DECIMAL(18,4)) AS dist_origen FROM tick_event""")
Q["fn_trig"] = star("", f"""
SELECT id_evento, {dbl_round("sin(CAST(tic AS DOUBLE))", 10)} AS seno,
       {dbl_round("cos(CAST(tic AS DOUBLE))", 10)} AS coseno FROM tick_event""")
Q["fn_random"] = star("", """
SELECT id_usuario, id_item,
       CAST(1 + CAST('0x' || substr(md5(id_usuario || ':' || id_item), 1, 8) AS BIGINT) % 401 / 100.0 AS DECIMAL(18,2)) AS valor_respuesta
FROM volunteer, survey_item""")
Q["fn_epoch_minutes"] = star("", f"""
SELECT id_partida, {div_round("epoch_us(fecha_fin) - epoch_us(fecha_inicio)", "60000000", 2)} AS duracion_min FROM session""")
Q["fn_now_default"] = star("", "SELECT id_partida, coalesce(fecha_fin, now()::TIMESTAMP) >= fecha_inicio AS cerrada_o_en_curso FROM session")
Q["fn_arith"] = star("", "SELECT id_evento, CAST((pos_x + pos_y) * 2 - pos_z AS DECIMAL(20,4)) AS combinado, -pos_x AS negado FROM tick_event")
Q["fn_compare"] = star("", "SELECT id_usuario, edad BETWEEN 10 AND 99 AS edad_valida, genero IS NULL AS sin_genero FROM volunteer")
Q["fn_default_fill"] = star("", "SELECT coalesce(raw_id_sector, 'sin_origen') AS sector_o_defecto FROM staging")


# §2.11 audits (generated from the declared key metadata)
def _keytext(cols, alias=""):
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({alias}{c} AS VARCHAR), 'NULL')" for c in cols) + ")"


def _audit_unique():
    parts = []
    for name, k in S.KEYS.items():
        for key in (k.primary, *k.unique):
            cname = f"uq_{name}_{'_'.join(key)}"
            parts.append(f"SELECT '{name}' AS tabla, '{cname}' AS restriccion, {_keytext(key)} AS clave, "
                         f"COUNT(*) AS filas FROM {name} GROUP BY {', '.join(key)} HAVING COUNT(*) > 1")
    return star("", "\nUNION ALL ".join(parts))


def _audit_fk():
    parts = []
    for name, k in S.KEYS.items():
        for cols, parent, pcols in k.foreign:
            cname = f"fk_{name}_{'_'.join(cols)}"
            nn = " AND ".join(f"c.{c} IS NOT NULL" for c in cols)
            match = " AND ".join(f"p.{pc} = c.{c}" for c, pc in zip(cols, pcols))
            parts.append(f"SELECT '{name}' AS tabla, '{cname}' AS restriccion, {_keytext(cols, 'c.')} AS clave, "
                         f"COUNT(*) AS filas FROM {name} c WHERE {nn} AND NOT EXISTS "
                         f"(SELECT 1 FROM {parent} p WHERE {match}) GROUP BY {', '.join('c.' + c for c in cols)}")
    return star("", "\nUNION ALL ".join(parts))


def _audit_check():
    parts = [f"SELECT '{name}' AS tabla, '{cn}' AS restriccion, COUNT(*) FILTER (WHERE NOT ({expr})) AS violaciones FROM {name}"
             for name, k in S.KEYS.items() for cn, expr in k.checks]
    return star("", "\nUNION ALL ".join(parts))


def _audit_nn_len():
    parts = []
    for name, k in S.KEYS.items():
        for c in S.NOT_NULL[name]:
            parts.append(f"SELECT '{name}' AS tabla, '{c}' AS columna, 'not_null' AS regla, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS violaciones FROM {name}")
        for c, n in k.max_length.items():
            parts.append(f"SELECT '{name}' AS tabla, '{c}' AS columna, 'max_length_{n}' AS regla, "
                         f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS violaciones FROM {name}")
    return star("", "\nUNION ALL ".join(parts))


Q["audit_unique"] = _audit_unique()
Q["audit_foreign_key"] = _audit_fk()
Q["audit_check"] = _audit_check()
Q["audit_not_null_length"] = _audit_nn_len()
Q["surrogate_key"] = star("", """
SELECT id_partida, id_jugador, ROW_NUMBER() OVER (ORDER BY id_partida, id_jugador) AS id_participante
FROM participation""")
Q["surrogate_key_rows"] = star("", """
SELECT id_evento, id_partida, id_jugador, tic, id_sector, pos_x, salud,
       (SELECT max(event_id) FROM events) + row_number() OVER (ORDER BY id_partida, id_jugador, tic) AS id_nuevo
FROM tick_event""")
Q["rpt_table_counts"] = star(STEPS, """
SELECT 'evento_telemetria' AS tabla, COUNT(*) AS filas FROM tick_event
UNION ALL SELECT 'jugador', COUNT(*) FROM player
UNION ALL SELECT 'usuario', COUNT(*) FROM volunteer
UNION ALL SELECT 'partida', COUNT(*) FROM session
UNION ALL SELECT 'sector', COUNT(*) FROM sector
UNION ALL SELECT 'respuesta_ux', COUNT(*) FROM survey_response
UNION ALL SELECT 'log_errores_carga', COUNT(*) FROM log
ORDER BY tabla""")
