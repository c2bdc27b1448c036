"""DuckDB SQL for the analytical jobs, written from their output contracts.

Every job reduces the fact by ids first and attaches names at the end; first
and last of a group come from ``min`` / ``max`` over a struct, ranks of one from
a group minimum. The Spark plans are not the source of these statements.
"""

from __future__ import annotations

from ticklake.oracle.prelude import dec_avg_round, div_round, star

# Descriptions by id: where a session or a sector is, and who a player is.
SESSION_AT = """
session_at AS (
  SELECT id_partida, id_mapa, codigo_mapa, nombre_mapa, id_episodio, nombre_episodio
  FROM episode JOIN map USING (id_episodio) JOIN session USING (id_mapa)
)"""
SECTOR_AT = """
sector_at AS (
  SELECT id_sector, codigo_sector, coordenada_x, coordenada_y, id_mapa, codigo_mapa, nombre_mapa,
         id_episodio, nombre_episodio
  FROM episode JOIN map USING (id_episodio) JOIN sector USING (id_mapa)
)"""
WHO = """
who AS (SELECT id_jugador, alias, id_usuario, codigo_anonimo FROM volunteer JOIN player USING (id_usuario))"""

# Length of the way from the tick before, with six decimals (exact sums).
STEPS = """
moves AS (
  SELECT id_partida, id_jugador, tic, pos_x, pos_y, pos_z,
         lag({'x': pos_x, 'y': pos_y, 'z': pos_z}) OVER (PARTITION BY id_partida, id_jugador ORDER BY tic) AS was
  FROM tick_event
),
steps AS (
  SELECT id_partida, id_jugador, tic,
         CAST(sqrt(CAST((pos_x - was.x) * (pos_x - was.x) + (pos_y - was.y) * (pos_y - was.y)
                        + (pos_z - was.z) * (pos_z - was.z) AS DOUBLE)) AS DECIMAL(18,6)) AS step
  FROM moves
),
travel AS (
  SELECT id_jugador, id_partida, count(*) AS ticks, CAST(round(sum(step), 4) AS DECIMAL(18,4)) AS total
  FROM steps GROUP BY id_jugador, id_partida
)"""

# Pairs of players at one instant, no further apart than 50 units.
NEAR = """
gaps AS (
  SELECT one.id_partida, tic, one.id_jugador AS p, two.id_jugador AS q,
         two.pos_x - one.pos_x AS dx, two.pos_y - one.pos_y AS dy, two.pos_z - one.pos_z AS dz
  FROM tick_event one JOIN tick_event two USING (id_partida, tic) WHERE one.id_jugador < two.id_jugador
),
near AS (
  SELECT id_partida, tic, p, q, CAST(sqrt(CAST(dx * dx + dy * dy + dz * dz AS DOUBLE)) AS DECIMAL(18,6)) AS dist
  FROM gaps WHERE dx * dx + dy * dy + dz * dz <= 50 * 50
)"""

# Pairs of players at one instant in one sector.
TOGETHER = """
together AS (
  SELECT id_partida, id_sector, tic, one.id_jugador AS p, two.id_jugador AS q
  FROM tick_event one JOIN tick_event two USING (id_partida, id_sector, tic) WHERE one.id_jugador < two.id_jugador
)"""

TICKS = "ticks AS (SELECT id_jugador, id_partida, count(tic) AS total FROM tick_event GROUP BY id_jugador, id_partida)"


def ctes(*parts: str) -> str:
    return ",\n".join(p.strip() for p in parts)


def hotspots(fact: str) -> str:
    """SELECT of the hotspot view over the rows of ``fact``; needs SECTOR_AT."""
    return f"""
SELECT id_episodio, nombre_episodio, id_mapa, codigo_mapa, nombre_mapa, id_sector, codigo_sector,
       coordenada_x, coordenada_y, n AS total_eventos, players AS jugadores_unicos,
       sessions AS partidas_con_presencia, health AS salud_promedio_en_sector,
       ammo AS municion_promedio_en_sector, {div_round("n", "players", 2)} AS eventos_por_jugador,
       1 + (SELECT count(*) FROM reduced r JOIN sector_at o USING (id_sector)
            WHERE o.id_mapa = spot.id_mapa AND r.n > reduced.n) AS rank_en_mapa
FROM (SELECT id_sector, count(id_evento) AS n, count(DISTINCT id_jugador) AS players,
             count(DISTINCT id_partida) AS sessions, {dec_avg_round("salud", 0, 2)} AS health,
             {dec_avg_round("municion", 0, 2)} AS ammo
      FROM {fact} GROUP BY id_sector) reduced JOIN sector_at spot USING (id_sector)""".replace(
        "FROM reduced r", f"FROM (SELECT id_sector, count(id_evento) AS n FROM {fact} GROUP BY id_sector) r")


SQL = {}

SQL["q1_session_duration_by_map"] = star("""
lengths AS (SELECT id_mapa, epoch_us(fecha_fin) - epoch_us(fecha_inicio) AS us FROM session WHERE fecha_fin IS NOT NULL),
by_map AS (SELECT id_mapa, count(*) AS n, sum(us) AS total, min(us) AS least, max(us) AS most FROM lengths GROUP BY id_mapa)
""", f"""
SELECT nombre_episodio AS episodio, codigo_mapa AS mapa, nombre_mapa, n AS total_partidas,
       {div_round("total", "n * 60000000", 2)} AS duracion_promedio_min,
       {div_round("least", "60000000", 2)} AS duracion_minima_min,
       {div_round("most", "60000000", 2)} AS duracion_maxima_min
FROM by_map JOIN map USING (id_mapa) JOIN episode USING (id_episodio)""")

SQL["q2_pair_proximity"] = star(ctes(NEAR, """
by_pair AS (SELECT id_partida, p, q, count(*) AS n, sum(dist) AS total, min(dist) AS least FROM near GROUP BY id_partida, p, q)
"""), f"""
SELECT id_partida, first.alias AS jugador_a, second.alias AS jugador_b, CAST(sum(n) AS BIGINT) AS tics_dentro_umbral,
       {div_round("sum(total) * 1000000", "sum(n) * 1000000", 4)} AS distancia_promedio,
       CAST(round(min(least), 4) AS DECIMAL(18,4)) AS distancia_minima
FROM by_pair JOIN player first ON first.id_jugador = p JOIN player second ON second.id_jugador = q
GROUP BY id_partida, first.alias, second.alias""")

SQL["q2b_pair_distance_sample"] = star(NEAR, """
SELECT id_partida, p AS jugador_a, q AS jugador_b, tic, CAST(round(dist, 4) AS DECIMAL(18,4)) AS distancia_euclidiana FROM near""")

SQL["q3a_session_path_length"] = star(STEPS, """
SELECT id_jugador, id_partida, total AS distancia_total FROM travel WHERE total IS NOT NULL""")

SQL["q3_shortest_longest_path"] = star(ctes(STEPS, WHO, f"""
ways AS (
  SELECT id_jugador, count(DISTINCT id_partida) AS n, min({{'d': total, 'p': id_partida}}) AS least,
         max({{'d': total, 'p': -id_partida}}) AS most, {dec_avg_round("total", 4, 4)} AS mean
  FROM travel WHERE total IS NOT NULL GROUP BY id_jugador)"""), """
SELECT alias AS jugador, codigo_anonimo, n AS total_partidas, least.d AS trayectoria_mas_corta,
       most.d AS trayectoria_mas_larga, mean AS trayectoria_promedio,
       least.p AS partida_mas_corta, -most.p AS partida_mas_larga
FROM ways JOIN who USING (id_jugador)""")

SQL["q8_distance_speed"] = star(ctes(STEPS, WHO, """
sums AS (
  SELECT id_jugador, sum(total) AS way, sum(ticks) AS n, count(DISTINCT id_partida) AS sessions
  FROM travel GROUP BY id_jugador)"""), f"""
SELECT alias AS jugador, codigo_anonimo, CAST(way AS DECIMAL(28,4)) AS distancia_total_acumulada,
       CAST(n AS BIGINT) AS total_tics, sessions AS partidas_jugadas,
       {div_round("way * 10000", "n * 10000", 6)} AS velocidad_promedio_por_tic,
       {div_round("way * 10000 * 35", "n * 10000", 4)} AS velocidad_promedio_por_segundo
FROM sums JOIN who USING (id_jugador)""")

SQL["q4_survey_above_avg"] = star(ctes(WHO, TICKS, "mean AS (SELECT sum(total) AS s, count(*) AS n FROM ticks)"), f"""
SELECT alias AS jugador, codigo_anonimo AS usuario_anonimo, total AS tics_jugados,
       (SELECT {div_round("s", "n", 2)} FROM mean) AS promedio_global_tics,
       texto_pregunta AS pregunta_ux, dimension AS dimension_bangs, valor_respuesta AS puntuacion
FROM survey_response JOIN survey_item USING (id_item) JOIN who USING (id_usuario)
JOIN ticks USING (id_jugador, id_partida)
WHERE total * (SELECT n FROM mean) > (SELECT s FROM mean)""")

SQL["q5_sector_hotspots"] = star(ctes(SECTOR_AT, """
visits AS (SELECT id_sector, count(id_evento) AS n, count(DISTINCT id_jugador) AS players FROM tick_event GROUP BY id_sector)
"""), f"""
SELECT nombre_episodio AS episodio, codigo_mapa AS mapa, nombre_mapa, codigo_sector AS sector,
       coordenada_x AS coord_x, coordenada_y AS coord_y, n AS total_presencias, players AS jugadores_distintos,
       {div_round("n", "players", 2)} AS presencias_por_jugador
FROM visits JOIN sector_at USING (id_sector)""")

SQL["mv_sector_hotspots"] = star(SECTOR_AT, hotspots("tick_event"))

SQL["q6_copresence_pct"] = star(ctes(SESSION_AT, TOGETHER, """
span AS (SELECT id_partida, count(DISTINCT tic) AS n FROM tick_event GROUP BY id_partida),
named AS (
  SELECT DISTINCT id_partida, tic, codigo_sector, first.alias AS a, second.alias AS b
  FROM together JOIN sector USING (id_sector)
  JOIN player first ON first.id_jugador = p JOIN player second ON second.id_jugador = q),
counted AS (SELECT id_partida, codigo_sector, a, b, count(*) AS shared FROM named GROUP BY ALL)"""), f"""
SELECT id_partida, nombre_episodio AS episodio, codigo_mapa AS mapa, codigo_sector AS sector,
       a AS jugador_a, b AS jugador_b, shared AS tics_compartidos,
       {div_round("shared * 100", "n", 2)} AS pct_partida_juntos
FROM counted JOIN span USING (id_partida) JOIN session_at USING (id_partida)""")

SQL["v_sector_copresence"] = star(ctes(SESSION_AT, TOGETHER, """
counted AS (SELECT id_partida, id_sector, p, q, count(DISTINCT tic) AS shared FROM together GROUP BY ALL)"""), """
SELECT id_partida, id_sector, codigo_sector, nombre_episodio, codigo_mapa, p AS jugador_a, first.alias AS alias_a,
       q AS jugador_b, second.alias AS alias_b, shared AS tics_compartidos
FROM counted JOIN session_at USING (id_partida) JOIN sector USING (id_sector)
JOIN player first ON first.id_jugador = p JOIN player second ON second.id_jugador = q""")

EPISODE_TICKS = ctes(SESSION_AT, TICKS, """
episode_ticks AS (
  SELECT id_episodio, nombre_episodio, id_jugador, CAST(sum(total) AS BIGINT) AS total
  FROM ticks JOIN session_at USING (id_partida) GROUP BY id_episodio, nombre_episodio, id_jugador)""")

SQL["q7_survey_of_shortest"] = star(ctes(EPISODE_TICKS, WHO, """
fewest AS (SELECT id_episodio, min(total) AS total FROM episode_ticks GROUP BY id_episodio)"""), f"""
SELECT nombre_episodio AS episodio, alias AS jugador, codigo_anonimo AS usuario_anonimo,
       total AS tics_trayectoria_corta, dimension AS dimension_bangs,
       {dec_avg_round("valor_respuesta", 2, 2)} AS score_ux_promedio, count(id_respuesta) AS items_respondidos
FROM fewest JOIN episode_ticks USING (id_episodio, total) JOIN who USING (id_jugador)
JOIN survey_response USING (id_usuario) JOIN survey_item USING (id_item)
GROUP BY nombre_episodio, alias, codigo_anonimo, total, dimension""")

SQL["v_player_trajectory"] = star(ctes(SESSION_AT, WHO, f"""
tracks AS (
  SELECT id_partida, id_jugador, count(tic) AS n, {dec_avg_round("pos_x", 4, 4)} AS mean_x,
         {dec_avg_round("pos_y", 4, 4)} AS mean_y, max(pos_x) - min(pos_x) AS wide, max(pos_y) - min(pos_y) AS high,
         {dec_avg_round("salud", 0, 2)} AS health, {dec_avg_round("municion", 0, 2)} AS ammo,
         min(tic) AS since, max(tic) AS until
  FROM tick_event GROUP BY id_partida, id_jugador)"""), """
SELECT id_partida, id_jugador, alias, codigo_anonimo, nombre_episodio, codigo_mapa, n AS total_tics,
       mean_x AS pos_x_promedio, mean_y AS pos_y_promedio, CAST(wide AS DECIMAL(18,4)) AS rango_x,
       CAST(high AS DECIMAL(18,4)) AS rango_y, health AS salud_promedio, ammo AS municion_promedio,
       since AS tic_inicio, until AS tic_fin
FROM tracks JOIN who USING (id_jugador) JOIN session_at USING (id_partida)""")

SQL["tick_grid"] = star("""
spans AS (SELECT id_partida, id_jugador, min(tic) AS lo, max(tic) AS hi FROM tick_event GROUP BY id_partida, id_jugador)
""", """
SELECT id_partida, id_jugador, CAST(tic AS INTEGER) AS tic
FROM (SELECT id_partida, id_jugador, unnest(generate_series(lo, hi)) AS tic FROM spans)
EXCEPT SELECT id_partida, id_jugador, tic FROM tick_event""")
