"""DuckDB derivation of the star schema from the driver tables.

Independent of the Spark code path: the same binding written as SQL CTEs
(window dedup instead of a grouped min, correlated subqueries where the
reference uses them). Every oracle query is ``star(extra_ctes, select)``.
"""

from __future__ import annotations

STAR_CTES = r"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value, day, partida, tic, tic // 6 AS hour, k,
         CAST(CASE WHEN event_type = 'view' THEN NULL
                   WHEN event_type = 'error' THEN (partida + 3) % (SELECT max(s_suppkey) + 1 FROM supplier)
                   ELSE partida % (SELECT max(s_suppkey) + 1 FROM supplier) END AS BIGINT) AS sec
  FROM (SELECT event_id, ts, user_id, event_type, value,
               CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day,
               CAST((user_id // 100) * 366 + day AS INTEGER) AS partida,
               CAST(hour(ts) * 6 + minute(ts) // 10 AS INTEGER) AS tic,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events) e0
),
episode AS (
  SELECT CAST(r_regionkey AS INTEGER) AS id_episodio, r_name AS nombre_episodio FROM region
),
map AS (
  SELECT CAST(n_nationkey AS INTEGER) AS id_mapa, CAST(n_regionkey AS INTEGER) AS id_episodio,
         n_name AS codigo_mapa, n_name AS nombre_mapa FROM nation
),
sector AS (
  SELECT CAST(s_suppkey AS BIGINT) AS id_sector, CAST(s_nationkey AS INTEGER) AS id_mapa,
         s_name AS codigo_sector, CAST(s_acctbal AS DECIMAL(10,2)) AS coordenada_x,
         CAST(0 AS DECIMAL(10,2)) AS coordenada_y FROM supplier
),
volunteer AS (
  SELECT CAST(c_custkey AS BIGINT) AS id_usuario, c_name AS codigo_anonimo,
         CAST(c_custkey % 100 AS INTEGER) AS edad, CAST(NULL AS VARCHAR) AS genero,
         c_mktsegment AS experiencia, c_acctbal >= 0 AS consentimiento,
         TIMESTAMP '2024-01-01 00:00:00' AS fecha_registro FROM customer
),
player AS (
  SELECT CAST(c_custkey AS BIGINT) AS id_jugador, c_name AS alias,
         CAST(c_custkey AS BIGINT) AS id_usuario FROM customer
),
session AS (
  SELECT d.partida AS id_partida, CAST(s.s_nationkey AS INTEGER) AS id_mapa, d.fecha_inicio,
         CASE WHEN d.partida % 366 = (SELECT max(day) FROM ev) THEN NULL ELSE d.fecha_fin END AS fecha_fin,
         CAST(NULL AS VARCHAR) AS configuracion
  FROM (SELECT partida, min(ts) AS fecha_inicio, max(ts) AS fecha_fin FROM ev GROUP BY partida) d
  LEFT JOIN supplier s ON s.s_suppkey = d.partida % (SELECT max(s_suppkey) + 1 FROM supplier)
),
tick_event AS (
  SELECT CAST(event_id AS BIGINT) AS id_evento, partida AS id_partida,
         CAST(user_id AS BIGINT) AS id_jugador, sec AS id_sector, tic,
         CAST(value AS DECIMAL(12,4)) AS pos_x, CAST(k AS DECIMAL(12,4)) AS pos_y,
         CAST(hour AS DECIMAL(12,4)) AS pos_z, CAST(0 AS DECIMAL(8,4)) AS angulo,
         CAST(0 AS DECIMAL(10,4)) AS momentum_x, CAST(0 AS DECIMAL(10,4)) AS momentum_y,
         CAST(0 AS DECIMAL(10,4)) AS momentum_z, CAST(90 AS DECIMAL(6,2)) AS fov,
         k AS salud, 100 AS armadura, CAST(event_id % 50 AS INTEGER) AS municion
  FROM ev
  QUALIFY row_number() OVER (PARTITION BY partida, user_id, tic ORDER BY event_id) = 1
),
participation AS (
  SELECT DISTINCT CAST(id_partida AS BIGINT) * 4294967296 + id_jugador AS id_participante,
         id_partida, id_jugador, CAST(NULL AS VARCHAR) AS rol FROM tick_event
),
instrument AS (
  SELECT 1 AS id_instrumento, 'UX_SURVEY' AS nombre, CAST(NULL AS VARCHAR) AS descripcion
),
survey_item AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id_item, n_name AS texto_pregunta,
         'region_' || CAST(n_regionkey AS VARCHAR) AS dimension, 1 AS id_instrumento FROM nation
),
survey_response AS (
  SELECT CAST(event_id AS BIGINT) AS id_respuesta, ts AS fecha_respuesta,
         CAST(user_id AS BIGINT) AS id_usuario, CAST(k % 25 AS BIGINT) AS id_item,
         1 AS id_instrumento, partida AS id_partida,
         TRY_CAST(value AS DECIMAL(5,2)) AS valor_respuesta
  FROM ev
),
preloaded_fact AS (
  SELECT * FROM tick_event WHERE id_partida % 366 * 2 < (SELECT max(day) FROM ev)
),
staging AS (
  SELECT
    CASE WHEN event_id % 31 = 0 THEN NULL
         WHEN event_id % 31 = 1 THEN '  '
         WHEN event_id % 31 = 2 THEN '0' || CAST(partida AS VARCHAR)
         WHEN event_id % 61 = 7 THEN '2147483647'
         ELSE CAST(partida AS VARCHAR) END AS raw_id_partida,
    CASE WHEN event_id % 37 = 0 THEN '12x'
         WHEN event_id % 41 = 0 THEN '9000000000000000000'
         ELSE CAST(user_id AS VARCHAR) END AS raw_id_jugador,
    CASE WHEN event_id % 43 = 0 THEN CAST(-tic AS VARCHAR) ELSE CAST(tic AS VARCHAR) END AS raw_tic,
    CAST(CAST(value AS DECIMAL(12,4)) AS VARCHAR) AS raw_pos_x,
    CAST(k AS VARCHAR) AS raw_pos_y,
    CAST(hour AS VARCHAR) AS raw_pos_z,
    '0.0000' AS raw_angulo, '0.0000' AS raw_momentum_x, '0.0000' AS raw_momentum_y,
    '0.0000' AS raw_momentum_z, '90.00' AS raw_fov,
    CASE WHEN event_id % 47 = 0 THEN NULL
         WHEN event_id % 47 = 1 THEN ''
         WHEN event_id % 71 = 0 THEN '99999999999'
         ELSE CAST(k AS VARCHAR) END AS raw_salud,
    '100' AS raw_armadura,
    CAST(event_id % 50 AS VARCHAR) AS raw_municion,
    CAST(sec AS VARCHAR) AS raw_id_sector,
    'events' AS archivo_origen,
    ts AS cargado_en
  FROM ev
)"""


def star(extra_ctes: str, select: str) -> str:
    """Prefix a query with the star-schema CTEs (and optional extra CTEs)."""
    extra = f",\n{extra_ctes.strip().rstrip(',')}" if extra_ctes.strip() else ""
    return f"WITH {STAR_CTES.strip()}{extra}\n{select.strip()}"


def div_round(num: str, den: str, scale: int, precision: int = 18) -> str:
    """Exact half-up ROUND(num / den, scale) for integer-valued num/den.

    DuckDB divides decimals in DOUBLE, which rounds ties differently from an
    exact decimal; this keeps the oracle exact with integer arithmetic.
    ``den`` NULL or 0 gives NULL.
    """
    p = 10 ** scale
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(NULLIF(({den}), 0) AS HUGEINT)"
    q = f"(sign({n}) * ((2 * abs({n}) * {p} + {d}) // (2 * {d})))"
    unit = "0." + "0" * (scale - 1) + "1" if scale > 0 else "1"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * {unit} AS DECIMAL({precision},{scale}))"


def dec_avg_round(col: str, col_scale: int, scale: int, precision: int = 18) -> str:
    """Exact half-up ROUND(AVG(col), scale) for a decimal/int column of scale ``col_scale``."""
    f = 10 ** col_scale
    return div_round(f"SUM({col}) * {f}", f"COUNT({col}) * {f}", scale, precision)


def dbl_round(expr: str, scale: int, precision: int = 18) -> str:
    return f"CAST(ROUND({expr}, {scale}) AS DECIMAL({precision},{scale}))"
