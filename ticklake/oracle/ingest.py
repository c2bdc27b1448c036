"""DuckDB SQL for the validating load: every test of a line as a column of one
table, from which the log and the accepted rows are read, including the
documented divergences: OVERFLOW instead
of an abort, UNCLASSIFIED for rows no step selects, and a total order (load
time, origin, raw line) for the first row per key."""

from __future__ import annotations

from ticklake.oracle.prelude import star

U, I, D = r"'^\d+$'", r"'^-?\d+$'", r"'^-?\d+(\.\d+)?$'"
MAND = [("raw_id_partida", U, "INTEGER"), ("raw_id_jugador", U, "BIGINT"), ("raw_tic", I, "INTEGER"),
        ("raw_salud", I, "INTEGER"), ("raw_armadura", I, "INTEGER"), ("raw_municion", I, "INTEGER"),
        ("raw_pos_x", D, "DECIMAL(12,4)"), ("raw_pos_y", D, "DECIMAL(12,4)"),
        ("raw_pos_z", D, "DECIMAL(12,4)"), ("raw_momentum_x", D, "DECIMAL(10,4)"),
        ("raw_momentum_y", D, "DECIMAL(10,4)"), ("raw_momentum_z", D, "DECIMAL(10,4)")]
OPT = [("raw_fov", D, "DECIMAL(6,2)"), ("raw_angulo", D, "DECIMAL(8,4)"), ("raw_id_sector", U, "BIGINT")]
RAW = ["raw_id_partida", "raw_id_jugador", "raw_tic", "raw_pos_x", "raw_pos_y", "raw_pos_z",
       "raw_angulo", "raw_momentum_x", "raw_momentum_y", "raw_momentum_z", "raw_fov",
       "raw_salud", "raw_armadura", "raw_municion", "raw_id_sector"]


def _blank(c):
    return f"({c} IS NULL OR trim({c}) = '')"


MISSING = " OR ".join(_blank(c) for c in ("s.raw_id_partida", "s.raw_id_jugador", "s.raw_tic"))
BAD = " OR ".join([f"NOT regexp_matches(s.{c}, {p})" for c, p, _ in MAND] +
                  [f"(NOT {_blank('s.' + c)} AND NOT regexp_matches(s.{c}, {p}))" for c, p, _ in OPT])
VALID = " AND ".join([f"regexp_matches(s.{c}, {p})" for c, p, _ in MAND] +
                     [f"({_blank('s.' + c)} OR regexp_matches(s.{c}, {p}))" for c, p, _ in OPT])
FITS = " AND ".join([f"TRY_CAST(s.{c} AS {t}) IS NOT NULL" for c, _, t in MAND] +
                    [f"({_blank('s.' + c)} OR TRY_CAST(s.{c} AS {t}) IS NOT NULL)" for c, _, t in OPT])
RANGE_OK = ("TRY_CAST(s.raw_tic AS INTEGER) >= 0 AND TRY_CAST(s.raw_salud AS INTEGER) >= 0 "
            "AND TRY_CAST(s.raw_armadura AS INTEGER) >= 0 AND TRY_CAST(s.raw_municion AS INTEGER) >= 0")
SID, PID, TIC = ("TRY_CAST(s.raw_id_partida AS INTEGER)", "TRY_CAST(s.raw_id_jugador AS BIGINT)",
                 "TRY_CAST(s.raw_tic AS INTEGER)")
SEC = "TRY_CAST(s.raw_id_sector AS BIGINT)"
SECTOR_BLANK = _blank("s.raw_id_sector")

# One row per staged line with every test as a column; the reason is the first
# test that fails, and lines without a reason compete for their key.
STEPS = f"""
flags AS (
  SELECT s.*, concat_ws(chr(9), {", ".join("s." + c for c in RAW)}) AS linea,
         {SID} AS k_partida, {PID} AS k_jugador, {TIC} AS k_tic,
         ({MISSING}) AS is_missing, coalesce({BAD}, FALSE) AS is_bad, coalesce({VALID}, FALSE) AS is_valid,
         ({FITS}) AS does_fit, ({RANGE_OK}) AS in_range,
         j.id_jugador IS NOT NULL AS has_player, p.id_partida IS NOT NULL AS has_session,
         {SECTOR_BLANK} OR coalesce(sec.id_mapa = p.id_mapa, FALSE) AS sector_fits, u.consentimiento AS consent
  FROM staging s
  LEFT JOIN player j ON j.id_jugador = {PID}
  LEFT JOIN volunteer u ON u.id_usuario = j.id_usuario
  LEFT JOIN session p ON p.id_partida = {SID}
  LEFT JOIN sector sec ON sec.id_sector = {SEC}),
judged AS (
  SELECT *, CASE WHEN is_missing THEN 'MISSING_KEY' WHEN is_bad THEN 'BAD_TYPE' WHEN NOT is_valid THEN 'UNCLASSIFIED'
                 WHEN NOT does_fit THEN 'OVERFLOW' WHEN NOT in_range THEN 'OUT_OF_RANGE'
                 WHEN NOT has_player THEN 'FK_PLAYER' WHEN NOT has_session THEN 'FK_SESSION'
                 WHEN NOT sector_fits THEN 'FK_SECTOR' WHEN consent IS NULL THEN 'UNCLASSIFIED'
                 WHEN NOT consent THEN 'NO_CONSENT' END AS fault
  FROM flags),
placed AS (
  SELECT judged.*, row_number() OVER (PARTITION BY k_partida, k_jugador, k_tic, fault IS NULL
                                      ORDER BY cargado_en, archivo_origen, linea) AS place,
         core.tic IS NOT NULL AS in_core
  FROM judged LEFT JOIN preloaded_fact core
    ON core.id_partida = k_partida AND core.id_jugador = k_jugador AND core.tic = k_tic),
log AS (
  SELECT archivo_origen, linea, cargado_en, fault AS motivo FROM placed WHERE fault IS NOT NULL
  UNION ALL SELECT archivo_origen, linea, cargado_en, 'DUP_BATCH' FROM placed WHERE fault IS NULL AND place > 1
  UNION ALL SELECT archivo_origen, linea, cargado_en, 'DUP_CORE' FROM placed WHERE fault IS NULL AND in_core),
accepted AS (
  SELECT k_partida AS id_partida, k_jugador AS id_jugador,
         TRY_CAST(NULLIF(trim(raw_id_sector), '') AS BIGINT) AS id_sector, k_tic AS tic,
         {", ".join(f"TRY_CAST(NULLIF(trim({c}), '') AS {t}) AS {c[4:]}" for c, t in (
             ("raw_pos_x", "DECIMAL(12,4)"), ("raw_pos_y", "DECIMAL(12,4)"), ("raw_pos_z", "DECIMAL(12,4)"),
             ("raw_angulo", "DECIMAL(8,4)"), ("raw_momentum_x", "DECIMAL(10,4)"), ("raw_momentum_y", "DECIMAL(10,4)"),
             ("raw_momentum_z", "DECIMAL(10,4)"), ("raw_fov", "DECIMAL(6,2)"), ("raw_salud", "INTEGER"),
             ("raw_armadura", "INTEGER"), ("raw_municion", "INTEGER")))}
  FROM placed WHERE fault IS NULL AND place = 1 AND NOT in_core)
"""


def _reason(code: str) -> str:
    return star(STEPS, f"SELECT archivo_origen AS origen, linea AS linea_raw, motivo FROM log "
                       f"WHERE motivo = '{code}'")


SQL = {f"etl_{c.lower()}": _reason(c) for c in
       ("MISSING_KEY", "BAD_TYPE", "OVERFLOW", "OUT_OF_RANGE", "FK_PLAYER", "FK_SESSION",
        "FK_SECTOR", "NO_CONSENT", "DUP_BATCH", "DUP_CORE", "UNCLASSIFIED")}
SQL["etl_reject_log"] = star(STEPS, "SELECT archivo_origen AS origen, linea AS linea_raw, motivo FROM log")
SQL["etl_accept"] = star(STEPS, "SELECT * FROM accepted")
SQL["etl_summary"] = star(STEPS, """
SELECT 'total_staging' AS metrica, COUNT(*) AS cantidad FROM staging
UNION ALL SELECT 'total_core_acumulado', (SELECT COUNT(*) FROM preloaded_fact) + (SELECT COUNT(*) FROM accepted)
UNION ALL SELECT motivo, COUNT(*) FROM log GROUP BY motivo
ORDER BY cantidad DESC, metrica""")
SQL["topk_recent_rejects"] = star(STEPS, """
SELECT row_number() OVER (ORDER BY cargado_en, archivo_origen, linea, motivo) AS id_log, archivo_origen AS origen, motivo,
       cargado_en AS registrado_en
FROM log ORDER BY registrado_en DESC, id_log DESC LIMIT 10""")
