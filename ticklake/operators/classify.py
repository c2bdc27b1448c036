"""Single-pass reject classification of staged telemetry lines (ING-1 ... ING-10).

The reference runs nine INSERT ... SELECT statements, each rescanning the
staging table and repeating the validity test. Here one projection computes
every flag, three left joins attach the reference lookups, one aggregate finds
the first row per key, one flag join marks keys already in the fact, and a
single ``when`` chain assigns the reason. Order of the chain = order of the
reference's steps, so the reasons stay mutually exclusive except for the two
duplicate reasons, which can both apply (as in the reference).

Divergences (documented):
* a field that matches its pattern but does not fit its type gets OVERFLOW
  (the reference aborts the whole load);
* a row that no step selects (a mandatory numeric NULL, or a player without
  volunteer) gets UNCLASSIFIED (the reference silently drops it);
* ties on load time are broken by (origin, raw line, row id) - a total order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake import schemas as S
from ticklake.functions.text import DEC, INT, UINT, blank, matches, raw_line

# Reason codes, in the order the checks apply.
MISSING_KEY = "MISSING_KEY"
BAD_TYPE = "BAD_TYPE"
OVERFLOW = "OVERFLOW"
OUT_OF_RANGE = "OUT_OF_RANGE"
FK_PLAYER = "FK_PLAYER"
FK_SESSION = "FK_SESSION"
FK_SECTOR = "FK_SECTOR"
NO_CONSENT = "NO_CONSENT"
DUP_BATCH = "DUP_BATCH"
DUP_CORE = "DUP_CORE"
UNCLASSIFIED = "UNCLASSIFIED"
BAD_COLUMN_COUNT = "BAD_COLUMN_COUNT"
CANDIDATE = "CANDIDATE"

KEY_FIELDS = ("raw_id_partida", "raw_id_jugador", "raw_tic")

# Mandatory fields: (raw field, pattern, target type, typed name).
MANDATORY = [
    ("raw_id_partida", UINT, "int", "id_partida"),
    ("raw_id_jugador", UINT, "bigint", "id_jugador"),
    ("raw_tic", INT, "int", "tic"),
    ("raw_salud", INT, "int", "salud"),
    ("raw_armadura", INT, "int", "armadura"),
    ("raw_municion", INT, "int", "municion"),
    ("raw_pos_x", DEC, "decimal(12,4)", "pos_x"),
    ("raw_pos_y", DEC, "decimal(12,4)", "pos_y"),
    ("raw_pos_z", DEC, "decimal(12,4)", "pos_z"),
    ("raw_momentum_x", DEC, "decimal(10,4)", "momentum_x"),
    ("raw_momentum_y", DEC, "decimal(10,4)", "momentum_y"),
    ("raw_momentum_z", DEC, "decimal(10,4)", "momentum_z"),
]
# Optional fields: checked only when not blank.
OPTIONAL = [
    ("raw_fov", DEC, "decimal(6,2)", "fov"),
    ("raw_angulo", DEC, "decimal(8,4)", "angulo"),
    ("raw_id_sector", UINT, "bigint", "id_sector"),
]
RANGE_CHECKED = ("tic", "salud", "armadura", "municion")
FACT_KEY = ("id_partida", "id_jugador", "tic")
ACCEPTED_COLUMNS = ["id_partida", "id_jugador", "id_sector", "tic", "pos_x", "pos_y", "pos_z",
                    "angulo", "momentum_x", "momentum_y", "momentum_z", "fov",
                    "salud", "armadura", "municion"]


def type_flags(staging: DataFrame) -> DataFrame:
    """Add typed columns and the format flags, in one projection."""
    m = {f: matches(f, p) for f, p, _, _ in MANDATORY}
    o = {f: blank(f) | matches(f, p) for f, p, _, _ in OPTIONAL}
    missing = reduce(or_, [blank(f) for f in KEY_FIELDS])
    # Three-valued on purpose: a NULL mandatory field makes these NULL (T3).
    bad = reduce(or_, [~c for c in (*m.values(), *o.values())])
    valid = reduce(and_, [*m.values(), *o.values()])
    typed = [F.col(f).try_cast(t).alias(n) for f, _, t, n in MANDATORY]
    typed += [F.nullif(F.trim(F.col(f)), F.lit("")).try_cast(t).alias(n) for f, _, t, n in OPTIONAL]
    overflow = reduce(or_, [F.col(f).try_cast(t).isNull() for f, _, t, _ in MANDATORY] +
                      [~blank(f) & F.col(f).try_cast(t).isNull() for f, _, t, _ in OPTIONAL])
    in_range = reduce(and_, [F.col(f).try_cast(t) >= 0
                             for f, _, t, n in MANDATORY if n in RANGE_CHECKED])
    sector_given = matches("raw_id_sector", UINT)
    return staging.select(
        "*", *typed,
        missing.alias("_missing"), bad.alias("_bad"), valid.alias("_valid"),
        overflow.alias("_overflow"), in_range.alias("_in_range"),
        sector_given.alias("_sector_given"),
        raw_line(S.RAW_FIELDS).alias("linea_raw"))


def attach_references(df: DataFrame, player: DataFrame, volunteer: DataFrame,
                      session: DataFrame, sector: DataFrame) -> DataFrame:
    """Left-join the lookups: player (+ consent), session map, sector map (JN-12, JN-15)."""
    pv = (player.select("id_jugador", "id_usuario")
          .join(volunteer.select("id_usuario", "consentimiento"), "id_usuario", "left")
          .select("id_jugador", F.lit(True).alias("_player_ok"), F.col("consentimiento").alias("_consent")))
    ses = session.select(F.col("id_partida"), F.lit(True).alias("_session_ok"),
                         F.col("id_mapa").alias("_session_map"))
    sec = sector.select("id_sector", F.col("id_mapa").alias("_sector_map"))
    out = (df.join(pv, "id_jugador", "left")
           .join(ses, "id_partida", "left")
           .join(sec, "id_sector", "left"))
    return out.withColumn("_sector_in_map",
                          F.coalesce(F.col("_sector_map") == F.col("_session_map"), F.lit(False)))


def primary_reason(df: DataFrame) -> DataFrame:
    """The first failing check, or CANDIDATE, or UNCLASSIFIED."""
    v = F.col("_valid")
    player_ok = F.coalesce(F.col("_player_ok"), F.lit(False))
    session_ok = F.coalesce(F.col("_session_ok"), F.lit(False))
    sector_ok = blank("raw_id_sector") | F.col("_sector_in_map")
    ncols_ok = F.col("_ncols_ok") if "_ncols_ok" in df.columns else F.lit(True)
    reason: Column = (
        F.when(~ncols_ok, F.lit(BAD_COLUMN_COUNT))
        .when(F.col("_missing"), F.lit(MISSING_KEY))
        .when(F.col("_bad"), F.lit(BAD_TYPE))
        .when(v & F.col("_overflow"), F.lit(OVERFLOW))
        .when(v & ~F.col("_in_range"), F.lit(OUT_OF_RANGE))
        .when(v & ~player_ok, F.lit(FK_PLAYER))
        .when(v & ~session_ok, F.lit(FK_SESSION))
        .when(v & F.col("_sector_given") & ~F.col("_sector_in_map"), F.lit(FK_SECTOR))
        .when(v & sector_ok & (F.col("_consent") == F.lit(False)), F.lit(NO_CONSENT))
        .when(v & sector_ok & (F.col("_consent") == F.lit(True)), F.lit(CANDIDATE))
        .otherwise(F.lit(UNCLASSIFIED)))
    return df.withColumn("_reason", reason)


def mark_duplicates(df: DataFrame, fact_keys: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """All rows, with the flags of ``flag_duplicates``; rejected rows pass by unflagged.

    ``df`` is read several times: callers persist it first, so the
    classification runs once.
    """
    cand = F.col("_reason") == F.lit(CANDIDATE)
    rest = df.filter(~F.coalesce(cand, F.lit(False))).withColumn("_dup_batch", F.lit(False)).withColumn("_dup_core", F.lit(False))
    return flag_duplicates(df.filter(cand), fact_keys).select(*rest.columns).unionByName(rest)


def flag_duplicates(own: DataFrame, fact_keys: DataFrame | Sequence[DataFrame], buckets: int | None = None) -> DataFrame:
    """Flag candidates that are not the first of their key (DUP_BATCH) and
    candidates whose key is already in one of the facts (DUP_CORE).

    The earliest load time of a key is a grouped minimum over a fixed-width
    value (a hash aggregate, combined map-side); the whole ordering, raw line
    included, is compared only among rows that tie on it. Both are joined back,
    so a key with a huge number of copies is split by AQE's skew join. Facts
    that are stored in ``buckets`` by the key are not shuffled: the batch's
    keys, one row each, are dealt to as many partitions.
    """
    key = list(FACT_KEY)
    facts = [fact_keys] if isinstance(fact_keys, DataFrame) else list(fact_keys)
    order = F.struct("archivo_origen", "linea_raw", "_row_id")
    earliest = own.groupBy(*key).agg(F.min("cargado_en").alias("_since"), F.count(F.lit(1)).alias("_copies"))
    ties = own.join(earliest, key).filter((F.col("_copies") > 1) & (F.col("cargado_en") == F.col("_since")))
    firsts = ties.groupBy(*key).agg(F.min(order).alias("_first"))
    # One row a key of this batch, with what decides about its copies.
    about = earliest.join(firsts, key, "left").withColumn("_in_core", F.lit(False))
    own_keys = earliest.select(*key)
    if buckets:
        own_keys = own_keys.repartition(buckets, *key)
    for fact in facts:
        there = fact.select(*key).join(own_keys, key, "left_semi").distinct().withColumn("_there", F.lit(True))
        about = about.join(there, key, "left").withColumn(
            "_in_core", F.col("_in_core") | F.coalesce("_there", F.lit(False))).drop("_there")
    late = (F.col("_copies") > 1) & ((F.col("cargado_en") != F.col("_since")) | (order != F.col("_first")))
    return (own.join(about, key).withColumn("_dup_batch", late).withColumn("_dup_core", F.col("_in_core"))
            .drop("_since", "_copies", "_first", "_in_core"))


def classify_primary(staging: DataFrame, player: DataFrame, volunteer: DataFrame,
                     session: DataFrame, sector: DataFrame) -> DataFrame:
    """Format flags, lookups and the primary reason: everything but the duplicate checks."""
    return primary_reason(attach_references(type_flags(staging), player, volunteer, session, sector))


def classify(staging: DataFrame, player: DataFrame, volunteer: DataFrame, session: DataFrame,
             sector: DataFrame, fact: DataFrame) -> DataFrame:
    """Full classification: one row per staging row with ``_reason`` and duplicate flags.

    ``staging`` needs the 15 raw fields, ``archivo_origen``, ``cargado_en`` and
    ``_row_id`` (a unique, stable row id; ``_ncols_ok`` optional).
    """
    d = type_flags(staging)
    d = attach_references(d, player, volunteer, session, sector)
    d = primary_reason(d)
    return mark_duplicates(d, fact)


def duplicate_reasons() -> Column:
    """The duplicate reasons of a flagged candidate; empty for an accepted row."""
    return F.filter(F.array(F.when(F.col("_dup_batch"), F.lit(DUP_BATCH)),
                            F.when(F.col("_dup_core"), F.lit(DUP_CORE))), lambda x: x.isNotNull())


def reject_log(classified: DataFrame, registered_at: Column | None = None,
               batch_id: str = "batch") -> DataFrame:
    """One log row per (rejected row, reason): a candidate can carry both duplicate reasons."""
    primary = F.when(~F.col("_reason").isin(CANDIDATE), F.array(F.col("_reason")))
    reasons = F.coalesce(primary, duplicate_reasons())
    return (classified.select("archivo_origen", "linea_raw", "cargado_en",
                              F.explode(reasons).alias("motivo"))
            .select(F.col("archivo_origen").alias("origen"), "linea_raw", "motivo", "cargado_en",
                    (registered_at if registered_at is not None else F.localtimestamp())
                    .alias("registrado_en"),
                    F.lit(batch_id).alias("id_lote")))


def accepted(classified: DataFrame) -> DataFrame:
    """Typed rows to append: one per key, first in load order, not already in the fact."""
    ok = ((F.col("_reason") == F.lit(CANDIDATE)) & ~F.col("_dup_batch") & ~F.col("_dup_core"))
    return classified.filter(ok).select(*ACCEPTED_COLUMNS)
