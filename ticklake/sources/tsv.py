"""SRC-1: land tab-separated telemetry files as an all-text staging table.

Read as plain text and split with limit -1, not with the CSV reader: the CSV
reader turns empty fields into NULL, honours quotes and pads short rows
(trap T1), which would move rows between reject reasons. A line with the
wrong number of fields is kept and classified BAD_COLUMN_COUNT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas as S

NULL_MARKER = r"\N"      # fixed value: the text-format NULL marker
HEADER = "\t".join(f.removeprefix("raw_") for f in S.RAW_FIELDS)

# Text-format escapes inside a field (escape letter -> character).
ESCAPES = [("b", "\b"), ("f", "\f"), ("n", "\n"), ("r", "\r"), ("t", "\t"), ("v", "\v")]


def decode_field(c: Column) -> Column:
    r"""Undo text-format escaping: ``\N`` alone is NULL, ``\\`` is a backslash,
    the letters of ESCAPES are control characters, and any other character
    behind a backslash is itself (but for digits and ``x``: octal and hex codes
    stay as they are, so their line is rejected and logged). The field is split
    on escaped backslashes first, so ``\\n`` stays a backslash plus ``n``."""
    def unescape(part):
        for letter, char in ESCAPES:
            part = F.regexp_replace(part, "\\\\" + letter, F.lit(char))
        return F.regexp_replace(part, r"\\([^0-7x])", "$1")
    decoded = F.array_join(F.transform(F.split(c, r"\\\\", -1), unescape), "\\")
    return F.when(c == F.lit(NULL_MARKER), F.lit(None).cast("string")).otherwise(decoded)


def encode_field(c: Column) -> Column:
    r"""Text-format escaping of one field (NULL -> ``\N``)."""
    out = F.regexp_replace(c, r"\\", r"\\\\")
    for letter, char in ESCAPES:
        out = F.regexp_replace(out, char, "\\\\" + letter)
    return F.coalesce(out, F.lit(NULL_MARKER))


def read_staging(spark: SparkSession, path: str, loaded_at: Column | None = None,
                 header: str | None = HEADER) -> DataFrame:
    """Return staging rows: 15 raw text fields, origin file, load time, row id, column-count flag.

    The header is dropped: a line that equals ``header`` as a whole, in the
    first block of its file. Any other line is data, also one whose first field
    is a column name; it is classified and logged. ``_row_id`` is unique and
    stable for a given input listing; the loader persists staging before
    classifying, which fixes it.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("archivo_origen"),
                                       F.col("_metadata.file_block_start").alias("block_start"))
    return parse_lines(raw, loaded_at, header)


def parse_lines(raw: DataFrame, loaded_at: Column | None = None, header: str | None = HEADER) -> DataFrame:
    """Split ``value`` lines (with ``archivo_origen``, ``block_start``) into staging rows; batch or streaming."""
    parts = F.split(F.col("value"), "\t", -1)
    fields = [decode_field(F.get(parts, i)).alias(f) for i, f in enumerate(S.RAW_FIELDS)]
    is_header = F.lit(False) if header is None else (F.col("value") == F.lit(header)) & (F.col("block_start") == 0)
    return (raw.filter(~is_header)
            .select(*fields, "archivo_origen",
                    (loaded_at if loaded_at is not None else F.localtimestamp()).alias("cargado_en"),
                    F.monotonically_increasing_id().alias("_row_id"),
                    (F.size(parts) == len(S.RAW_FIELDS)).alias("_ncols_ok")))


def write_tsv(df: DataFrame, path: str) -> None:
    """Write staging-shaped rows as TSV with header (test fixtures, exports)."""
    line = F.concat_ws("\t", *[encode_field(F.col(f)) for f in S.RAW_FIELDS])
    (df.select(line.alias("value")).write.mode("overwrite")
     .option("header", "false").text(path))
