"""Text predicates and rebuilders used by the validating loader."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three field formats accepted by the loader (unsigned
# integer, signed integer, signed decimal). Anchored with \A ... \z because
# Java's `$` also matches before a final newline (trap T2).
UINT = r"\A\d+\z"
INT = r"\A-?\d+\z"
DEC = r"\A-?\d+(\.\d+)?\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c) -> Column:
    """NULL or empty after trimming spaces (FLT-1). Never NULL itself."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def not_blank(c) -> Column:
    return ~blank(c)


def matches(c, pattern: str) -> Column:
    """Regex test (FLT-2); NULL input stays NULL so three-valued logic is kept (T3)."""
    return _c(c).rlike(pattern)


def typed_or_null(c, spark_type: str) -> Column:
    """`NULLIF(TRIM(c), '')` then a non-raising cast (PRJ-4, FN-2, FN-5, FN-6)."""
    return F.nullif(F.trim(_c(c)), F.lit("")).try_cast(spark_type)


def raw_line(fields: list[str], sep: str = "\t") -> Column:
    """Rebuild a raw line from text fields; NULL fields are skipped like concat_ws (PRJ-5)."""
    return F.concat_ws(sep, *[F.col(f) for f in fields])
