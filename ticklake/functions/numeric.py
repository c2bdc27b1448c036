"""Numeric helpers that keep results exact (decimal) wherever the reference is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c, scale: int, precision: int = 18) -> Column:
    """Half-up ROUND to ``scale`` digits, typed as DECIMAL(precision, scale)."""
    return F.round(_c(c), scale).cast(f"decimal({precision},{scale})")


def avg_exact(c) -> Column:
    """AVG computed in decimal (AGG-6): integer and decimal inputs stay exact."""
    return F.avg(_c(c).cast("decimal(30,6)"))


def ratio_round(num, den, scale: int) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) in decimal arithmetic (AGG-9)."""
    n = _c(num).cast("decimal(30,10)")
    d = F.nullif(_c(den), F.lit(0)).cast("decimal(20,0)")
    return round_to(F.try_divide(n, d), scale)


def epoch_minutes(start, end) -> Column:
    """EXTRACT(EPOCH FROM end - start) / 60 as an exact decimal (FN-14)."""
    micros = (F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp")))
    return micros.cast("decimal(20,0)") / F.lit(60_000_000).cast("decimal(10,0)")


def rint_int(c) -> Column:
    """float -> int rounding half to even, as a server-side ``::int`` does (FN-7, T4)."""
    return F.rint(_c(c)).cast("int")
