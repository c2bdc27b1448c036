"""Integer series per row (SRC-4, JN-8): ``generate_series(lo, hi)`` as rows.

A data-derived range can be arbitrarily long, and ``explode(sequence(lo, hi))``
would build it as one array in one task. The range is first cut into chunks
of at most ``chunk`` values (one row per chunk), the chunk rows are spread by a
shuffle, and each chunk is then expanded on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK = 4096


def series(df: DataFrame, keys: Sequence[str], lo: str, hi: str, out: str = "tic",
           chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Rows (keys..., out) for every integer in [lo, hi] of each input row."""
    keys = list(keys)
    c = F.lit(chunk)
    starts = (df.select(*keys, F.col(lo).cast("long").alias("__lo"), F.col(hi).cast("long").alias("__hi"))
              .filter(F.col("__lo") <= F.col("__hi"))
              .select("*", F.explode(F.sequence(F.floor(F.col("__lo") / c), F.floor(F.col("__hi") / c)))
                      .alias("__c")))
    spread = starts.repartition(*keys, "__c")
    first = F.greatest(F.col("__lo"), F.col("__c") * c)
    last = F.least(F.col("__hi"), F.col("__c") * c + c - 1)
    return (spread.select(*keys, F.explode(F.sequence(first, last)).alias("__v"))
            .select(*keys, F.col("__v").cast("int").alias(out)))
