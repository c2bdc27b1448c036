"""Per-entity time-series operators (WIN-1, WIN-5, Q3a).

``lag(x) OVER (PARTITION BY entity ORDER BY tick)`` puts a whole entity in one
task. An entity with a third of all rows would then serialize the job, so the
lag is computed in two levels: within fixed tick chunks (many tasks per
entity), and across chunk boundaries from a per-chunk summary (one row per
chunk, so tiny). The result equals the plain window lag when ticks are unique
per entity (the fact's unique key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.functions.geometry import dist3

DEFAULT_CHUNK = 1 << 16


def lag_columns(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str],
                prefix: str = "prev_", chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Add ``prefix+c`` = previous row's ``c`` per ``keys`` ordered by integer ``order``."""
    keys = list(keys)
    d = df.withColumn("__chunk", F.floor(F.col(order) / F.lit(chunk)).cast("long"))
    w = Window.partitionBy(*keys, "__chunk").orderBy(order)        # one named window (WIN-5)
    d = d.select("*", F.lag(order).over(w).alias("__prev_order"),
                 *[F.lag(c).over(w).alias(f"__in_{c}") for c in cols])
    # Last row of every chunk, then the previous chunk's last row.
    last = (d.groupBy(*keys, "__chunk")
            .agg(F.max_by(F.struct(*cols), F.col(order)).alias("__last")))
    w2 = Window.partitionBy(*keys).orderBy("__chunk")
    prev_last = last.select(*keys, "__chunk", F.lag("__last").over(w2).alias("__carry"))
    d = d.join(prev_last, on=[*keys, "__chunk"], how="left")
    first = F.col("__prev_order").isNull()
    out = d.select(*df.columns, *[
        F.when(first, F.col(f"__carry.{c}")).otherwise(F.col(f"__in_{c}")).alias(prefix + c)
        for c in cols])
    return out


def step_distances(events: DataFrame, keys: Sequence[str] = ("id_jugador", "id_partida"),
                   order: str = "tic", pos: Sequence[str] = ("pos_x", "pos_y", "pos_z"),
                   chunk: int = DEFAULT_CHUNK, out: str = "dist_al_anterior") -> DataFrame:
    """Distance from each row to the previous row of its entity (NULL on the first row)."""
    d = lag_columns(events.select(*keys, order, *pos), keys, order, pos, chunk=chunk)
    a = tuple(F.col(f"prev_{c}") for c in pos)
    b = tuple(F.col(c) for c in pos)
    return d.select(*keys, order, dist3(a, b).alias(out))


def path_length(events: DataFrame, keys: Sequence[str] = ("id_jugador", "id_partida"),
                order: str = "tic", pos: Sequence[str] = ("pos_x", "pos_y", "pos_z"),
                chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Per entity: ``steps_sum`` (sum of non-NULL step distances, NULL if none) and ``n_rows``.

    Steps inside a tick chunk are summed right after the chunk-local lag (the
    aggregate reuses the window's partitioning: no extra shuffle); the one
    step that crosses into each chunk comes from a per-chunk summary (first
    and last position), so no row is joined back.
    """
    keys = list(keys)
    d = events.select(*keys, order, *pos).withColumn(
        "__chunk", F.floor(F.col(order) / F.lit(chunk)).cast("long"))
    w = Window.partitionBy(*keys, "__chunk").orderBy(order)
    step = dist3(tuple(F.lag(c).over(w) for c in pos), tuple(F.col(c) for c in pos))
    d = d.select(*keys, "__chunk", order, *pos, step.alias("__step"))
    # Per-coordinate min_by/max_by keep fixed-width buffers: a hash aggregate.
    per_chunk = d.groupBy(*keys, "__chunk").agg(
        F.sum("__step").alias("__inner"), F.count(order).alias("__n"),
        *[F.min_by(c, F.col(order)).alias(f"__first_{c}") for c in pos],
        *[F.max_by(c, F.col(order)).alias(f"__last_{c}") for c in pos])
    w2 = Window.partitionBy(*keys).orderBy("__chunk")
    cross = dist3(tuple(F.lag(f"__last_{c}").over(w2) for c in pos),
                  tuple(F.col(f"__first_{c}") for c in pos))
    per_chunk = per_chunk.select(*keys, "__inner", "__n", cross.alias("__cross"))
    g = per_chunk.groupBy(*keys).agg(F.sum("__inner").alias("__i"), F.sum("__cross").alias("__c"),
                                     F.sum("__n").alias("n_rows"))
    total = F.when(F.col("__i").isNull() & F.col("__c").isNull(), F.lit(None)) \
        .otherwise(F.coalesce("__i", F.lit(0)) + F.coalesce("__c", F.lit(0))).cast("decimal(28,6)")
    return g.select(*keys, total.alias("steps_sum"), "n_rows")


def gap_intervals(events: DataFrame, keys: Sequence[str] = ("id_partida", "id_jugador"), order: str = "tic",
                  chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Rows (keys..., lo, hi): each run of integers missing between two neighbouring values of an entity.

    Gaps and islands in two levels, as in ``lag_columns``: neighbours inside a
    tick chunk are compared in a window over the chunk, neighbours across
    chunks by one row a chunk. Repeated values make no gap.
    """
    keys = list(keys)
    at = F.col(order).cast("long")
    d = events.select(*keys, at.alias("__at"), F.floor(at / F.lit(chunk)).alias("__chunk")).filter(F.col("__at").isNotNull())
    before = F.lag("__at").over(Window.partitionBy(*keys, "__chunk").orderBy("__at"))
    inside = d.select(*keys, before.alias("__before"), "__at")
    ends = d.groupBy(*keys, "__chunk").agg(F.min("__at").alias("__at"), F.max("__at").alias("__last"))
    carried = F.lag("__last").over(Window.partitionBy(*keys).orderBy("__chunk"))
    across = ends.select(*keys, carried.alias("__before"), "__at")
    return (inside.unionByName(across).filter(F.col("__at") - F.col("__before") > 1)
            .select(*keys, (F.col("__before") + 1).alias("lo"), (F.col("__at") - 1).alias("hi")))
