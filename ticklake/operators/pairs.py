"""Pair operators over simultaneous events (JN-3, JN-4, FLT-8).

``pair_proximity`` finds unordered pairs of entities within a radius at the
same instant. A brute-force self-join on (session, tick) is quadratic in the
entities per instant; the grid variant joins on (session, tick, cell) with
cells a few radii wide, so only entities in the same or neighbouring cells
meet. Each point is sent to its own cell and to those "forward" neighbours
(half of them) whose border it is within one radius of, which finds every
unordered pair exactly once: pairs inside one cell are oriented by ``a < b``,
pairs across cells are oriented afterwards. The grid covers the first
``grid_axes`` coordinates (2 = the map plane, 3 = full space); the exact 3-D
test runs on every candidate. In a plane grid a cell of more than CROWD points
is cut along the height too, with a border strip of its own: points over each
other are no candidates. Then candidates are in proportion to near pairs
however crowded a cell is: a cell of 3 x 3 x 3 radii has 6^3 parts whose points
are all near each other, so n points have some n^2 / 432 near pairs at least.

Distances are tested exactly: positions are scaled to integer units of the
decimal scale and squared in 64-bit integers, guarded so no square is formed
for a coordinate gap larger than the radius (no overflow, no BigDecimal).

``co_presence`` pairs entities sharing an exact key (session, tick, place), a
row for each shared tick. ``co_presence_bits`` counts shared ticks without
those rows: an entity's ticks at a place are bits of longs, WIDTH ticks each,
and pairs are joined on (session, place, tick bucket) with the AND of their
bits. An OR of such bits merges ticks (equal names), a bit count counts them.
Hot join keys are split by AQE's skew-join handling: both operators are plain
equi-joins whose shuffles the planner inserts, so ``spark.sql.adaptive.skewJoin``
can split an oversized (session, tick, cell) partition across tasks. (A
user ``repartition`` would pin the partitioning and switch that off.)
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.geometry import STEP


def forward_offsets(axes: int) -> list[tuple[int, ...]]:
    """Neighbour offsets lexicographically >= 0: the cell itself and half of the others."""
    return [o for o in product((-1, 0, 1), repeat=axes) if o >= (0,) * axes]


# Points of a plane cell from which on it is cut along the height.
CROWD = 256


def _units(c: str, scale: int) -> Column:
    """Exact integer value of a DECIMAL(p<=15, scale) column in units of 10^-scale.

    Through a double: |value| < 2^53 units keeps every unit exact, and the
    rounding error of the scaling is far below half a unit.
    """
    return F.rint(F.col(c).cast("double") * F.lit(float(10 ** scale))).cast("long")


def pair_proximity(events: DataFrame, instant: Sequence[str] = ("id_partida", "tic"),
                   entity: str = "id_jugador", pos: Sequence[str] = ("pos_x", "pos_y", "pos_z"),
                   radius=50, grid: bool = True, grid_axes: int = 2, scale: int = 4,
                   carry: Sequence[str] = (), cell_factor: int = 3, crowd: int = CROWD) -> DataFrame:
    """Rows (instant..., a, b, dist, carried a_*/b_* columns) for a < b within ``radius``.

    ``scale`` is the decimal scale of the position columns; ``carry`` lists
    per-event columns to bring along for both sides (e.g. names). Cells are
    ``cell_factor`` radii wide; a point is copied to a forward neighbour cell
    only when it lies within one radius of the shared border, so the expected
    number of copies per point is 1 + 2p + 2p^2 with p = 1/factor in the plane
    (5 for factor 1, 2.5 for 2, ~1.9 for the default 3) while a cell covers
    factor^2 times the area: fewer shuffled bytes, more in-cell tests.
    """
    instant, carry = list(instant), list(carry)
    r_units = int(Decimal(str(radius)) * (10 ** scale))
    j = proximity_candidates(events, instant, entity, pos, r_units, grid, grid_axes, scale, carry, cell_factor, crowd)
    # Exact test in integer units; no square is formed for a gap > radius.
    gaps = [F.col(f"b{i}") - F.col(f"a{i}") for i in range(3)]
    close = F.abs(gaps[0]) <= r_units
    for g in gaps[1:]:
        close = close & (F.abs(g) <= r_units)
    sq = F.when(close, gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2])
    swap = F.col("e1") > F.col("e2")
    out = j.select(*instant,
                   F.least("e1", "e2").alias("a"), F.greatest("e1", "e2").alias("b"),
                   *[F.when(swap, F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).alias(f"a_{c}") for c in carry],
                   *[F.when(swap, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(f"b_{c}") for c in carry],
                   sq.alias("sq_units"))
    return (out.filter(F.col("sq_units") <= F.lit(r_units * r_units))
            .withColumn("dist", F.sqrt(F.col("sq_units").cast("double") / F.lit(float(10 ** (2 * scale)))).cast(STEP))
            .drop("sq_units"))


def proximity_candidates(events: DataFrame, instant: list[str], entity: str, pos: Sequence[str], r_units: int, grid: bool,
                         grid_axes: int, scale: int, carry: list[str], cell_factor: int, crowd: int) -> DataFrame:
    """Pairs (e1, e2) of an instant that may be within the radius, each once, with their positions in units."""
    base = events.select(*instant, entity, *carry,
                         *[_units(p, scale).alias(f"u{i}") for i, p in enumerate(pos)])
    base = base.filter(F.col("u0").isNotNull() & F.col("u1").isNotNull() & F.col("u2").isNotNull())

    def side(df, tag, ent):
        return df.select(*instant, F.col(entity).alias(ent),
                         *[F.col(c).alias(f"{tag}_{c}") for c in carry],
                         *[F.col(f"u{i}").alias(f"{tag}{i}") for i in range(3)])

    if not grid:
        j = side(base, "a", "e1").join(side(base, "b", "e2"), on=instant) \
            .filter(F.col("e1") < F.col("e2"))
    else:
        size = r_units * cell_factor
        cells = [F.floor(F.col(f"u{i}") / F.lit(size)).cast("long").alias(f"c{i}")
                 for i in range(grid_axes)]
        pts = base.select("*", *cells)
        offs = F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(o)])
                         for o in forward_offsets(grid_axes)])
        # Offset to a neighbour only if the point is within one radius of that border.
        frac = [F.col(f"u{i}") - F.col(f"c{i}") * F.lit(size) for i in range(grid_axes)]

        def reaches(o):
            ok = F.lit(True)
            for i in range(grid_axes):
                d = o[f"d{i}"]
                ok = ok & ((d == 0) | ((d == 1) & (frac[i] >= size - r_units))
                           | ((d == -1) & (frac[i] < r_units)))
            return ok
        a = (pts.select("*", F.explode(F.filter(offs, reaches)).alias("o"))
             .select("*", *[(F.col(f"c{i}") + F.col(f"o.d{i}")).alias(f"k{i}") for i in range(grid_axes)],
                     F.expr(" AND ".join(f"o.d{i} = 0" for i in range(grid_axes))).alias("same")))
        b = pts.select("*", *[F.col(f"c{i}").alias(f"k{i}") for i in range(grid_axes)])
        keys = [f"k{i}" for i in range(grid_axes)]
        if grid_axes == 2:
            a, b = _cut_by_height(a, b, [*instant, *keys], size, r_units, crowd)
            keys.append("kz")
        sa = a.select(*instant, F.col(entity).alias("e1"), *[F.col(c).alias(f"a_{c}") for c in carry],
                      *[F.col(f"u{i}").alias(f"a{i}") for i in range(3)], *keys, "same")
        sb = b.select(*instant, F.col(entity).alias("e2"), *[F.col(c).alias(f"b_{c}") for c in carry],
                      *[F.col(f"u{i}").alias(f"b{i}") for i in range(3)], *keys)
        j = (sa.join(sb, on=[*instant, *keys])
             .filter((~F.col("same") & (F.col("e1") != F.col("e2"))) | (F.col("e1") < F.col("e2"))))
    return j


def _cut_by_height(a: DataFrame, b: DataFrame, cell: list[str], size: int, r_units: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``kz``: the height cell where a plane cell is crowded, else 0.

    A point goes to a neighbouring height cell only within one radius of its
    border: upwards from its own plane cell, so that a pair meets once, and both
    ways in the others.
    """
    # Looked up by a hash of the cell: rows so joined are dealt anew for the join of
    # both sides, where a hot cell can be split. Cells of one hash count together.
    a, b = (x.withColumn("cell", F.xxhash64(*cell)) for x in (a, b))
    crowded = b.groupBy("cell").count().filter(F.col("count") > crowd).select("cell", F.lit(True).alias("dense"))
    height = F.floor(F.col("u2") / F.lit(size)).cast("long")
    inside = F.col("u2") - height * F.lit(size)
    up, down = F.when(inside >= size - r_units, F.lit(1)), F.when((inside < r_units) & ~F.col("same"), F.lit(-1))
    steps = F.when(F.col("dense"), F.filter(F.array(F.lit(0), up, down), lambda s: s.isNotNull())).otherwise(F.array(F.lit(0)))
    kz = F.when(F.col("dense"), height).otherwise(F.lit(0))
    a = (a.join(crowded, "cell", "left").withColumn("step", F.explode(steps))
         .withColumn("kz", kz + F.col("step")).withColumn("same", F.col("same") & (F.col("step") == 0)).drop("dense", "step"))
    return a, b.join(crowded, "cell", "left").withColumn("kz", kz).drop("dense")


def co_presence(events: DataFrame, instant: Sequence[str] = ("id_partida", "tic"),
                place: str = "id_sector", entity: str = "id_jugador",
                carry: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Rows (instant..., place, a, b, a_*/b_* carried) for a < b at the same place.

    NULL places never pair. Input rows are made distinct on
    (instant, place, entity, carry) first, so a pair is emitted at most once
    per instant and place; ``unique`` says that a key of the input guarantees
    it, which saves a shuffle of the input.
    """
    instant, carry = list(instant), list(carry)
    base = events.select(*instant, place, entity, *carry).filter(F.col(place).isNotNull())
    if not unique:
        base = base.dropDuplicates([*instant, place, entity, *carry])
    a = base.select(*instant, place, F.col(entity).alias("a"), *[F.col(c).alias(f"a_{c}") for c in carry])
    b = base.select(*instant, place, F.col(entity).alias("b"), *[F.col(c).alias(f"b_{c}") for c in carry])
    return a.join(b, on=[*instant, place]).filter(F.col("a") < F.col("b"))


# Ticks in one long of presence bits.
WIDTH = 64


def presence_bits(events: DataFrame, session: str = "id_partida", tick: str = "tic", place: str = "id_sector",
                  entity: str = "id_jugador", carry: Sequence[str] = (), width: int = WIDTH) -> DataFrame:
    """Rows (session, place, entity, carry..., bucket, bits): bit ``i`` stands for tick ``bucket * width + i``.

    Rows without a place or tick are nowhere. The bits are combined map-side:
    a run of ticks at one place becomes a row for ``width`` ticks.
    """
    if not 0 < width <= 64 or width & (width - 1):
        raise ValueError("width must be a power of two up to 64")
    at = F.col(tick)
    bucket = F.shiftright(at.cast("long"), width.bit_length() - 1).alias("bucket")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int").bitwiseAND(F.lit(width - 1)))
    return (events.filter(F.col(place).isNotNull() & at.isNotNull())
            .groupBy(session, place, entity, *carry, bucket).agg(F.bit_or(bit).alias("bits")))


def co_presence_bits(events: DataFrame, session: str = "id_partida", tick: str = "tic", place: str = "id_sector",
                     entity: str = "id_jugador", carry: Sequence[str] = (), width: int = WIDTH) -> DataFrame:
    """Rows (session, place, bucket, a, b, a_*/b_* carried, shared) for a < b with a common tick at a place.

    ``shared`` holds the common ticks of the bucket as bits: at most one row a
    pair and ``width`` ticks, however many of them are shared. Pairs of a bucket
    without a common tick are tested in the join and make no row; where ticks
    are sparse a smaller ``width`` tests fewer of them.
    """
    keys, carry = [session, place, "bucket"], list(carry)
    bits = presence_bits(events, session, tick, place, entity, carry, width)
    a = bits.select(*keys, F.col(entity).alias("a"), F.col("bits").alias("a_bits"), *[F.col(c).alias(f"a_{c}") for c in carry])
    b = bits.select(*keys, F.col(entity).alias("b"), F.col("bits").alias("b_bits"), *[F.col(c).alias(f"b_{c}") for c in carry])
    shared = F.col("a_bits").bitwiseAND(F.col("b_bits"))
    return (a.join(b, keys).filter((F.col("a") < F.col("b")) & (shared != 0))
            .withColumn("shared", shared).drop("a_bits", "b_bits"))
