"""3-D distance helpers (FN-10, FN-11, FLT-8).

The squared distance is kept in exact decimal arithmetic so a radius test
``d² <= r²`` has no rounding; the distance itself is a double ``sqrt``, kept
with six decimals so that sums and averages do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Type of a distance that is summed or averaged.
STEP = "decimal(18,6)"


def sq_dist3(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    dx, dy, dz = (b[0] - a[0]), (b[1] - a[1]), (b[2] - a[2])
    return dx * dx + dy * dy + dz * dz


def dist3(a, b) -> Column:
    return F.sqrt(sq_dist3(a, b).cast("double")).cast(STEP)


#: Bits of each coordinate in a Morton key.
MORTON_BITS = 31


def _spread(c: Column) -> Column:
    """The low 31 bits of a long moved to the even places of a long."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def morton_key(x: Column, y: Column, x_bounds: tuple[Column, Column], y_bounds: tuple[Column, Column]) -> Column:
    """The Z-order place of (x, y): bits of both coordinates in turn, each scaled to its (least, greatest) value.

    Points that lie near each other in the plane mostly get near keys, so a
    range of keys is a small area and not a strip. Null coordinates come first.
    """
    def scaled(c, bounds):
        low, high = (b.cast("double") for b in bounds)
        share = F.try_divide(c.cast("double") - low, high - low)
        return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * float(1 << MORTON_BITS)), F.lit((1 << MORTON_BITS) - 1)).cast("long")
    return _spread(scaled(x, x_bounds)).bitwiseOR(F.shiftleft(_spread(scaled(y, y_bounds)), 1))
