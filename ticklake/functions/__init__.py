"""Column-expression helpers: all built-in Spark functions, no UDFs."""

from ticklake.functions.text import (  # noqa: F401
    DEC, INT, UINT, blank, matches, not_blank, raw_line, typed_or_null,
)
from ticklake.functions.numeric import (  # noqa: F401
    avg_exact, epoch_minutes, ratio_round, rint_int, round_to,
)
from ticklake.functions.geometry import dist3, sq_dist3  # noqa: F401
