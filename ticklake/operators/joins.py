"""Join operators (JN-*).

Dimension joins carry no broadcast hints: the planner broadcasts a side only
when its size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and
AQE re-checks the measured size at runtime; anything larger stays a
sort-merge join. Scalars (one-row aggregates) are attached as scalar
subqueries, which run once and are inlined as a value - no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_chain(fact: DataFrame, *steps: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Inner equi-join a fact to a chain of dimensions (JN-1, JN-2)."""
    out = fact
    for dim, on in steps:
        out = out.join(dim, on=on if isinstance(on, str) else list(on), how="inner")
    return out


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """EXISTS on the key(s) (JN-10, JN-14)."""
    return df.join(other, on=on, how="left_semi")


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """NOT EXISTS on the key(s) (JN-11); NULL keys never match, so they are kept."""
    return df.join(other, on=on, how="left_anti")


def existence_flag(df: DataFrame, other: DataFrame, left_keys: Sequence[str],
                   right_keys: Sequence[str], name: str) -> DataFrame:
    """Add boolean ``name`` = EXISTS(other with matching keys) (JN-13).

    A left join against the distinct key set of ``other``; usable under OR,
    where a semi join is not.
    """
    keys = other.select(*[F.col(r).alias(f"__{name}_{i}") for i, r in enumerate(right_keys)]) \
        .distinct().withColumn(f"__{name}_hit", F.lit(True))
    cond = [F.col(l) == F.col(f"__{name}_{i}") for i, l in enumerate(left_keys)]
    joined = df.join(keys, on=cond, how="left")
    return joined.withColumn(name, F.coalesce(F.col(f"__{name}_hit"), F.lit(False))) \
        .drop(*[f"__{name}_{i}" for i in range(len(right_keys))], f"__{name}_hit")


def with_scalar(df: DataFrame, one_row: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Attach the single value of a one-row aggregate as a column (JN-6)."""
    return df.withColumn(alias or column, one_row.select(column).scalar())


def scalar(one_row: DataFrame, column: str) -> Column:
    """The value of a one-row aggregate as a Column for predicates (JN-7)."""
    return one_row.select(column).scalar()
