"""Registry of every runnable query/operator: name -> (spark builder, oracle SQL).

Each builder takes a ``Warehouse`` bound to a scale-factor directory and
returns a lazy DataFrame; the registry wraps it as ``(spark, sf_dir)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticklake.session import configure
from ticklake.sources.bindings import Warehouse, source_stamp

_WAREHOUSES: dict[tuple[str, str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One bound warehouse per (application, directory, state of its files): its
    DataFrames are immutable plans, so queries share them instead of
    re-deriving the star schema (and re-analysing it) on every call; changed
    source files get a warehouse of their own."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), source_stamp(spark, sf_dir))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(spark, sf_dir)
    return _WAREHOUSES[key]

_BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        _BUILDERS[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def _load():
    # Importing these modules registers their queries.
    from ticklake.plans import catalog  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(warehouse(spark, sf_dir))
        run.__name__ = fn.__name__
        return run
    return {k: bind(v) for k, v in _BUILDERS.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
