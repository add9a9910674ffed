"""Everything the driver sees: batch catalogue + streaming replays, and the
oracle SQL for each query that has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import ensure_checkpoint_dir


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalog, catalog_ml, catalog_prep, catalog_stream  # noqa: F401  each registers its queries

    return {k: _wrap(v) for k, v in catalog.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    from . import oracle, oracle_prep, oracle_softmax, oracle_stream  # noqa: F401  each registers its SQL

    qs = all_queries()
    return {k: v for k, v in oracle.ORACLE.items() if k in qs}
