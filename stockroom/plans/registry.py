"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Each entry wires the fixture views of one scale-factor directory into one
operator. The operator modules register themselves through ``query``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockroom.sources.fixtures import Fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    """Register ``fn(fixtures) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixtures(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return wrap


def all_queries() -> dict[str, QueryFn]:
    # importing the wiring modules fills QUERIES
    from stockroom.plans import wiring  # noqa: F401

    return dict(QUERIES)
