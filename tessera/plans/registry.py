"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.views import Views, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a function of Views under a name, with the DuckDB SELECT (and CTEs) that gives the same rows."""

    def register(plan: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: plan(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = duck(sql, ctes)
        return plan

    return register
