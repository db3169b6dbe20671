"""Every registered query of the library, with the SQL that it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import registry
from tessera.plans import agreement, boards, candidates, coverage, files, more, neighbours, order, reads, rebuilt, recommend, references, records, resampling, rest, sequence, strata, streams, variants  # noqa: F401  they register their queries

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
