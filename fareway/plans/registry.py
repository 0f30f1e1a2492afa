"""Registry of named queries and their independent oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators. The oracle is DuckDB SQL over the same parquet tables
(prefixed with the fixture CTEs), written independently from the Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareway.plans.fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None, extra_ctes: str = ""):
    """Register ``fn`` under ``key``; ``oracle`` is the SQL body after the
    fixture CTEs (None: no SQL form, rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_fixtures(oracle, extra_ctes)
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module so their queries register."""
    from fareway.plans import (  # noqa: F401
        catalog_batch,
        catalog_loads,
        catalog_models,
        catalog_quality,
        catalog_stream,
    )
