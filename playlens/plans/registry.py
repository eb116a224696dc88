"""Named queries: a Spark plan over the test tables plus, where SQL can say it, a DuckDB oracle.

``QUERIES[key] = (build(spark, sf_dir) -> DataFrame, oracle SQL or None)``. Column names and types
match between both sides: counts are BIGINT, shares and scores are DOUBLE rounded to 6 digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, tuple[Builder, str | None]] = {}


def query(key: str, sql: str | None = None):
    """Register ``build(spark, sf_dir)`` under ``key`` with its oracle SQL (None: rows-only check)."""

    def wrap(build: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = (build, sql)
        return build

    return wrap


def _load_all() -> None:
    # Importing the modules fills QUERIES.
    from playlens.plans import coldstart_queries, feature_queries, rec_queries, stats_queries  # noqa: F401


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: v[0] for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in QUERIES.items() if v[1] is not None}
