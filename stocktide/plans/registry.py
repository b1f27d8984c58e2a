"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stocktide.plans.ctes import with_tables
from stocktide.sources.derived import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None, using: str = ""):
    """Register ``fn(tables) -> DataFrame``.

    ``check`` is the SQL for the same result; ``using`` names the derived tables
    it reads, which are put in front as common table expressions.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if check is not None:
            CHECKS[name] = with_tables(using.split(), check)
        return fn

    return register
