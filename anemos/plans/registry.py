"""Registry of queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.session import checked

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(tables)`` under a key, with its SQL twin if there is one."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from anemos.plans.bindings import Tables

            return fn(Tables(checked(spark), sf_dir))

        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return fn

    return register


def r6(c) -> Column:
    """Six decimals, half away from zero, without decimal arithmetic; -0.0 becomes 0.0."""
    x = F.col(c) if isinstance(c, str) else c
    return F.signum(x) * F.floor(F.abs(x) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})
