"""Registry of checked queries: a Spark callable and, where SQL can say it, the expected result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""
    def add(run: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating-point columns rounded, so that two engines print the same digits."""
    return df.select(*[
        F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes
    ])
