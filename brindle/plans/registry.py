"""Queries over whole tables, one per operator, each with the DuckDB SQL of the same result.

The tables have no dirt of their own, so the inputs get some by modulus, from expressions that both dialects read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str, /, **columns: str) -> DataFrame:
    """A table with derived columns only, if there are any."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()]) if columns else df


def select(name: str, /, **columns: str) -> str:
    return f"(SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {name})"


def queries() -> dict:
    from brindle.plans import cleaning, clustering, combining, reporting  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict:
    queries()
    return dict(_SQL)
