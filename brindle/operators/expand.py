"""Expansion of list columns and categories into flags, long or wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.arrays import has_value
from brindle.functions.names import flag_names

#: Distinct values that may become columns; more are an error, since a plan can't have unlimited columns.
MOST_COLUMNS = 5000


def distinct_items(df: DataFrame, array: Column) -> list[str]:
    """The non-blank values of an array column, in order: one job, whose result has a row per value."""
    rows = df.select(F.explode_outer(array).alias("v")).where(F.col("v").isNotNull() & (F.trim("v") != "")).distinct().orderBy("v").limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} distinct values")
    return [r[0] for r in rows]


def flags(df: DataFrame, array: Column, prefix: str, values: list[str] | None = None) -> DataFrame:
    """A boolean column per value, never null; names that collide get a number."""
    values = distinct_items(df, array) if values is None else values
    return df.withColumns({name: has_value(array, v) for v, name in flag_names(prefix, values).items()}) if values else df


def one_hot_long(df: DataFrame, id_col: str, c: str, weight: float = 1.0) -> DataFrame:
    """(id, feature, value): cat__<column>_<value>."""
    return df.where(F.col(c).isNotNull()).select(F.col(id_col).alias("id"), F.concat(F.lit(f"cat__{c}_"), F.col(c).cast("string")).alias("feature"), F.lit(float(weight)).alias("value"))


def one_hot_wide(df: DataFrame, c: str, values: list[str] | None = None) -> DataFrame:
    """A 0/1 column per value, at the edge only."""
    values = distinct_items(df, F.array(F.col(c).cast("string"))) if values is None else values
    return df.withColumns({f"cat__{c}_{v}": F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)) for v in values}) if values else df
