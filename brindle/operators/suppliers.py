"""Canonical suppliers, bronze and generic cleaning, performance aggregation: behaviour as documented only.

Assumptions are parameters: which rule excludes an item, and that a cabinet's canonical supplier is the one that most
of its rows name, resolved only if one supplier has the most rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.aggregate import weighted_aggregate
from brindle.operators.clean import normalize_text, string_columns
from brindle.functions.names import rename


def canonical_suppliers(df: DataFrame, cabinet: str, supplier: str) -> DataFrame:
    """Per cabinet: canonical_supplier, its rows, observed_supplier_count, canonical_supplier_status, cross_supplier_cabinet."""
    counts = df.where(F.col(cabinet).isNotNull() & F.col(supplier).isNotNull()).groupBy(cabinet, supplier).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(supplier).alias("s")))
    out = counts.groupBy(cabinet).agg(best.alias("best"), F.count(F.lit(1)).alias("observed_supplier_count"), F.max("n").alias("most"), F.array_sort(F.collect_list("n")).alias("ns"))
    tied = F.size(F.filter("ns", lambda x: x == F.col("most"))) > 1
    return out.select(cabinet, F.when(~tied, F.col("best.s")).alias("canonical_supplier"), F.col("most").alias("supplier_rows"), "observed_supplier_count", F.when(tied, "tied").otherwise("resolved").alias("canonical_supplier_status"), (F.col("observed_supplier_count") > 1).alias("cross_supplier_cabinet"))


def apply_canonical(df: DataFrame, canonical: DataFrame, cabinet: str, supplier: str) -> DataFrame:
    """The supplier of resolved cabinets replaced; others keep theirs."""
    known = canonical.select(F.col(cabinet).alias("__c"), "canonical_supplier", "canonical_supplier_status")
    joined = df.join(known, F.col(cabinet) == F.col("__c"), "left")
    return joined.withColumn(supplier, F.coalesce("canonical_supplier", supplier)).drop("__c", "canonical_supplier")


def cross_supplier_report(df: DataFrame, cabinet: str, supplier: str) -> DataFrame:
    """Rows per supplier of the cabinets that have several."""
    several = df.groupBy(cabinet).agg(F.countDistinct(supplier).alias("k")).where("k > 1").select(cabinet)
    return df.join(several, cabinet, "left_semi").groupBy(cabinet, supplier).agg(F.count(F.lit(1)).alias("rows"))


def bronze_clean(df: DataFrame, lower_values: bool = True) -> DataFrame:
    """Standard headers, trimmed (and lower-cased) text."""
    df = rename(df)
    if lower_values:
        return normalize_text(df)
    strings = set(string_columns(df))
    return df.select(*[F.trim(c).alias(c) if c in strings else F.col(c) for c in df.columns])


def aggregate_performance(df: DataFrame, group: list[str], weight: str, means: list[str], sums: list[str], first: list[str], distinct: list[str], order, excluded=None) -> tuple[DataFrame, DataFrame]:
    """(aggregated, excluded rows per group): rows for which `excluded` is true are left out and counted."""
    bad = F.coalesce(excluded, F.lit(False)) if excluded is not None else F.lit(False)
    kept = df.where(~bad)
    return weighted_aggregate(kept, group, weight, means, sums, first, distinct, order), df.where(bad).groupBy(*group).agg(F.count(F.lit(1)).alias("excluded_rows"))
