"""Mode imputation, in two kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.joins import null_safe_join
from brindle.operators.persist import fixed


def group_modes(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """(__g, __m_<value>...): each group's mode of every value column, in one aggregation; of equal counts the lowest value, in its own order."""
    keyed = df.where(F.col(group).isNotNull())
    # long counts by (group, column): values stay in columns of their own, so they keep their types
    cells = keyed.select(F.col(group).alias("__g"), F.posexplode(F.array(*[F.struct(*[(F.col(w) if w == v else F.lit(None).cast(df.schema[w].dataType)).alias(w) for w in values]) for v in values])).alias("__i", "__v")).select("__g", "__i", "__v.*")
    cells = cells.where(F.coalesce(*[F.col(w).cast("string") for w in values]).isNotNull())
    counts = cells.groupBy("__g", "__i", *values).agg(F.count(F.lit(1)).alias("__n"))
    best = [F.min(F.when(F.col("__i") == i, F.struct((-F.col("__n")).alias("n"), F.col(w).alias("v"))))["v"].alias(f"__m_{w}") for i, w in enumerate(values)]
    return counts.groupBy("__g").agg(*best)


def impute_by_groups(df: DataFrame, values: list[str], groups: list[str]) -> DataFrame:
    """For each value column in order, and for it each group column in order, nulls take their group's mode. Modes come from the rows as
    given, never from filled ones, but a row's group is what the row then has: a group column that was filled before
    counts as filled, one that is filled later doesn't. A null group fills nothing.

    All value columns' modes of a group column are found in one aggregation. A group column that isn't filled itself is
    joined once for all value columns, others once for each.
    """
    lookups = {g: group_modes(df, g, wanted) for g in groups if (wanted := [v for v in values if v != g])}
    fixed = [g for g in lookups if g not in values]
    out = df
    for k, g in enumerate(fixed):
        lookup = lookups[g].select(F.col("__g").alias(f"__g{k}"), *[F.col(f"__m_{v}").alias(f"__m{k}_{v}") for v in values])
        out = out.join(lookup, F.col(g) == F.col(f"__g{k}"), "left").drop(f"__g{k}")
    for v in values:
        for g in lookups:
            if g == v:
                continue
            if g in fixed:
                out = out.withColumn(v, F.coalesce(v, f"__m{fixed.index(g)}_{v}"))
            else:
                found = lookups[g].select("__g", F.col(f"__m_{v}").alias("__m"))
                out = out.join(found, F.col(g) == F.col("__g"), "left").withColumn(v, F.coalesce(v, "__m")).drop("__g", "__m")
    return out.select(*df.columns)


def impute_by_hierarchy(df: DataFrame, value: str, hierarchy: list[str]) -> tuple[DataFrame, list[dict]]:
    """Modes by all hierarchy columns, then without the rightmost, and so on, each found on the partly filled rows; null keys
    match null keys. Returns the rows and how many were filled at each level.

    One scan counts (keys, value), nulls too. All nulls of the same keys are filled alike, so every level works on these counts: it rolls them
    up to its prefix, adds what the levels before have filled, and fills keys. At last the rows are joined once to their keys' value.
    """
    keys = [h for h in hierarchy if h != value]
    if not keys:
        return df, []
    at = [f"__h{i}" for i in range(len(keys))]
    counts = fixed(df.groupBy(*[F.col(k).alias(a) for k, a in zip(keys, at)], F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n")))
    kind = df.schema[value].dataType
    holes = fixed(counts.where(F.col("__v").isNull()).select(*at, "__n", F.lit(None).cast(kind).alias("__fill"), F.lit(None).cast("int").alias("__level")))
    known = counts.where(F.col("__v").isNotNull()).select(*at, "__v", "__n")
    for level in range(len(keys), 0, -1):
        prefix = at[:level]
        now = known.unionByName(holes.where(F.col("__fill").isNotNull()).select(*at, F.col("__fill").alias("__v"), "__n"))
        rolled = now.groupBy(*prefix, "__v").agg(F.sum("__n").alias("__n"))
        best = rolled.groupBy(*prefix).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col("__v").alias("v")))["v"].alias("__mode"))
        found = null_safe_join(holes, best, prefix)
        fills = F.col("__fill").isNull() & F.col("__mode").isNotNull()
        holes = fixed(found.select(*at, "__n", F.coalesce("__fill", "__mode").alias("__fill"), F.when(fills, level).otherwise(F.col("__level")).alias("__level")))
    filled = {r["__level"]: r["n"] for r in holes.groupBy("__level").agg(F.sum("__n").alias("n")).collect()}  # a row per level
    levels = [{"keys": keys[:level], "filled": filled.get(level, 0)} for level in range(len(keys), 0, -1)]
    fill = holes.where(F.col("__fill").isNotNull()).select(*[F.col(a).alias(k) for a, k in zip(at, keys)], "__fill")
    joined = null_safe_join(df, fill, keys)
    return joined.select(*[F.coalesce(c, "__fill").alias(c) if c == value else F.col(c) for c in df.columns]), levels


def remaining_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
