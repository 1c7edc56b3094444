"""Aggregations: profiles of missing values, modes, first values, shares, weighted means, lift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from brindle.functions.scalars import norm_text, percent
from brindle.operators.quantiles import exact_quantiles, top_distinct

#: Hashed parts of a key's names; a part sends on its first few, and they are what meets in a task.
NAME_PARTS = 16


def missing(df: DataFrame, c: str) -> Column:
    """Null, NaN or blank."""
    kind = df.schema[c].dataType
    out = F.col(c).isNull()
    if isinstance(kind, (FloatType, DoubleType)):
        out = out | F.isnan(c)
    if isinstance(kind, StringType):
        out = out | (F.trim(c) == "")
    return out


def missing_summary(df: DataFrame) -> DataFrame:
    """A row per column: data_type, missing_count, missing_percent, non_missing_count. One pass; an empty table gives zeros."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("data_type"), F.col(c).alias("missing_count")) for c, k in df.dtypes])
    rows = counts.select("__rows", F.inline(cells))
    share = F.coalesce(percent(F.col("missing_count"), F.col("__rows")), F.lit(0.0))
    return rows.select("column_name", "data_type", "missing_count", share.alias("missing_percent"), (F.col("__rows") - F.col("missing_count")).alias("non_missing_count"))


def null_percentages(df: DataFrame) -> DataFrame:
    """One wide row; null for an empty table."""
    return df.agg(*[percent(F.count_if(F.col(c).isNull()), F.count(F.lit(1)), 4).alias(c) for c in df.columns])


def group_counts(df: DataFrame, c: str, limit: int | None = None) -> DataFrame:
    """Value counts, the most frequent first, ties by value."""
    out = df.groupBy(c).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.col(c).asc_nulls_last())
    return out.limit(limit) if limit else out


def match_rate(df: DataFrame, c: str, unmatched: str = "no_match") -> DataFrame:
    return df.agg(percent(F.count_if(F.col(c) == unmatched), F.count(F.lit(1)), 4).alias("no_match_percent"))


def describe(df: DataFrame) -> DataFrame:
    return df.describe()


def modes(df: DataFrame, group: list[str], value: str, null_groups: bool = False) -> DataFrame:
    """The most frequent non-null value of each group; the lowest of equals, in natural order."""
    rows = df.where(F.col(value).isNotNull())
    if not null_groups:
        for g in group:
            rows = rows.where(F.col(g).isNotNull())
    counts = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v")))["v"].alias(value)
    return counts.groupBy(*group).agg(best) if group else counts.agg(best)


def first_values(df: DataFrame, group: list[str], columns: list[str], order: Column) -> DataFrame:
    """The first non-null value of each column by itself, by `order`, then value; a null group is a group."""
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v"))))["v"]
    return df.groupBy(*group).agg(*[first(c).alias(c) for c in columns])


def relation_profile(df: DataFrame, key: str, name: str, method: str, score: str, priorities: dict[str, int], excluded: list[str], other: int = 99, date: str | None = None, most_names: int = 8, most_methods: int = 6) -> DataFrame:
    """Per key, over accepted rows: best_name, best_method, best_score and best_date (each the first there is, by priority, then score, then
    name), names (at most `most_names` distinct ones in that order) and their number, methods (at most `most_methods`), n_rows, best_priority.

    Text is normalized: lower case, no spare white space, blank is null. Rows without key or name, and those of excluded
    methods, don't count; a null method is accepted. best_date is null without a `date` column.
    """
    text = lambda c: norm_text(c) if isinstance(df.schema[c].dataType, StringType) else F.col(c)
    # in a list of one row, texts are normalized once, before the filters and whatever reads them
    row = F.struct(text(key).alias("__key"), text(name).alias("__name"), text(method).alias("__method"), F.col(score).alias("__score"), (F.to_date(F.col(date)) if date else F.lit(None).cast("date")).alias("__date"))
    kept = df.select(F.inline(F.array(row))).where((~F.col("__method").isin(excluded) | F.col("__method").isNull()) & F.col("__key").isNotNull() & F.col("__name").isNotNull())
    rank = F.lit(other)
    for k, v in priorities.items():
        rank = F.when(F.col("__method") == k, v).otherwise(rank)
    kept = kept.withColumn("__r", rank).withColumn("__s", -F.coalesce(F.nanvl(F.col("__score").cast("double"), F.lit(None).cast("double")), F.lit(-1e300)))
    at = F.struct(F.col("__r").alias("r"), F.col("__s").alias("s"), F.col("__name").alias("n"))
    first = ("method", "score", "date")
    # rows are sent once, to the part of the key that their name is in; a name's rows become one, then a part's names do
    dealt = kept.withColumn("__part", F.pmod(F.xxhash64("__name"), F.lit(NAME_PARTS))).repartition("__key", "__part")
    of_name = dealt.groupBy("__key", "__part", "__name").agg(F.min(F.struct("__r", "__s")).alias("at"), F.count(F.lit(1)).alias("n"), *[F.min(F.when(F.col(f"__{c}").isNotNull(), F.struct("__r", "__s", F.col(f"__{c}").alias("v")))).alias(c) for c in first])
    order = F.struct(F.col("at.__r").alias("r"), F.col("at.__s").alias("s"), F.col("__name").alias("n"))
    placed = of_name.withColumn("k", F.row_number().over(Window.partitionBy("__key", "__part").orderBy("at", "__name")))
    best = [F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.__r").alias("r"), F.col(f"{c}.__s").alias("s"), F.col("__name").alias("n"), F.col(f"{c}.v").alias("v")))).alias(c) for c in first]
    of_part = placed.groupBy("__key", "__part").agg(F.collect_list(F.when(F.col("k") <= most_names, order)).alias("names"), F.min(order).alias("name"), *best, F.count(F.lit(1)).alias("n_names"), F.sum("n").alias("n_rows"))
    names = F.slice(F.array_sort(F.flatten(F.collect_list("names"))), 1, most_names)
    out = of_part.groupBy("__key").agg(names.alias("names"), F.min("name").alias("name"), *[F.min(c).alias(c) for c in first], F.sum("n_names").alias("n_names"), F.sum("n_rows").alias("n_rows"))
    out = out.select("__key", F.col("name.n").alias("best_name"), *[F.col(f"{c}.v").alias(f"best_{c}") for c in first], "n_names", "n_rows", F.col("name.r").alias("best_priority"), F.transform("names", lambda x: x["n"]).alias("names"))
    methods = top_distinct(kept, ["__key"], "__method", at, most_methods, "methods").withColumnRenamed("__key", "__k2")
    out = out.join(methods, F.col("__key") == F.col("__k2"), "left").drop("__k2")
    return out.withColumn("methods", F.coalesce("methods", F.array().cast("array<string>"))).withColumnRenamed("__key", key)


def weighted_aggregate(df: DataFrame, group: list[str], weight: str, means: list[str], sums: list[str], first: list[str], distinct: list[str], order: Column) -> DataFrame:
    """Means weighted where value and weight are both there, sums, first stable descriptors, distinct counts."""
    def mean(c: str) -> Column:
        both = F.col(c).isNotNull() & F.col(weight).isNotNull()
        return F.try_divide(F.sum(F.when(both, F.col(c) * F.col(weight))), F.sum(F.when(both, F.col(weight))))

    stable = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v"))))["v"]
    return df.groupBy(*group).agg(*[mean(c).alias(f"{c}_mean") for c in means], *[F.sum(c).alias(f"{c}_sum") for c in sums], *[stable(c).alias(c) for c in first], *[F.countDistinct(c).alias(f"{c}_count") for c in distinct])


def value_shares(df: DataFrame, group: str, value: str, top: int = 3, ignore: tuple[str, ...] = ()) -> DataFrame:
    """The top values of each group as text, `x (40%); y (20%)`; ignored values don't count in the shares either."""
    rows = df.where(F.col(value).isNotNull() & ~F.col(value).isin(*ignore)) if ignore else df.where(F.col(value).isNotNull())
    counts = rows.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(group)))
    ranked = counts.withColumn("k", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), value))).where(F.col("k") <= top)
    item = F.concat(F.col(value), F.lit(" ("), F.round(F.col("share") * 100).cast("int").cast("string"), F.lit("%)"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("k", item.alias("t")))), lambda x: x["t"])
    return ranked.groupBy(group).agg(F.array_join(texts, "; ").alias(f"{value}_shares"))


def joined_values(df: DataFrame, group: str, value: str, order: str, sep: str = " | ") -> DataFrame:
    """A group's values in order as one text, with their number. The text is as long as the group; see top_distinct for a bounded one."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])
    return df.groupBy(group).agg(F.array_join(texts, sep).alias(f"{value}_list"), F.count(value).alias(f"{value}_count"))


def robust_scale(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """Median fill (of nulls and NaN), clip to the 1st and 99th percentile, then 0 to 1; null everywhere where these are equal."""
    out = out or f"{c}_scaled"
    x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    known = exact_quantiles(df, c, [0.5]).first()
    if known is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    filled = F.coalesce(x, F.lit(known["quantiles"][0]))
    low, high = exact_quantiles(df.select(filled.alias("v")), "v", [0.01, 0.99]).first()["quantiles"]
    if not high > low:
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, (F.least(F.greatest(filled, F.lit(low)), F.lit(high)) - low) / (high - low))


def lift(long: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster, feature, cluster_mean, global_mean, lift, rank) of long features (id, feature, value; absent is 0) and
    members (id, cluster)."""
    total = members.agg(F.count(F.lit(1)).alias("__all"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("__size"))
    sums = long.join(members, "id").groupBy("cluster", "feature").agg(F.sum("value").alias("__s"))
    everywhere = long.join(members, "id", "left_semi").groupBy("feature").agg(F.sum("value").alias("__t"))
    # a cluster without a feature has mean 0 of it: every feature goes to each cluster of a list of one row, which grows with the clusters alone
    clusters = sizes.agg(F.collect_list(F.struct("cluster", "__size")).alias("__clusters"))
    everywhere = everywhere.join(F.broadcast(total.join(clusters, F.lit(True))), F.lit(True))
    grid = everywhere.select("feature", "__t", "__all", F.explode("__clusters").alias("c")).select("feature", "__t", "__all", "c.cluster", "c.__size").join(sums, ["cluster", "feature"], "left")
    out = grid.select("cluster", "feature", (F.coalesce("__s", F.lit(0.0)) / F.col("__size")).alias("cluster_mean"), (F.col("__t") / F.col("__all")).alias("global_mean"))
    out = out.withColumn("lift", F.col("cluster_mean") - F.col("global_mean"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc(F.round("lift", 9)), "feature")))


def cluster_profile(df: DataFrame, cluster: str, flag: str, date: str, age: str) -> DataFrame:
    out = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), F.sum(F.col(flag).cast("int")).alias(f"{flag}_count"), F.min(date).alias(f"min_{date}"), F.max(date).alias(f"max_{date}"))
    return with_medians(out, df, cluster, age, f"median_{age}")


def with_medians(out: DataFrame, df: DataFrame, group: str, c: str, name: str) -> DataFrame:
    """Adds each group's exact median of a column of `df`; null for groups without values."""
    medians = exact_quantiles(df, c, [0.5], [group]).select(F.col(group).alias("__median_of"), F.get("quantiles", F.lit(0)).alias(name))
    return out.join(medians, F.col(group).eqNullSafe(F.col("__median_of")), "left").drop("__median_of")
