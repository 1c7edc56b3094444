"""Like items: newest items as holdout, each matched to the older members of the first merge that has any."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.scalars import age_bucket, calendar_months, clip01
from brindle.operators.cluster import nearest_in_ranges
from brindle.operators.persist import fixed
from brindle.operators.tree import first_with

HOLDOUT, HISTORICAL = "holdout_new_game", "qualified_historical"


def roles(df: DataFrame, id_col: str, date: str, fraction: float = 0.10) -> DataFrame:
    """Adds role: the newest max(1, ceil(n * fraction)) rows are the holdout; null dates last, ties by id.

    Counts per date give the date at which the holdout ends; rows of newer dates are in it, and only the rows of that
    date are ranked.
    """
    per = df.groupBy(F.col(date).alias("__d")).agg(F.count(F.lit(1)).alias("__n"))
    run = per.withColumn("__upto", F.sum("__n").over(Window.orderBy(F.desc_nulls_last("__d")))).withColumn("__all", F.sum("__n").over(Window.partitionBy(F.lit(1))))
    take = F.greatest(F.lit(1), F.ceil(F.col("__all") * fraction))
    dates = fixed(run.select("__d", (take - (F.col("__upto") - F.col("__n"))).alias("__left"), "__n"))
    edge = dates.where("__left > 0 and __left < __n").first()
    whole = df.join(dates.select("__d", "__left", "__n"), F.col(date).eqNullSafe(F.col("__d")), "left").withColumn("role", F.when(F.col("__left") >= F.col("__n"), HOLDOUT).otherwise(HISTORICAL))
    if edge is not None:
        newest = df.where(F.col(date).eqNullSafe(F.lit(edge["__d"]))).orderBy(id_col).limit(edge["__left"]).select(F.col(id_col).alias("__id"))
        whole = whole.join(newest.withColumn("__new", F.lit(True)), F.col(id_col) == F.col("__id"), "left").withColumn("role", F.when(F.col("__new"), HOLDOUT).otherwise(F.col("role"))).drop("__id", "__new")
    return whole.drop("__d", "__left", "__n")


def with_age(df: DataFrame, date: str, as_of=None) -> DataFrame:
    """Adds age in calendar months, at least 0, and its bucket; as_of defaults to the latest date, else today."""
    latest = as_of or df.agg(F.max(date)).first()[0]
    months = F.greatest(calendar_months(F.col(date), F.lit(latest) if latest is not None else F.current_date()), F.when(F.col(date).isNotNull(), F.lit(0)))
    return df.withColumn("release_age_months", months).withColumn("release_age_bucket", age_bucket("release_age_months"))


def earliest(df: DataFrame, dates: list[str], out: str) -> DataFrame:
    return df.withColumn(out, F.least(*dates) if len(dates) > 1 else F.col(dates[0]))


def like_items(tree: DataFrame, role: DataFrame, vectors: DataFrame, cut: DataFrame, limit: int | None = None, metric: str = "cosine") -> DataFrame:
    """For each holdout item (role: id, role), the historical members of the first merge that holds it and any of them: all, or the
    `limit` nearest.

    vectors (id and a dense or sparse vector, see cluster.pair_distances) and cut (id, cluster) are of the same items. Leaves in the order of the tree make
    a merge's historical members a range of ranks, which is all that a target carries. Distances are only computed within
    these ranges. Distances that agree to nine digits are ties, which go by id.
    """
    found, ranks = first_with(tree, role.select("id", (F.col("role") != HOLDOUT).alias("historical")), "historical")
    found, ranks = fixed(found), fixed(ranks)
    near = nearest_in_ranges(found.join(vectors, "id"), ranks.join(vectors, "id"), limit, metric)
    rank = F.row_number().over(Window.partitionBy("target_id").orderBy(F.round("distance", 9), "like_id"))
    ranked = near.withColumn("candidate_rank", rank)
    if limit is not None:
        ranked = ranked.where(F.col("candidate_rank") <= limit)
    about = found.select(F.col("id").alias("target_id"), "node", "merge_distance", "cluster_size", (F.col("hi") - F.col("lo")).alias("historical_in_cluster"))
    rows = ranked.join(about, "target_id")
    rows = rows.join(cut.select(F.col("id").alias("target_id"), F.col("cluster").alias("tc")), "target_id").join(cut.select(F.col("id").alias("like_id"), F.col("cluster").alias("lc")), "like_id")
    return rows.select("target_id", "like_id", "candidate_rank", F.col("distance").alias("pair_distance"), clip01(1 - F.col("distance")).alias("similarity_score"), "merge_distance", clip01(1 - F.col("merge_distance")).alias("merge_similarity_score"), F.col("node").alias("smallest_qualifying_cluster_node_id"), F.col("cluster_size").alias("smallest_qualifying_cluster_size"), F.col("historical_in_cluster").alias("qualifying_historical_in_cluster"), (F.col("tc") == F.col("lc")).alias("same_flat_cluster"))


#: The attributes of target and like item that a mapping shows, and from which of a profile's columns.
ATTRIBUTES = ("theme_sk", "theme_name_friendly", "product_family", "product_line", "game_type", "game_matrix", "release_date", "cluster_id", "historical_game_name")


def with_attributes(mapping: DataFrame, profiles: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """The mapping with the attributes of both items as target_<name> and like_<name>. profiles: id and any of `attributes`;
    those that a profile lacks are null."""
    have = [F.col(a) if a in profiles.columns else F.lit(None).cast("string").alias(a) for a in attributes]
    out = mapping
    for side in ("target", "like"):
        named = profiles.select("id", *have).select(F.col("id").alias("__id"), *[F.col(a).alias(f"{side}_{a}") for a in attributes])
        out = out.join(named, F.col(f"{side}_id") == F.col("__id")).drop("__id")
    first = [c for side in ("target", "like") for c in (f"{side}_id", *[f"{side}_{a}" for a in attributes])]
    return out.select(*first, *[c for c in mapping.columns if c not in first])


def grouped_mapping(mapping: DataFrame, by: tuple[str, ...] = (), themes: str = "like_theme_name_friendly", names: str = "like_historical_game_name") -> DataFrame:
    """One row per target, the best first: its attributes (`by`), its like items in rank order, their themes and names where the mapping has
    them, their number, best and mean similarity. Null texts are shown as `nan`."""

    def listed(c: str, out: str):
        shown = F.coalesce(F.col(c).cast("string"), F.lit("nan"))
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("candidate_rank", shown.alias("v")))), lambda x: x["v"]), " | ").alias(out)

    lists = [listed("like_id", "like_ids"), *[listed(c, out) for c, out in ((themes, "like_themes"), (names, "like_names")) if c in mapping.columns]]
    out = mapping.groupBy("target_id", *by).agg(*lists, F.count(F.lit(1)).alias("n_like"), F.max("similarity_score").alias("best_similarity"), F.avg("similarity_score").alias("mean_similarity"))
    return out.orderBy(F.desc("best_similarity"), F.desc("n_like"), "target_id")


def reportable_lift(lift: DataFrame, floor: float, share_of_top: float, least: int = 5, n: int | None = None, source: str | None = None, not_source: str | None = None, important_only: bool = True) -> DataFrame:
    """Of each cluster's reportable features with positive lift: those of at least the floor and the share of the top one,
    filled up with the next best to `least`, and of all at most `n`; without `important_only` the best `n`.

    lift: cluster, feature, lift, and if given is_reportable and source_column, which `source` and `not_source` choose by. The two
    thresholds have no default.
    """
    rows = lift.where("lift > 0")
    if "is_reportable" in lift.columns:
        rows = rows.where("is_reportable")
    if source is not None:
        rows = rows.where(F.col("source_column") == source)
    if not_source is not None:
        rows = rows.where(~F.col("source_column").eqNullSafe(F.lit(not_source)))
    by = Window.partitionBy("cluster")
    ranked = rows.withColumn("rank", F.row_number().over(by.orderBy(F.desc(F.round("lift", 9)), "feature"))).withColumn("top", F.max("lift").over(by))
    important = F.col("lift") >= F.greatest(F.lit(floor), F.col("top") * share_of_top)
    out = ranked.select("cluster", "feature", "lift", "rank", important.alias("is_important"))
    out = out.where(F.col("is_important") | (F.col("rank") <= least)) if important_only else out
    return out if n is None else out.where(F.col("rank") <= n)


def description_lift(lift: DataFrame, theme_column: str, themes: int = 2, others: int = 4) -> DataFrame:
    """A cluster's best theme features and best other ones, in that order: what describes it."""
    first = reportable_lift(lift, 0.0, 0.0, n=themes, source=theme_column, important_only=False).withColumn("part", F.lit(0))
    second = reportable_lift(lift, 0.0, 0.0, n=others, not_source=theme_column, important_only=False).withColumn("part", F.lit(1))
    return first.unionByName(second)
