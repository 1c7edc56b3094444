"""From item profiles to like items: features, linkage, flat cut, roles, mapping, grouped mapping, cluster summary, elbow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import arrays, scalars
from brindle.functions.names import label
from brindle.functions.scalars import clean_category
from brindle.operators import aggregate, clean, cluster, features, likeitems
from brindle.operators.persist import fixed

#: The columns whose most frequent values describe a cluster.
CHARACTERISTICS = (
    "product_family", "product_line", "game_type", "game_matrix", "math_model_family", "product_segment", "family_name", "brand_name", "business_segment", "volatility_cd",
    "attr_theme_bucket", "is_multi_denom", "is_wap", "is_poker",
)


#: Match methods by rank, those that don't count, the dates of a release by region, the texts of the theme bucket, parts of matrices.
METHOD_RANKS = {"raw_exact": 1, "basic_clean_exact": 2, "aggressive_clean_exact": 3, "very_likely_fuzzy": 4}
EXCLUDED_METHODS = ("possible_review_fuzzy", "weak_review_only", "no_match")
RELEASE_DATES = ("na_release_date", "lac_release_date", "emea_release_date", "apac_release_date")
THEME_TEXTS = ("theme_name", "theme_name_friendly", "family_name", "brand_name", "product_family", "game_type")
MATRIX_PARTS = ("bingo", "hhr", "lottery", "prize", "reels")


def profiles(attributes: DataFrame, relation: DataFrame, order: list[str], key: str = "theme_name_friendly", name: str = "perf_game_name", method: str = "match_method", score: str = "match_score", date: str = "game_release_date", ranks: dict[str, int] | None = None, excluded: tuple[str, ...] = EXCLUDED_METHODS, deleted: str = "audit_is_deleted", matrix: str = "game_matrix", as_of=None) -> DataFrame:
    """Item profiles: attributes whose normalized key has accepted relation rows, with what the relation says of it.

    Adds join_key, the seven relation outputs (best name, names, their number, methods, best method and score, matched date), profile_id (0..n-1 in
    the given order), profile_release_date (the earliest of the regions' dates and the matched one), release_age_months and its bucket (counted to
    the latest of these dates, or `as_of`), attr_theme_bucket and a flag per part of the matrix list. Rows without a key and deleted ones go; dates that
    can't be read are null; columns that the attributes lack are left out, a missing matrix gives flags of 0.
    """
    known = lambda columns: [c for c in columns if c in attributes.columns]
    rows = attributes.withColumn("join_key", scalars.norm_text(key)).where(F.col("join_key").isNotNull())
    if deleted in attributes.columns:
        rows = clean.drop_deleted(rows, deleted)
    rows = rows.withColumns({c: scalars.parse_date(c) for c in known(RELEASE_DATES)})
    of = relation.select(F.col(key).cast("string").alias("__key"), F.col(name).cast("string").alias("__name"), F.col(method).cast("string").alias("__method"), scalars.parse_number(score).alias("__score"), scalars.parse_date(date).alias("__date"))
    best = aggregate.relation_profile(of, "__key", "__name", "__method", "__score", METHOD_RANKS if ranks is None else ranks, list(excluded), date="__date")
    best = best.select(
        F.col("__key").alias("__join"), F.col("best_name").alias("best_historical_game_name"), F.array_join("names", " | ").alias("historical_game_names"), F.col("n_names").alias("historical_candidate_count"),
        F.array_join("methods", " | ").alias("accepted_match_methods"), F.col("best_method").alias("best_match_method"), F.col("best_score").alias("best_match_score"), F.col("best_date").alias("matched_release_date"),
    )
    joined = rows.join(best, F.col("join_key") == F.col("__join")).drop("__join")
    dated = likeitems.earliest(joined, [*known(RELEASE_DATES), "matched_release_date"], "profile_release_date")
    numbered = clean.dense_ids(dated, [F.col(c).asc_nulls_last() for c in order], "profile_id")
    parts = {f"attr_matrix_token_{p}": (arrays.any_item_contains(arrays.lenient_list(matrix), p).cast("double") if matrix in attributes.columns else F.lit(0.0)) for p in MATRIX_PARTS}
    return likeitems.with_age(numbered, "profile_release_date", as_of).withColumns({"attr_theme_bucket": scalars.theme(*known(THEME_TEXTS)), **parts})


def find_like_items(profiles: DataFrame, id_col: str, date: str, categories: dict[str, float], booleans: dict[str, float] | None = None, numbers: dict[str, float] | None = None, texts: tuple[str, ...] = (), k: int = 8, fraction: float = 0.10, top_features: int = 8, limit: int | None = None, most_k: int = 16, floor: float | None = None, share_of_top: float | None = None, theme_column: str | None = None) -> dict[str, DataFrame]:
    """profiles (with id 0..n-1, role, age, cluster_id), features, metadata, tree, elbow, mapping, grouped and summary of one run.

    Ids may be any distinct values; rows are numbered in their order, and `profile_id` in the results is the own id. k must be 2 to
    `most_k` and less than the number of items, else it is an error. `limit` is the number of like items a target has at
    most. With `floor` and `share_of_top` the summary names the features that are important by them, and describes clusters..
    """
    numbered = fixed(clean.dense_ids(profiles.withColumnRenamed(id_col, "profile_id"), [F.col("profile_id")], "id"))
    n = numbered.count()
    if not 2 <= k <= min(most_k, n - 1):
        raise ValueError(f"k = {k} is not from 2 to {min(most_k, n - 1)}, for {n} items")
    long = features.feature_table(numbered, "id", categories, booleans, numbers, list(texts))
    long = fixed(long)
    weights = {**categories, **(booleans or {}), **(numbers or {})}
    meta = features.feature_metadata(long, n, weights=weights, theme_column=theme_column)
    matrix = fixed(cluster.sparse_rows(long))
    tree = cluster.keep_tree(cluster.linkage(cluster.dense_matrix(long)))
    cut = fixed(cluster.clusters(tree, k))
    placed = likeitems.with_age(likeitems.roles(numbered, "id", date, fraction), date).join(cut, "id").withColumn("cluster_id", F.col("cluster"))
    if date != "release_date":
        placed = placed.withColumn("release_date", F.col(date))
    mapping = likeitems.like_items(tree, placed.select("id", "role"), matrix, cut, limit)
    mapping = likeitems.with_attributes(mapping, placed)
    own = placed.select(F.col("id").alias("__id"), "profile_id")
    for side in ("target", "like"):
        mapping = mapping.join(own.withColumnRenamed("profile_id", f"{side}_profile_id"), F.col(f"{side}_id") == F.col("__id")).drop("__id")
    by = tuple(f"target_{a}" for a in ("profile_id", "theme_sk", "theme_name_friendly", "product_family", "product_line", "game_type", "release_date", "cluster_id"))
    return {
        "profiles": placed,
        "features": long,
        "metadata": meta,
        "tree": tree,
        "elbow": cluster.elbow(cluster.dense_matrix(long), tree, most_k),
        "mapping": mapping,
        "grouped": likeitems.grouped_mapping(mapping, by),
        "summary": summary(placed, long, date, top_features, meta, floor, share_of_top, theme_column),
    }


def holdout_features(profiles: DataFrame, long: DataFrame, meta: DataFrame, n: int = 12) -> DataFrame:
    """The `n` largest features of each holdout item by weighted value: what its chart would show. (profile_id, cluster_id, rank, feature, value)"""
    held = profiles.where(F.col("role") == likeitems.HOLDOUT).select("id", "profile_id", "cluster_id")
    about = meta.where("is_reportable").select(F.col("feature_column").alias("feature"), "friendly_feature_name")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("value"), "feature"))
    return long.join(held, "id").join(about, "feature").withColumn("rank", rank).where(F.col("rank") <= n).select("profile_id", "cluster_id", "rank", F.col("friendly_feature_name").alias("feature"), "value")


def wide_features(long: DataFrame, profiles: DataFrame, most: int = 2000) -> DataFrame:
    """(profile_id, a column per feature, 0 where absent); over `most` features there is no such table, and the rows stay long."""
    named = long.join(profiles.select("id", "profile_id"), "id").select("profile_id", "feature", "value")
    names = [r[0] for r in long.select("feature").distinct().orderBy("feature").limit(most + 1).collect()]
    if len(names) > most:
        return named
    return named.groupBy("profile_id").pivot("feature", names).agg(F.sum("value")).na.fill(0.0)


def summary(profiles: DataFrame, long: DataFrame, date: str, top_features: int = 8, meta: DataFrame | None = None, floor: float | None = None, share_of_top: float | None = None, theme_column: str | None = None) -> DataFrame:
    """A row per cluster: sizes by role, dates, median age, the top values of the columns that profiles have of CHARACTERISTICS, and
    the features that distinguish it most. profiles: id, cluster, role, the date, release_age_months.

    With metadata (see features.feature_metadata), a floor and a share of the top lift: important_features, the friendly names of the reportable
    features that are important by likeitems.reportable_lift, and cluster_description, its best theme features and others.
    """
    held = F.count_if(F.col("role") == likeitems.HOLDOUT)
    out = profiles.groupBy("cluster").agg(F.count(F.lit(1)).alias("profile_count"), held.alias("holdout_count"), (F.count(F.lit(1)) - held).alias("historical_count"), F.min(date).alias("min_release_date"), F.max(date).alias("max_release_date"))
    out = aggregate.with_medians(out, profiles, "cluster", "release_age_months", "median_release_age_months")
    for c in CHARACTERISTICS:
        if c in profiles.columns:
            shares = aggregate.value_shares(profiles.select("cluster", clean_category(F.col(c).cast("string")).alias(c)), "cluster", c)
            out = out.join(shares.withColumnRenamed(f"{c}_shares", f"top_{c}"), "cluster", "left")
    every = aggregate.lift(long.where(F.col("feature") != features.BIAS_FEATURE), profiles.select("id", "cluster"))
    lift = every.where(F.col("rank") <= top_features)
    # a name for each of the chosen features, at most top_features a cluster
    names = {r[0]: label(r[0]) for r in lift.select("feature").distinct().collect()}
    shown = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("feature")) if names else F.col("feature")
    best = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", shown.alias("name")))), lambda x: x["name"]), "; ")
    top = lift.groupBy("cluster").agg(best.alias("top_distinguishing_features"))
    out = out.join(top, "cluster", "left")
    if meta is not None and floor is not None and share_of_top is not None:
        about = meta.select(F.col("feature_column").alias("feature"), "friendly_feature_name", "source_column", "is_reportable")
        known = every.drop("rank").join(about, "feature")
        shown = {"important_features": (likeitems.reportable_lift(known, floor, share_of_top), ["rank"]), "cluster_description": (likeitems.description_lift(known, theme_column or ""), ["part", "rank"])}
        for column, (rows, order) in shown.items():
            named = rows.join(about.select("feature", "friendly_feature_name"), "feature")
            texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col("friendly_feature_name").alias("name")))), lambda x: x["name"]), "; ")
            out = out.join(named.groupBy("cluster").agg(texts.alias(column)), "cluster", "left")
    return out.withColumnRenamed("cluster", "cluster_id").orderBy("cluster_id")
