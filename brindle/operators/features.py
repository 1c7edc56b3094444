"""Weighted features in long form (id, feature, value): categories, booleans, numbers, tokens, bias."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import scalars
from brindle.operators.quantiles import exact_quantiles

#: Multiplier of all attribute weights, token weight, bias, levels and tokens kept.
MULTIPLIER, TOKEN_WEIGHT, BIAS, MOST_LEVELS, MOST_TOKENS, TOKEN_SHARE = 2.0, 0.70, 0.01, 180, 140, 0.55
BIAS_FEATURE, MISSING, OTHER = "__profile_bias", "__missing__", "__other__"
#: Words that are no tokens.
STOP_WORDS = (
    "the", "and", "for", "with", "from", "this", "that", "game", "games", "slot", "slots", "deluxe", "edition", "everi", "igt", "inc", "llc", "new", "machine", "used",
    "exclude", "unknown", "missing", "theme", "standard", "video",
)


def _cells(df: DataFrame, id_col: str, columns: list[str], value, **more) -> DataFrame:
    """(id, column, value and what `more` gives of a column), a row for each of the columns: the table is read once for all of them."""
    cells = [F.struct(F.lit(c).alias("column"), value(c).alias("value"), *[F.lit(f(c)).alias(n) for n, f in more.items()]) for c in columns]
    return df.select(F.col(id_col).alias("id"), F.inline(F.array(*cells)))


def _nothing(df: DataFrame, id_col: str) -> DataFrame:
    return df.limit(0).select(F.col(id_col).alias("id"), F.lit("").alias("feature"), F.lit(0.0).alias("value"))


def categorical_block(df: DataFrame, id_col: str, weights: dict[str, float], drop_missing: tuple[str, ...] = ()) -> DataFrame:
    """Of each column the levels of two or more rows, the 180 most frequent, by name; the rest is one level. Nothing of a column where one
    level is left. Missing and other levels of the `drop_missing` columns are dropped.

    All columns are counted, ranked and decided upon at once, in tables of at most 181 rows a column; no job runs before the result does.
    """
    if not weights:
        return _nothing(df, id_col)
    rows = _cells(df, id_col, list(weights), scalars.clean_category, weight=weights.__getitem__, drops=lambda c: c in drop_missing)
    counts = rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.where("n >= 2").withColumn("k", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))).where(F.col("k") <= MOST_LEVELS)
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("levels"))
    kept_sizes = ranked.groupBy(F.col("column").alias("c")).agg(F.count(F.lit(1)).alias("kept_levels"), F.max((F.col("value") == OTHER).cast("int")).alias("has_other"))
    left = F.coalesce("kept_levels", F.lit(0)) + F.when((F.coalesce("kept_levels", F.lit(0)) < F.col("levels")) & (F.coalesce("has_other", F.lit(0)) == 0), 1).otherwise(0)
    used = sizes.join(kept_sizes, F.col("column") == F.col("c"), "left").where((left > 1) & (F.col("levels") > 1)).select(F.col("column").alias("used"))
    kept = ranked.select(F.col("column").alias("c"), F.col("value").alias("kept"))
    named = rows.join(F.broadcast(kept), (F.col("column") == F.col("c")) & (F.col("value") == F.col("kept")), "left").join(F.broadcast(used), F.col("column") == F.col("used"), "left_semi")
    level = F.coalesce("kept", F.lit(OTHER))
    named = named.where(~F.col("drops") | ~level.isin(MISSING, OTHER))
    return named.select("id", F.concat(F.lit("cat__"), F.col("column"), F.lit("_"), level).alias("feature"), (F.col("weight") * MULTIPLIER).alias("value"))


def boolean_block(df: DataFrame, id_col: str, weights: dict[str, float]) -> DataFrame:
    """Null is false; nothing of a constant column."""
    if not weights:
        return _nothing(df, id_col)
    rows = _cells(df, id_col, list(weights), lambda c: F.coalesce(scalars.parse_bool(c), F.lit(False)), weight=weights.__getitem__)
    used = rows.groupBy("column").agg(F.min("value").alias("low"), F.max("value").alias("high")).where("NOT low AND high").select(F.col("column").alias("used"))
    return rows.where("value").join(F.broadcast(used), F.col("column") == F.col("used"), "left_semi").select("id", F.concat(F.lit("bool__"), F.col("column")).alias("feature"), (F.col("weight") * MULTIPLIER).alias("value"))


def numeric_block(df: DataFrame, id_col: str, weights: dict[str, float], logs: tuple[str, ...] = ("bet", "lines", "ways", "months")) -> DataFrame:
    """log1p by column name, robust 0-1 scale (median fill, clip to the 1st and 99th percentile); nothing of a column where these are
    equal. The quantiles of all columns are found together, so jobs don't follow the number of columns."""
    if not weights:
        return _nothing(df, id_col)

    def value(c: str):
        x = scalars.parse_number(c, currency=True)
        return F.nanvl(scalars.log1p_clip(x) if any(t in c for t in logs) else x, F.lit(None).cast("double"))

    rows = _cells(df, id_col, list(weights), value, weight=weights.__getitem__)
    middle = exact_quantiles(rows, "value", [0.5], ["column"]).select(F.col("column").alias("c"), F.get("quantiles", F.lit(0)).alias("middle"))
    filled = rows.join(F.broadcast(middle), F.col("column") == F.col("c")).select("id", "column", "weight", F.coalesce("value", "middle").alias("value"))
    ends = exact_quantiles(filled, "value", [0.01, 0.99], ["column"]).select(F.col("column").alias("c"), F.get("quantiles", F.lit(0)).alias("low"), F.get("quantiles", F.lit(1)).alias("high")).where("high > low")
    scaled = filled.join(F.broadcast(ends), F.col("column") == F.col("c")).withColumn("s", (F.least(F.greatest("value", "low"), F.col("high")) - F.col("low")) / (F.col("high") - F.col("low")))
    return scaled.where("s <> 0").select("id", F.concat(F.lit("num__"), F.col("column")).alias("feature"), (F.col("s") * F.col("weight") * MULTIPLIER).alias("value"))


def categorical(df: DataFrame, id_col: str, c: str, weight: float, drop_missing: bool = False) -> DataFrame:
    return categorical_block(df, id_col, {c: weight}, (c,) if drop_missing else ())


def boolean(df: DataFrame, id_col: str, c: str, weight: float) -> DataFrame:
    return boolean_block(df, id_col, {c: weight})


def numeric(df: DataFrame, id_col: str, c: str, weight: float, logs: tuple[str, ...] = ("bet", "lines", "ways", "months")) -> DataFrame:
    return numeric_block(df, id_col, {c: weight}, logs)


def token_block(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """The 140 most frequent tokens that two or more rows and at most 55 % of rows have."""
    joined = F.regexp_replace(scalars.clean_category(F.concat_ws(" ", *columns)), "_", " ")
    rows = df.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(scalars.tokens(joined, STOP_WORDS))).alias("token"))
    most = max(2, int(df.count() * TOKEN_SHARE))
    kept = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= 2) & (F.col("n") <= most)).orderBy(F.desc("n"), "token").limit(MOST_TOKENS).select("token")
    return rows.join(F.broadcast(kept), "token", "left_semi").select("id", F.concat(F.lit("token__"), F.col("token")).alias("feature"), F.lit(TOKEN_WEIGHT * MULTIPLIER).alias("value"))


def feature_table(df: DataFrame, id_col: str, categories: dict[str, float], booleans: dict[str, float] | None = None, numbers: dict[str, float] | None = None, text: list[str] | None = None, drop_missing: tuple[str, ...] = ()) -> DataFrame:
    """All blocks and a bias per row, so that no row is the zero vector. Columns that don't exist are skipped; no block at
    all is an error. Weights of 0 exclude a column."""
    present_of = lambda weights: {c: float(w) for c, w in (weights or {}).items() if c in df.columns and w}
    made = ((categorical_block, present_of(categories), {"drop_missing": drop_missing}), (boolean_block, present_of(booleans), {}), (numeric_block, present_of(numbers), {}))
    blocks = [f(df, id_col, weights, **more) for f, weights, more in made if weights]
    if text and (present := [c for c in text if c in df.columns]):
        blocks.append(token_block(df, id_col, present))
    if not blocks:
        raise ValueError("no usable features")
    bias = df.select(F.col(id_col).alias("id"), F.lit(BIAS_FEATURE).alias("feature"), F.lit(BIAS).alias("value"))
    return reduce(DataFrame.unionByName, [*blocks, bias])


#: What kind of feature a name's block is, in the order of the table.
KINDS = {"cat__": "categorical", "bool__": "boolean", "num__": "numeric", "token__": "token"}


def described(features: DataFrame, columns: list[str], text_column: str = "theme_name") -> DataFrame:
    """Features with source_column, feature_type and feature_value, from their names: the longest of the columns that a name goes on with. Tokens
    are of `text_column`; a number's or boolean's value is its column."""
    name, kind, rest = F.col("feature"), F.lit("token"), F.lit(None).cast("string")
    for prefix, what in KINDS.items():
        kind = F.when(name.startswith(prefix), what).otherwise(kind)
        rest = F.when(name.startswith(prefix), F.substring(name, F.lit(len(prefix) + 1), F.length(name))).otherwise(rest)
    kind = F.when(name == BIAS_FEATURE, "bias").otherwise(kind)
    source = F.lit(None).cast("string")
    for c in sorted(columns, key=len):  # the longest last, so that it is asked first
        source = F.when((rest == c) | rest.startswith(c + "_"), c).otherwise(source)
    out = features.select("*", kind.alias("feature_type"), rest.alias("__rest"), source.alias("__source"))
    source = F.when(F.col("feature_type") == "bias", BIAS_FEATURE).when(F.col("feature_type") == "token", text_column).otherwise(F.coalesce("__source", "__rest"))
    value = F.when(F.col("feature_type") == "categorical", F.substring(F.col("__rest"), F.length("source_column") + 2, F.length("__rest"))).when(F.col("feature_type") == "token", F.col("__rest")).when(F.col("feature_type") == "bias", "bias").otherwise(F.col("source_column"))
    return out.withColumn("source_column", source).withColumn("feature_value", value).drop("__rest", "__source")


def feature_metadata(features: DataFrame, n_rows: int, forbidden: tuple[str, ...] = (), weights: dict[str, float] | None = None, columns: list[str] | None = None, theme_column: str | None = None, text_column: str = "theme_name") -> DataFrame:
    """A row per feature: feature_column, its friendly name, source column (and friendly name), group, type, value, base weight, multiplier, final
    weight, activity, mean and maximum of its values, whether it is a missing or other level, and whether reports show it.

    `columns` (default: those of `weights`) are the columns that features may come from. Features of `theme_column` are a group of their own. A
    forbidden part in a name is an error.
    """
    weights = weights or {}
    sums = features.groupBy("feature").agg(F.count_if(F.col("value") > 0).alias("active_count"), F.sum("value").alias("total"), F.max("value").alias("max_weighted_value"))
    if forbidden:
        bad = sums.where(F.lower("feature").rlike("|".join(forbidden))).limit(1).collect()
        if bad:
            raise ValueError(f"forbidden feature {bad[0]['feature']}")
    out = described(sums, list(columns or weights), text_column)
    value = F.lower(F.trim("feature_value"))
    missing = F.when(F.col("feature_type") == "bias", F.lit(False)).otherwise(value.isin(*scalars.MISSING_VALUES))
    friendly = F.initcap(F.replace("source_column", F.lit("_"), F.lit(" ")))
    shown = F.when(F.col("feature_type") == "bias", "Profile bias").when(F.col("feature_type").isin("boolean", "numeric"), friendly).otherwise(F.concat_ws(": ", friendly, F.nullif(scalars.value_label("feature_value"), F.lit(""))))
    base = F.lit(None).cast("double")
    for c, w in weights.items():
        base = F.when(F.col("source_column") == c, float(w)).otherwise(base)
    base = F.when(F.col("feature_type") == "bias", BIAS).when(F.col("feature_type") == "token", TOKEN_WEIGHT).otherwise(base)
    times = F.when(F.col("feature_type") == "bias", 1.0).otherwise(MULTIPLIER)
    group = F.when(F.col("source_column") == theme_column, "semantic_theme_category").otherwise(F.col("feature_type")) if theme_column else F.col("feature_type")
    return out.select(
        F.col("feature").alias("feature_column"), shown.alias("friendly_feature_name"), "source_column", friendly.alias("friendly_source_name"), group.alias("feature_group"), "feature_type", "feature_value",
        base.alias("base_weight"), times.alias("multiplier"), (base * times).alias("final_weight"), "active_count", (F.col("active_count") / n_rows).alias("active_rate"), (F.col("total") / n_rows).alias("mean_weighted_value"),
        "max_weighted_value", missing.alias("is_missing_or_other"), (~missing & (F.col("feature_type") != "bias")).alias("is_reportable"),
    )
