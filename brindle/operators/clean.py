"""Column cleaning, projections and filters; each is DataFrame to DataFrame in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from brindle.functions import scalars
from brindle.functions.names import resolve
from brindle.operators.persist import fixed

DEFAULT_TOKENS = ("-", "--", "", " ", "N/A", "n/a", "NULL", "null")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def apply_filters(df: DataFrame, wanted: dict) -> DataFrame:
    """Rows that equal every wanted value (null never does); a missing column is an error."""
    for c, v in wanted.items():
        if c not in df.columns:
            raise ValueError(f"no column {c!r} to filter by")
        df = df.where(F.col(c) == F.lit(v))
    return df


def keep_in(df: DataFrame, c: str, values: list[str]) -> DataFrame:
    """Rows whose trimmed, lower-cased text is one of the values."""
    return df.where(F.lower(F.trim(c)).isin([v.strip().lower() for v in values]))


def exclude_in(df: DataFrame, c: str, values: list[str]) -> DataFrame:
    """Rows whose value is none of these; nulls stay."""
    return df.where(~F.col(c).isin(values) | F.col(c).isNull())


def drop_deleted(df: DataFrame, c: str) -> DataFrame:
    """Rows not marked as deleted; null isn't a mark."""
    return df.where(~F.coalesce(scalars.parse_bool(c), F.lit(False)))


def null_tokens(df: DataFrame, tokens=DEFAULT_TOKENS, trimmed: bool = False) -> DataFrame:
    """Tokens in text columns become null: exact, or where the trimmed text is one (others keep their spaces)."""
    strings = set(string_columns(df))
    return df.select(*[F.when(~(F.trim(c) if trimmed else F.col(c)).isin(list(tokens)), F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns])


def clean_columns(df: DataFrame, numeric=(), strings=(), dates=(), date_formats: dict | None = None, typos: dict | None = None, tokens=DEFAULT_TOKENS, lower: bool = True) -> DataFrame:
    """Null tokens, then number, text and date parsing and typo maps of the configured columns that exist. A typo map
    applies at once: what one entry gives isn't looked up again."""
    df, date_formats, typos = null_tokens(df, tokens), date_formats or {}, typos or {}

    def of(c: str):
        if c in numeric:
            out = scalars.parse_number(c)
        elif c in strings:
            out = scalars.clean_text(c, tuple(tokens), lower=lower)
        elif c in dates:
            out = scalars.parse_date(c, date_formats.get(c))
        else:
            out = F.col(c)
        fixed = out
        for old, new in typos.get(c, {}).items():
            fixed = F.when(out == old, F.lit(new)).otherwise(fixed)
        return fixed.alias(c)

    return df.select(*[of(c) for c in df.columns])


def fill_from(df: DataFrame, fallbacks: dict[str, list[str]], drop: bool = False, nan_is_null: bool = False) -> DataFrame:
    """Each primary column becomes the first non-null of itself and its fallbacks, as far as they exist. NaN counts as a
    value unless `nan_is_null`."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))}
    value = lambda c: F.when(~F.isnan(c), F.col(c)) if nan_is_null and c in floats else F.col(c)
    new, gone = {}, set()
    for primary, others in fallbacks.items():
        found = [c for c in [primary, *others] if c in df.columns]
        if found:
            new[primary] = F.coalesce(*[value(c) for c in found])
            gone |= {c for c in others if c in df.columns and c != primary}
    out = df.withColumns(new)
    return out.drop(*(gone - set(fallbacks))) if drop else out


def drop_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the columns that hold nulls alone: one aggregation over all. An empty table keeps its columns."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(f"__{i}") for i, c in enumerate(df.columns)]).first()
    return df if not counts["__rows"] else df.select(*[c for i, c in enumerate(df.columns) if counts[f"__{i}"]])


def normalize_text(df: DataFrame) -> DataFrame:
    """All text columns trimmed and lower-cased."""
    strings = set(string_columns(df))
    return df.select(*[F.lower(F.trim(c)).alias(c) if c in strings else F.col(c) for c in df.columns])


def lower_only(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns, lower-cased, and no others."""
    return df.select(*[F.lower(resolve(df, c)).alias(c) for c in columns])


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first by an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(w)).where("__first = 1").drop("__first")


def keyword_buckets(df: DataFrame, columns: list[str], rules: dict[str, list[str]], bucket: str = "bucket", keywords: str = "keywords", limit: int = 6, none: str = "__missing__") -> DataFrame:
    """Adds the first bucket that has a keyword in the texts, and the first `limit` of its keywords, in the rules' order, that they have, joined by
    `, `. A keyword is a run of whole words of the normalized text, whose last one may have an s more (`sci-fi` is `sci fi`, `king` is in
    `kings`). Texts without any get `none` and nothing.

    The text's runs of words, as long as the longest keyword, meet the keywords in one set intersection a row, which keeps the keywords'
    order; no pattern is tried.
    """
    known: dict[str, tuple[str, str]] = {}
    for b, words in rules.items():
        for k in words:
            if phrase := scalars.plain_phrase(k):
                known.setdefault(phrase, (b, k))
    if not known:
        return df.withColumns({bucket: F.lit(none), keywords: F.lit("")})
    longest = max(len(p.split()) for p in known)
    entries = F.create_map(*[x for p, (b, k) in known.items() for x in (F.lit(p), F.struct(F.lit(b).alias("b"), F.lit(k).alias("k")))])
    hits = F.array_intersect(F.array(*[F.lit(p) for p in known]), scalars.word_runs(F.split(scalars.search_text(*columns), " "), longest))
    found = df.withColumn("__found", F.transform(hits, lambda p: F.element_at(entries, p)))
    first = found.withColumn("__first", F.get("__found", F.lit(0))["b"])
    own = F.transform(F.filter("__found", lambda x: x["b"] == F.col("__first")), lambda x: x["k"])
    return first.withColumns({bucket: F.coalesce("__first", F.lit(none)), keywords: F.array_join(F.slice(own, 1, limit), ", ")}).drop("__found", "__first")


def dense_ids(df: DataFrame, order: list, name: str = "profile_id", parts: int | None = None) -> DataFrame:
    """Gapless ids from 0 in the given order; rows alike in it are numbered in any order.

    One range shuffle and a sort in each partition, whose outcome is fixed in files before it is used twice: its counts, a row per
    partition, give where each starts. (Without that, each use would sample bounds of its own.) Rows alike in the order
    share a partition.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the id that Spark gives has the partition above bit 33 and the row's place in it below
    placed = fixed(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    start = F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", start.alias("__start"))
    return placed.join(F.broadcast(starts), part == F.col("__part")).withColumn(name, F.col("__start") + place).drop("__at", "__part", "__start")
