"""Scalar expressions: lenient parsing, cleaning, standardization, buckets, dates. All Catalyst expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def parse_number(c, currency: bool = False) -> Column:
    """Text as double without `,` and `%` (and `$` with `currency`); null if it isn't a number."""
    return F.regexp_replace(F.trim(text(c)), r"[,%$]" if currency else "[,%]", "").try_cast("double")


def clean_text(c, tokens: tuple[str, ...] = (), recheck: bool = True, lower: bool = True) -> Column:
    """Trimmed and, unless `lower` is off, lower-cased; null if plain digits (with decimals) or, with `recheck`, a missing token."""
    x = F.lower(F.trim(text(c))) if lower else F.trim(text(c))
    bad = x.rlike(r"^\d+(\.\d+)?$")
    missing = sorted({t.strip().lower() if lower else t.strip() for t in tokens})
    return F.when(bad | x.isin(missing) if missing and recheck else bad, None).otherwise(x)


def parse_date(c, pattern: str | None = None) -> Column:
    """A date by a pattern, or leniently as a timestamp; null if it isn't one."""
    return F.to_date(F.try_to_timestamp(text(c), F.lit(pattern)) if pattern else text(c).try_cast("timestamp"))


def lookup(c, mapping: dict[str, str], lower: bool = True) -> Column:
    """Cleaned text, mapped if a key; keys are cleaned too. One constant map in the plan."""
    x = F.lower(F.trim(text(c))) if lower else F.trim(text(c))
    if not mapping:
        return x
    table = F.create_map(*[F.lit(v) for k, m in {k.strip().lower() if lower else k.strip(): m for k, m in mapping.items()}.items() for v in (k, m)])
    return F.coalesce(F.try_element_at(table, x), x)


def ownership(c, owned: tuple[str, ...], leased: tuple[str, ...], leased_part: tuple[str, ...], owned_part: tuple[str, ...]) -> Column:
    """Rule cascade: exact owned, exact leased, contains a leased part, contains an owned part and no `lease`, null."""
    x = F.lower(F.trim(text(c)))

    def any_of(parts):
        out = F.lit(False)
        for p in parts:
            out = out | x.contains(p)
        return out

    return F.when(x.isin(*owned), "owned").when(x.isin(*leased), "leased").when(any_of(leased_part), "leased").when(any_of(owned_part) & ~x.contains("lease"), "owned")


def recode(c, mapping: dict[str, str]) -> Column:
    """CASE over lower-cased values; others as they are (lower-cased)."""
    x = F.lower(text(c))
    out = x
    for old, new in mapping.items():
        out = F.when(x == old, new).otherwise(out)
    return out


def correction(c, fallback) -> Column:
    """Lower-cased: `no_match` for text with ? or `no match`, the fallback for null, else itself."""
    x = text(c)
    return F.lower(F.when(x.contains("?"), "no_match").when(x == "no match", "no_match").when(x.isNull(), text(fallback)).otherwise(x))


def norm_text(c) -> Column:
    """Trimmed, lower-cased, white space squeezed; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(text(c)), r"\s+", " ")), F.lit(""))


def clean_category(c) -> Column:
    """norm_text without brackets, quotes and backslashes; `__missing__` if nothing is left."""
    return F.coalesce(norm_text(F.regexp_replace(text(c), r"""[\[\]{}()'"\\]""", "")), F.lit("__missing__"))


def bucket(c, mapping: dict[str, str], other: str = "Other") -> Column:
    """The exact key's value, else that of the first key (in order) within the text, else `other`; blank is null."""
    x = norm_text(c)
    out = F.lit(other)
    for k, v in reversed(mapping.items()):
        out = F.when(x.contains(k.lower()), v).otherwise(out)
    for k, v in reversed(mapping.items()):
        out = F.when(x == k.lower(), v).otherwise(out)
    return F.when(x.isNotNull(), out)


def regex_bucket(c, rules: dict[str, list[str]], default: str, plural: bool = False) -> Column:
    """The first bucket one of whose words stands in the text as a word."""
    x = F.lower(F.coalesce(text(c), F.lit("")))
    out = F.lit(default)
    for name, words in reversed(rules.items()):
        out = F.when(x.rlike(word_pattern(words, plural)), name).otherwise(out)
    return out


def word_pattern(words: list[str], plural: bool = False) -> str:
    return rf"(?<![a-z0-9])(?:{'|'.join(words)}){'s?' if plural else ''}(?![a-z0-9])"


#: The theme buckets in order, each with its words, and the bucket of texts without any.
THEME_BUCKETS = {
    "ancient_civilizations": ["egypt", "egyptian", "incan", "mayan", "aztec", "roman", "greek", "ramosis", "cleopatra"],
    "fantasy_mythology": ["fantasy", "myth", "genie", "fairy", "fairies", "dragon", "magic", "wizard", "phoenix"],
    "nature_animals": ["animal", "buffalo", "wolf", "tiger", "lion", "cat", "dog", "fish", "ocean", "sea", "jungle", "forest", "island", "eagle", "bear"],
    "adventure_exploration": ["pirate", "viking", "treasure", "quest", "voyage", "adventure", "expedition", "frontier"],
    "entertainment_characters": ["movie", "tv", "music", "show", "star", "celebrity", "cartoon", "character", "carnival", "carnivale"],
    "culture_regional": ["asian", "china", "chinese", "japan", "irish", "italian", "latin", "western", "country", "native", "australian"],
    "luxury_classic": ["gold", "diamond", "gem", "wealth", "cash", "money", "royal", "king", "queen", "classic", "casino", "jackpot"],
    "scifi_mystery": ["space", "sci", "mystery", "horror", "alien", "planet", "moon", "galaxy"],
    "seasonal_misc": ["winter", "fire", "heat", "holiday", "christmas", "number", "lucky", "superstition", "car", "cars"],
    "format_non_theme": ["video", "stepper", "reel", "multigame", "multi game", "etg", "bank", "flex", "fusion", "sync", "renegade", "barcrest"],
}
NO_THEME = "uncategorized_theme"
#: How semantic theme buckets are shown, and the levels that are shown as nothing.
VALUE_LABELS = {
    "ancient_civilizations": "Ancient Civilizations", "fantasy_mythology": "Fantasy / Mythology", "nature_animals": "Nature / Animals",
    "culture_regional": "Culture / Regional", "entertainment_licensed": "Entertainment / Licensed", "adventure_exploration": "Adventure / Exploration",
    "seasonal_holiday": "Seasonal / Holiday", "sports_games": "Sports / Games", "food_drink": "Food / Drink", "vehicles_speed": "Vehicles / Speed",
    "mystery_scifi": "Mystery / Sci-Fi", "luxury_classic": "Luxury / Classic",
}
MISSING_VALUES = ("__missing__", "__other__", "uncategorized_theme", "missing", "nan", "none", "null", "")


def theme(*columns) -> Column:
    """The theme bucket of several texts joined, nulls left out. A word is bounded by anything but letters, digits and _."""
    x = F.lower(F.concat_ws(" ", *[text(c) for c in columns]))
    out = F.lit(NO_THEME)
    for name, words in reversed(THEME_BUCKETS.items()):
        out = F.when(x.rlike(rf"\b(?:{'|'.join(words)})\b"), name).otherwise(out)
    return out


def value_label(c, labels: dict[str, str] | None = None) -> Column:
    """A level as readers see it: nothing for missing ones, its label if it has one, else its words with capitals."""
    x = clean_category(c)
    out = F.initcap(F.replace(x, F.lit("_"), F.lit(" ")))
    for k, v in (VALUE_LABELS if labels is None else labels).items():
        out = F.when(x == k, v).otherwise(out)
    return F.when(x.isin(*MISSING_VALUES), "").otherwise(out)


def search_text(*columns) -> Column:
    """Texts joined, lower-cased, with a space for every run of signs other than a-z and 0-9; nulls and `nan` are left out."""
    shown = [F.nullif(F.lower(F.trim(text(c))), F.lit("nan")) for c in columns]
    return F.trim(F.regexp_replace(F.concat_ws(" ", *shown), "[^a-z0-9]+", " "))


def plain_phrase(keyword: str) -> str:
    return re.sub("[^a-z0-9]+", " ", keyword.lower()).strip()


def word_runs(words: Column, longest: int) -> Column:
    """All runs of 1 to `longest` words of an array, joined by spaces, and each that ends with s also without it."""
    runs, last = [words], words
    for n in range(2, longest + 1):
        last = F.zip_with(last, F.slice(words, F.lit(n), F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
        runs.append(last)
    every = F.concat(*runs) if len(runs) > 1 else words
    return F.concat(every, F.transform(F.filter(every, lambda r: r.endswith("s")), lambda r: F.substring(r, F.lit(1), F.length(r) - 1)))


def tokens(c, stop: tuple[str, ...] = (), least: int = 3) -> Column:
    """Runs of a-z0-9 of three or more signs that are no stop word and not digits alone."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text(c), F.lit(""))), F.lit("([a-z0-9]+)"), 1)
    return F.filter(found, lambda t: (F.length(t) >= least) & ~t.rlike("^[0-9]+$") & (~t.isin(*stop) if stop else F.lit(True)))


def calendar_months(start, end) -> Column:
    """Months between two dates by year and month; the day doesn't count."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


#: The upper bounds of ages in months and the names of their buckets.
AGE_BUCKETS = ((6, "0_5_months"), (12, "6_11_months"), (24, "12_23_months"), (48, "24_47_months"), (84, "48_83_months"))
OLDEST, UNKNOWN_AGE = "84_plus_months", "unknown_age"


def age_bucket(months) -> Column:
    m = F.col(months) if isinstance(months, str) else months
    out = F.lit(OLDEST)
    for bound, name in reversed(AGE_BUCKETS):
        out = F.when(m < bound, name).otherwise(out)
    return F.when(m.isNull(), UNKNOWN_AGE).otherwise(out)


def parse_bool(c) -> Column:
    """true/1/y/yes/t, false/0/n/no/f, else a number's being other than 0, else null."""
    x = F.lower(F.trim(text(c)))
    return F.when(x.isin("true", "1", "y", "yes", "t"), True).when(x.isin("false", "0", "n", "no", "f"), False).otherwise(x.try_cast("double") != 0)


def log1p_clip(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))


def clip01(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Null (never an error) where the whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)
