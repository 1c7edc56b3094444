"""List-like text and arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIST = "array<string>"


def parse_list(c, strict: bool = True) -> Column:
    """A list literal as an array; null is empty. Text that is no list is an error when `strict`, else null."""
    x = F.col(c) if isinstance(c, str) else c
    out = F.from_json(x, _LIST, {"allowSingleQuotes": "true"})
    if strict:
        out = F.when(x.isNotNull() & out.isNull(), F.raise_error(F.concat(F.lit("not a list: "), x)).cast(_LIST)).otherwise(out)
    return F.when(x.isNull(), F.array().cast(_LIST)).otherwise(out)


def lenient_list(c) -> Column:
    """A list literal, or else text split at , ; | and /, trimmed, blanks dropped."""
    x = F.col(c) if isinstance(c, str) else c
    items = F.coalesce(F.from_json(x, _LIST, {"allowSingleQuotes": "true"}), F.split(x, r"[,;|/]+"), F.array().cast(_LIST))
    return F.filter(F.transform(items, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))


def delimited(c, lower: bool = False) -> Column:
    """Tokens of text without brackets and quotes, split at , ; and |; nan and none are no tokens."""
    x = F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"""[\[\]{}'"]""", "")
    items = F.transform(F.split(F.coalesce(x, F.lit("")), r"[,;|]"), lambda v: F.lower(F.trim(v)) if lower else F.trim(v))
    return F.filter(items, lambda v: ~F.lower(v).isin("", "nan", "none"))


def has_value(array: Column, value: str) -> Column:
    """Never null: false for null lists and for lists with null items that lack the value."""
    return F.coalesce(F.array_contains(array, value), F.lit(False))


def any_item_contains(array: Column, part: str) -> Column:
    return F.coalesce(F.exists(array, lambda v: F.lower(v).contains(part.lower())), F.lit(False))


def join_distinct(array: Column, limit: int = 8, sep: str = " | ") -> Column:
    """First-seen items, whatever their case, joined; at most `limit`."""
    items = F.filter(F.transform(array, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))
    keys = F.transform(items, lambda v: F.lower(v))
    first = F.filter(items, lambda v, i: F.array_position(keys, F.lower(v)) == i + 1)
    return F.array_join(F.slice(first, 1, limit), sep)
