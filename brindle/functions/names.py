"""Naming policies and column resolution; all on the driver, over column names."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def standardize_name(name: str, lower: bool = True) -> str:
    """Trimmed, lower-cased, white space and -/ as _, other signs dropped, _ squeezed and stripped."""
    out = name.strip().lower() if lower else name.strip()
    out = re.sub(r"[-/]+", "_", re.sub(r"\s+", "_", out))
    return re.sub(r"_+", "_", re.sub(r"[^\w]", "", out)).strip("_")


def snake_name(name: str) -> str:
    """The other policy: any run of signs is one _ (`A&B` is a_b here, ab above)."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def flag_name(prefix: str, value: str) -> str:
    return f"{prefix}_{re.sub(r'[^a-z0-9]+', '_', value.lower()).strip('_') or 'blank'}"


def flag_names(prefix: str, values: list[str]) -> dict[str, str]:
    """A name for each value in order; later ones that collide get _2, _3, ..."""
    out, used = {}, Counter()
    for v in values:
        name = flag_name(prefix, v)
        used[name] += 1
        out[v] = name if used[name] == 1 else f"{name}_{used[name]}"
    return out


#: What changes in a feature column's name as readers see it: its block's prefix (fixed values; only where the name starts), the missing level, underscores.
_SHOWN = re.compile(r"\A(?:cat|bool|num|token)__|(?P<level>__missing__)|(?P<gap>_)")


def label(feature: str, limit: int = 68) -> str:
    """A feature column as words: without its block's prefix, the missing level named, cut at `limit` signs. A prefix inside a name is
    part of the name."""
    return _SHOWN.sub(lambda m: "missing" if m["level"] else " " if m["gap"] else "", feature)[:limit]


def file_name(text: str, limit: int = 80) -> str:
    """The runs of letters and digits, in lower case, joined by _ and cut at `limit` signs; `item` if there are none."""
    return "_".join(re.findall("[a-z0-9]+", str(text).lower(), re.A))[:limit] or "item"


def rename(df: DataFrame, mapping: dict[str, str] | None = None, standardize: bool = True, lower: bool = True) -> DataFrame:
    """Explicit renames, then standard names, at once (so swaps work); names that meet are an error."""
    names = [(mapping or {}).get(c, c) for c in df.columns]
    names = [standardize_name(c, lower) for c in names] if standardize else names
    twice = sorted(c for c, n in Counter(names).items() if n > 1)
    if twice:
        raise ValueError(f"duplicate column names: {twice}")
    return df.toDF(*names)


def resolve(df: DataFrame, name: str) -> str:
    """The column of that name whatever its case; none or several are errors."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"column {name!r} is {'ambiguous' if found else 'missing'} in {df.columns}")
    return found[0]


def as_list(value) -> list[str]:
    return [] if value is None else [value] if isinstance(value, str) else list(value)
