"""URL filters: longest fitting rule, else a logistic regression on hashed character n-grams. All on the JVM."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.url_labels import labelled_urls

#: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BUCKETS, SIZES = 4096, (3, 4, 5)
#: The least probability that blocks; above a half, since a wanted page that is blocked costs more than the reverse.
THRESHOLD = 0.6


def url_host(url) -> F.Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or url."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url) -> F.Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def grams(host, path) -> F.Column:
    """Buckets of the distinct character n-grams; host and path are marked, so that they share no n-gram."""

    def of(text, n: int):
        at = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(at, lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(n)), F.lit(n)), F.lit(BUCKETS)).cast("int"))

    h, p = F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.lit("~"), path, F.lit("~"))
    return F.array_distinct(F.concat(*[of(x, n) for x in (h, p) for n in SIZES]))


def fit(spark: SparkSession, table: list[tuple[str, int]] | None = None, steps: int = 2000, rate: float = 2.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from a small labelled table of (url, 1 for block): full-batch gradient descent.

    The table is at most a few hundred rows, so its n-grams (made by the expression that also scores) are
    collected. Each url's n-grams weigh 1 over the root of their number.
    """
    table = labelled_urls() if table is None else table
    rows = spark.createDataFrame(table, "url string, label int").select("label", grams(url_host(F.col("url")), url_path(F.col("url"))).alias("g")).collect()
    x = np.zeros((len(rows), BUCKETS))
    for i, r in enumerate(rows):
        x[i, r["g"]] = len(r["g"]) ** -0.5
    y = np.array([r["label"] for r in rows], dtype=float)
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = (p - y) / max(len(y), 1)
        w -= rate * (x.T @ g + decay * w)
        b -= rate * g.sum()
    return w, b


def score_expr(host, path, weights: np.ndarray, bias: float) -> F.Column:
    """Probability of block. The weights are one constant array, folded by the optimizer."""
    table = F.split(F.lit(",".join(f"{v:.9g}" for v in weights)), ",").cast("array<double>")
    g = grams(host, path)
    total = F.aggregate(g, F.lit(0.0), lambda acc, i: acc + F.get(table, i))
    return 1 / (1 + F.exp(-(F.lit(float(bias)) + total / F.sqrt(F.size(g).cast("double")))))


def rule_expr(host, path, rules=RULES) -> tuple[F.Column, F.Column]:
    """The longest rule that fits (its text and verdict); nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, score (the method's probability of block).

    A rule's verdict wins over the method's. Null urls and urls without `://` have empty host and path, fit no
    rule and are judged by the method like any other. Urls of any length are read whole. Rows are judged one by
    one: repeated rows get equal verdicts, an empty table gives no rows, null ids stay, other columns are ignored.
    """
    weights, bias = fit(pages.sparkSession)
    url = F.col(url_col)
    parts = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    name, verdict = rule_expr(host, path, rules)
    scored = parts.withColumns({"rule": name, "__v": verdict, "score": score_expr(host, path, weights, bias)})
    return scored.select(id_col, "host", "path", "rule", F.coalesce("__v", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")
