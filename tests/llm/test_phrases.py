"""Phrase mining against brute force and SQL, with many shards and few; suffix arrays against sorting."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import phrases
from brindle.llm.common import remove_folder, scratch_folder
from brindle.llm.oracle import OP11

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def by_force(rows, least, longest, percent, top):
    counts, totals, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        found, kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}, []
        for p, a in found.items():
            if any(len(o) > len(p) and 100 * b >= percent * a and any(o[i : i + len(p)] == p for i in range(len(o))) for o, b in found.items()):
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def odd_rows():
    random.seed(3)
    words = ["a", "B", "c", "été", "ÉTÉ", "d", "日本"]
    text = lambda n: "".join(random.choice(words) + random.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", " \r\n"]) for _ in range(n))
    rows = [(random.choice(["en", "de", None, "und"]), text(random.randrange(60))) for _ in range(300)]
    rows += [("en", None), (None, None), ("en", ""), ("fr", " ., "), ("en", "x y z " * 4000), ("de", text(5000))] + [("en", "the same text again, and again")] * 80
    rows += [("en", "run run run run run")] * 30 + [("de", "run run")] * 9 + [("en", "nbsp stays one word")] * 12
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(odd_rows(), "lang string, text string").repartition(5)
    return rows.withColumns({"word": F.lit(1), "phrase": F.lit(None).cast("string"), "shard": F.lit("s"), "place": F.lit(0)})


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("least, longest, percent, top, shard_bytes", [(10, 5, 100, 2000, 1 << 20), (5, 5, 90, 20, 500), (30, 3, 100, 7, 3000)])
def test_by_force(odd, least, longest, percent, top, shard_bytes):
    assert got(phrases.collocations(odd, least=least, longest=longest, percent=percent, top=top, shard_bytes=shard_bytes)) == by_force(odd_rows(), least, longest, percent, top)


def test_cells_that_hold_much_more_than_a_phrase_lose_none(odd, monkeypatch):
    """With a few cells for all n-grams, every cell is heavy and the exact counts do the work."""
    monkeypatch.setattr(phrases, "WORDS_PER_CELL", 10**9)
    monkeypatch.setattr(phrases, "PART_BITS", 3)
    assert got(phrases.collocations(odd, least=10, shard_bytes=2000)) == by_force(odd_rows(), 10, 5, 100, 2000)


def test_a_frequent_phrase_is_a_row_per_team(spark):
    """Shards of one task are added up before their n-grams are sent, so rows don't follow phrases times shards."""
    docs = spark.range(600).repartition(4).select(F.lit("en").alias("lang"), F.lit("one and the same text").alias("text"))
    folder = scratch_folder(spark, "phrases-test")
    _, levels = phrases.candidates(docs, "lang", "text", 100, 5, 8, folder)
    sent = spark.read.parquet(f"{folder}/words2").groupBy("name").count().agg(F.max("count")).first()[0]
    found = [(r["words"], r["f"]) for r in levels[-1].collect()]
    remove_folder(spark, folder)
    assert found == [(["one", "and", "the", "same", "text"], 600)]
    assert sent <= 600 / 8


def test_teams():
    for shards, tasks in ((0, 4), (1, 4), (5, 4), (129, 4), (1000, 1), (7, 200)):
        teams = phrases.teams_of(shards, tasks)
        assert teams <= shards <= teams * phrases.TEAM and (teams == shards or teams % tasks == 0)


def test_empty_table(odd):
    assert phrases.collocations(odd.limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    rows = [(10**12 + 7, 3 * 10**13 + 1, 10**6, 999_983), (10**14, 10**15, 10**14, 10**14), (100, 10**15, 10**15, 10**15 - 1)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long").select("*", phrases.score("a", "n", F.col("l"), F.col("r")).alias("s"))
    assert [r["s"] for r in df.collect()] == [1000 * a * n // (l * r) for a, n, l, r in rows]


def test_suffix_arrays():
    random.seed(7)
    for depth in (1, 2, 3, 4, 5, 7):
        words = np.array([random.choice([0, 1, 1, 2, 3]) for _ in range(400)] + [0], dtype=np.int32)
        suffixes, common = phrases.suffix_array(words, depth)

        def start(i):
            cut = list(words[i : i + depth])
            return cut[: cut.index(0)] if 0 in cut else cut

        full = [list(words[i : i + depth]) + [0] * (depth - len(words[i : i + depth])) for i in suffixes]
        assert sorted(suffixes) == list(np.flatnonzero(words)) and full == sorted(full)
        for i, (a, b) in enumerate(zip(suffixes, suffixes[1:]), 1):
            x, y = start(a), start(b)
            assert common[i] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({OP11})").fetchall())
    rows = got(phrases.collocations(spark.read.parquet(f"{SF}/documents.parquet")))
    assert rows == want and len(rows) > 10
