"""Exact quantiles, bounded lists, imputation by level, keyword buckets, split UTF-16 files."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import aggregate, clean, features, impute, quantiles
from brindle.sources import readers


def test_quantiles_of_odd_groups(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 5)
    random.seed(1)
    groups = {
        "one": [3.0], "same": [2.5] * 500, "ints": [float(random.randrange(50)) for _ in range(999)], "normal": [random.gauss(0, 1) for _ in range(1500)],
        "magnitudes": [random.choice([-1, 1]) * 10.0 ** random.uniform(-300, 300) for _ in range(1500)], "edge": [1.7e308, -1.7e308, float("inf"), float("-inf"), 0.0, 5e-324] * 40,
        "skew": [1.0] * 1000 + [1.0 + i * 1e-12 for i in range(400)] + [1e12], None: [float(i) for i in range(40)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("none", float("nan")), ("ints", None), ("ints", float("nan"))]
    random.shuffle(rows)
    fractions = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r["g"]: (r["n"], r["quantiles"]) for r in quantiles.exact_quantiles(df, "v", fractions, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        own = sorted(vs)
        assert got[g][0] == len(own)
        for q, v in zip(fractions, got[g][1]):
            at = q * (len(own) - 1)
            low, high = own[int(np.floor(at))], own[int(np.ceil(at))]
            want = low if low == high else low * (1 - (at - np.floor(at))) + high * (at - np.floor(at))
            assert v == want or np.isclose(v, want, rtol=1e-12) or np.isnan(want)


def test_quantiles_hold_no_group(spark):
    df = spark.range(300_000).select(F.pow(F.col("id").cast("double"), 1.5).alias("v"))
    row = quantiles.exact_quantiles(df, "v", [0.5, 0.999]).first()
    assert row["n"] == 300_000 and np.allclose(row["quantiles"], [(149_999**1.5 + 150_000**1.5) / 2, np.interp(0.999 * 299_999, [299_699, 299_700], [299_699**1.5, 299_700**1.5])])
    plan = quantiles.exact_quantiles(df, "v", [0.5])._jdf.queryExecution().toString()
    assert "percentile" not in plan and "median" not in plan
    assert quantiles.exact_quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_lists_of_a_hot_key_are_bounded(spark):
    """A million names of one key, and few of another: eight of each, and no task holds more than eight of each part."""
    df = spark.range(1_000_000).select(F.when(F.col("id") % 1000 == 0, "b").otherwise("a").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("v"), (-F.col("id")).alias("o"))
    got = {r["k"]: r["x"] for r in quantiles.top_distinct(df, ["k"], "v", F.col("o"), 8, "x").collect()}
    assert got == {"a": [f"n{999_999 - i}" for i in range(8)], "b": [f"n{999_000 - 1000 * i}" for i in range(8)]}
    rows = spark.createDataFrame([(1, " A  b", "x", 2.0), (1, "a B", "y", None), (1, None, "x", 9.0), (1, "c", None, 2.0), (2, "d", "no", 1.0)], "k int, n string, m string, s double")
    out = aggregate.relation_profile(rows, "k", "n", "m", "s", {"y": 1, "x": 2}, ["no"]).collect()
    assert len(out) == 1 and (out[0]["best_name"], out[0]["best_method"], out[0]["best_score"], out[0]["names"], out[0]["methods"], out[0]["n_names"], out[0]["n_rows"]) == ("a b", "y", 2.0, ["a b", "c"], ["y", "x"], 2, 3)


@pytest.mark.parametrize("seed", [1, 2])
def test_imputation_by_level_by_force(spark, seed):
    random.seed(seed)
    rows = [(random.choice([None, 1, 2]), random.choice([None, "x", "y", "z"]), random.randrange(3), random.choice([None, None, None, 1, 2, 3])) for _ in range(120)]

    def mode(now, keys, row):
        counts = {}
        for r in now:
            if r[3] is not None and all(r[k] == row[k] for k in keys):
                counts[r[3]] = counts.get(r[3], 0) + 1
        return min(counts, key=lambda v: (-counts[v], v)) if counts else None

    now, filled = [list(r) for r in rows], []
    for keys in ([0, 1, 2], [0, 1], [0]):
        new = [[*r[:3], r[3] if r[3] is not None else mode(now, keys, r)] for r in now]
        filled.append(sum(a[3] is None and b[3] is not None for a, b in zip(now, new)))
        now = new
    out, counts = impute.impute_by_hierarchy(spark.createDataFrame(rows, "a int, b string, c int, v int"), "v", ["a", "b", "c", "v"])
    assert sorted(map(str, map(list, out.collect()))) == sorted(map(str, now)) and [c["filled"] for c in counts] == filled


def test_keyword_buckets(spark):
    rules = {"film": ["karate kid", "sci-fi"], "none of these": ["!"], "royal": ["king", "queen", "crown", "jewels"], "late": ["king", "dog"]}
    texts = ["The Karate-Kids!", "SCI  FI night", "two kings, a queen, crowns and jewels", "dogs", "kingdom", None, "", "nan", "karate only kid", "king dog " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: (r["bucket"], r["keywords"]) for r in clean.keyword_buckets(df, ["t"], rules, limit=3).collect()}
    none = ("__missing__", "")
    assert got == {0: ("film", "karate kid"), 1: ("film", "sci-fi"), 2: ("royal", "king, queen, crown"), 3: ("late", "dog"), 4: none, 5: none, 6: none, 7: none, 8: none, 9: ("royal", "king")}


@pytest.mark.parametrize("charset, ends", [("utf-16-le", "\n"), ("utf-16-be", "\r\n")])
def test_utf16_files_are_split(spark, tmp_path, charset, ends):
    rows = [(str(i), f"été {i} 日本 \U0001f600" if i % 3 else "", "x" * (i % 50)) for i in range(60_000)]
    text = "﻿key\tname\tpad" + ends + ends.join("\t".join(r) for r in rows) + ends
    (tmp_path / "a.txt").write_bytes(text.encode(charset))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500000")
    try:
        split = readers.read_utf16(spark, str(tmp_path))
        assert split.rdd.getNumPartitions() > 5 and split.columns == ["key", "name", "pad"]
        whole = readers.read_utf16(spark, str(tmp_path), whole_files=True)
        assert whole.exceptAll(split).count() == 0 and split.count() == whole.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("field", ["ੁĀ", '"two\nlines"'])
def test_utf16_files_that_cannot_be_split(spark, tmp_path, field):
    """Letters whose bytes look like a line end, and a line end within quotes."""
    (tmp_path / "b.txt").write_bytes(("﻿k\tv\n1\t" + field + "\n2\tplain\n").encode("utf-16-le"))
    assert [tuple(r) for r in readers.read_utf16(spark, str(tmp_path)).collect()] == [("1", field.strip('"')), ("2", "plain")]


def test_jobs_do_not_follow_the_number_of_columns(spark):
    """Feature tables of 3 and of 30 columns take as many jobs."""
    sc = spark.sparkContext
    df = spark.range(300).select("id", *[(F.col("id") % (i + 2)).cast("string").alias(f"c{i}") for i in range(10)], *[F.when(F.col("id") % (i + 2) == 0, "yes").alias(f"b{i}") for i in range(10)], *[(F.col("id") % (50 + i)).alias(f"n{i}") for i in range(10)])

    def jobs(n):
        sc.setJobGroup(f"columns {n}", "")
        names = lambda p: {f"{p}{i}": 1.0 for i in range(n)}
        rows = features.feature_table(df, "id", names("c"), names("b"), names("n")).groupBy(F.regexp_extract("feature", "^([a-z]+__[a-z0-9]+)", 1).alias("f")).count().collect()
        found = len(sc.statusTracker().getJobIdsForGroup(f"columns {n}"))
        sc._jsc.clearJobGroup()
        return found, len(rows)

    few, many = jobs(1), jobs(10)
    assert (few[1], many[1]) == (4, 31) and many[0] <= few[0] + 6


def test_relation_profile_reads_twice_and_normalizes_once(spark):
    rows = [(f" K{i % 3} ", f"N  {i % 40:02d}" if i % 7 else " ", ("y", "x ", "no", None)[i % 4], float(i % 5) if i % 6 else float("nan"), f"2020-01-{i % 28 + 1:02d}") for i in range(900)]
    df = spark.createDataFrame(rows, "k string, n string, m string, s double, d string")
    out = aggregate.relation_profile(df, "k", "n", "m", "s", {"y": 1, "x": 2}, ["no"], date="d", most_names=5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2 and plan.count("regexp_replace") <= 6

    def order(r):
        score = -r[3] if r[3] == r[3] else 1e300
        return ({"y": 1, "x": 2}.get(r[2], 99), score, r[1])

    kept = [(r[0].strip().lower(), r[1].strip().lower().replace("  ", " "), r[2] and r[2].strip(), r[3], r[4]) for r in rows]
    kept = [r for r in kept if r[1] and r[2] != "no"]
    for got in out.collect():
        mine = sorted((r for r in kept if r[0] == got["k"]), key=order)
        names, methods = list(dict.fromkeys(r[1] for r in mine)), list(dict.fromkeys(r[2] for r in mine if r[2]))
        assert got["names"] == names[:5] and got["n_names"] == len(names) and got["n_rows"] == len(mine)
        assert got["methods"] == methods and got["best_name"] == names[0] and got["best_method"] == methods[0] and got["best_priority"] == order(mine[0])[0]
        assert repr(got["best_score"]) == repr(mine[0][3]) and str(got["best_date"]) == min(r[4] for r in mine if order(r) == order(mine[0]))
