"""Operators on texts against brute force, with nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brindle.llm import languages, minhash, mixing, ngrams, packing, quality, sharding, substrings

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size int, block string"


def words(text):
    return (text or "").encode().split()


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns that clash with the operators' own."""
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", None, "a", 3), (4, "one", "en", None, 3),
        (None, passage + " tail", "en", "b", 1), (None, passage + " tail", "en", "b", 1), (5, passage, "en", "a", 1),
        (5, "other words " * 40, "de", "a", 1), (6, "head " + passage + " " + passage, "en", "b", 1), (7, passage.upper(), "en", "c", 1),
        (8, "ein wort und noch ein wort " * 3000, "de", "a", 1), (9, "ça été là-bas, œuvre non \x1c sep", "fr", "b", 1), (10, "Same text here", "en", "a", 1),
        (11, "same TEXT here", "en", "a", 1), (12, "same text here\n", None, "c", 1), (13, "日本語 テキスト  です", "ja", "a", 1),
    ]
    return [(*r, "x", 7, "y") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def removed_by_force(rows, width=20):
    """Kept words of each row, by (id, text) order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, *([] if rows[i][0] is None else [rows[i][0]]), (rows[i][1] or "").encode()))
    seen, out = set(), {}
    for i in order:
        w = words(rows[i][1])
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            if key in seen:
                gone[s : s + width] = [True] * width
            seen.add(key)
        out[i] = [x for x, g in zip(w, gone) if not g]
    return out


def test_substrings(spark, odd, docs):
    for df in (odd, docs):
        rows = rows_of(df)
        kept = removed_by_force(rows)
        want = Counter((rows[i][0], len(words(rows[i][1])), len(words(rows[i][1])) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for i, k in kept.items())
        got = substrings.substring_dedup(df, texts=True, carry=("lang",)).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want
        assert all(hashlib.sha256(b" ".join(words(r["kept_text"]))).hexdigest() == r["kept_sha256"] for r in got)
        assert substrings.deduplicated_documents(df).columns == df.columns and substrings.deduplicated_documents(df).count() == len(rows)
    untouched = {(r["doc_id"], r["text"]) for r in substrings.deduplicated_documents(docs).collect()}
    assert sum((i, t) in untouched for i, t in rows_of(docs)) == sum(len(k) == len(words(rows_of(docs)[i][1])) for i, k in removed_by_force(rows_of(docs)).items())


def test_substrings_of_any_ids(spark, odd, docs):
    """String ids, and rows without ids in many blocks: the order is that of ids, then texts, wherever the rows are."""
    texts = docs.limit(120)
    named = odd.unionByName(texts, allowMissingColumns=True).withColumn("doc_id", F.concat(F.lit("document "), F.col("doc_id").cast("string")))
    without = odd.unionByName(texts, allowMissingColumns=True).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    for df in (named, without):
        rows = df.select("doc_id", "text").collect()
        want = Counter((rows[i][0], hashlib.sha256(b" ".join(k)).hexdigest()) for i, k in removed_by_force([(r[0], r[1]) for r in rows]).items())
        got = substrings.substring_dedup(df, carry=("lang",), block_bytes=20_000).collect()
        assert Counter((r["doc_id"], r["kept_sha256"]) for r in got) == want
        assert substrings.deduplicated_documents(df).dtypes == df.dtypes


def test_many_blocks_give_what_one_gives(spark, odd, docs):
    for df in (odd, docs):
        one, many = substrings.substring_dedup(df), substrings.substring_dedup(df, block_bytes=5000)
        assert Counter(map(tuple, one.collect())) == Counter(map(tuple, many.collect()))
        rounded = lambda d: sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), round(r["score"], 5)) for r in d.collect())
        a, b = rounded(ngrams.katz_scores(df)), rounded(ngrams.katz_scores(df, block_bytes=5000))
        assert [x[:4] for x in a] == [x[:4] for x in b] and all(abs(x[k] - y[k]) < 1e-3 for x, y in zip(a, b) for k in (4, 5))


def test_sketch_never_underestimates():
    layout = substrings.Layout(1 << 14, 3)
    import pyarrow as pa

    def table(texts, first):
        return pa.table({"id": pa.array(range(first, first + len(texts)), pa.int64()), "text": pa.array([t.encode() for t in texts], pa.binary())})

    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 3, 400))) for _ in range(6)]
    blocks = [substrings.Block(table(texts[:3], 0), 4), substrings.Block(table(texts[3:], 3), 4)]
    sent = substrings._table([r for i, b in enumerate(blocks) for r in substrings._sketch(b, layout, i)])
    merged = []
    for key in set(sent.column("key").to_pylist()):
        merged += substrings._merge(sent.filter(pa.compute.equal(sent.column("key"), key)), layout)
    answers = [{r[0]: (r[2], r[3]) for r in merged if r[1] == i} for i in (0, 1)]
    total = Counter(h for b in blocks for h in b.h[0].tolist())
    for b, a in zip(blocks, answers):
        found = set(substrings._candidates(b, layout, a)[0].tolist())
        assert {i for i, h in enumerate(b.h[0].tolist()) if total[h] > 1} <= found


def shingles(text, size):
    w = [x.lower() for x in words(text)]
    k = min(size, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def groups_by_force(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    root, seen = list(range(len(rows))), defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in seen[g])
        for g in s:
            seen[g].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least[i] = (len(sets[i]), min(ids, default=None) if sets[i] else rows[i][0])
    return least, [find(i) for i in range(len(rows))], sets


@pytest.mark.parametrize("size", [2, 5])
def test_minhash(spark, odd, docs, size):
    chain = [(100 + i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 60)), None, None, None, None, None, None) for i in range(12)]
    for df in (odd, docs, spark.createDataFrame(chain, SCHEMA)):
        rows = rows_of(df)
        least, group, sets = groups_by_force(rows, size)
        got = minhash.near_duplicates(df, shingle=size).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == Counter((rows[i][0], *v) for i, v in least.items())
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
        stay = minhash.distinct_documents(df, shingle=size).collect()
        assert stay == [] or stay[0].asDict().keys() == set(df.columns)
        assert len(stay) == len({g for g, s in zip(group, sets) if s}) + sum(not s for s in sets)


def test_tables_come_from_pairs_of_half_keys():
    x, ends = minhash.shingle_sets([b"a b c d e f", b"a b c d e f", b""], 2)
    m = minhash.minhashes(x, ends, 8)
    assert (m[0] == m[1]).all() and ends.tolist() == [5, 10, 10]
    assert minhash.half_keys(m, 2).shape == (3, 4)


def test_quality(spark, odd, docs):
    for df in (odd, docs):
        want = Counter()
        for i, t in rows_of(df):
            w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
            tri = Counter(zip(w, w[1:], w[2:]))
            repeat = len({p for s in range(len(w) - 2) if tri[tuple(w[s : s + 3])] > 1 for p in range(s, s + 3)})
            want[(i, len(w), sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat, len(w) < 50 or 100 * repeat > 50 * len(w))] += 1
        got = quality.quality_rules(df).collect()
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
        assert not any(r["kept"] and r["base_failed"] for r in got)
        assert len(quality.kept_documents(df).collect()) == sum(r["kept"] for r in got)


def test_an_acronym_is_no_shouting_in_any_script(spark):
    letters = {"ru": "абвгдежзик", "el": "αβγδεζηθικ", "ar": "ابتثجحخدذر", "he": "אבגדהוזחטי", "hi": "कखगघचछजझटठ", "ko": "가나다라마바사아자차", "en": "abcdefghij", "shout": "ABCDEFGHIJ"}
    text = {k: " ".join("".join(x[int(d)] for d in str(1000 + 7 * i)) for i in range(120)) for k, x in letters.items()}
    text = {k: t + " NATO" for k, t in text.items()} | {"mixed": text["shout"] + " " + text["ru"][:100]}
    df = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(text.items())], "doc_id long, text string, lang string")
    kept = {r["lang"] for r in quality.quality_rules(df, carry=("lang",)).collect() if r["kept"]}
    assert kept == set(text) - {"shout", "mixed"} == {r["lang"] for r in quality.kept_documents(df).collect()}


def test_cascade_order():
    slow = quality.Rule("slow", lambda t: t.n_repeat_words > 0)
    fast = quality.Rule("fast", lambda t: t.n_words < 3)
    never = quality.Rule("never", lambda t: False)
    m = [quality.Measured("slow", 1.0, 0.5), quality.Measured("fast", 0.1, 0.4), quality.Measured("never", 0.01, 0.0)]
    assert [r.name for r in quality.order_rules((never, slow, fast), m)] == ["fast", "slow", "never"]


def test_mixing(spark, odd, docs):
    for df in (odd, docs):
        got = mixing.mix_sources(df, carry=("source",)).collect()
        total = sum(len(words(t)) for _, t in rows_of(df))
        size = Counter()
        for r in got:
            size[r["source"]] += r["size"]
        names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        target, open_, left = {}, set(names), float(total)
        while open_:
            share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            over = {s for s in open_ if share[s] > 3 * size[s]}
            if not over:
                target |= share
                break
            target |= {s: 3.0 * size[s] for s in over}
            left, open_ = left - sum(3 * size[s] for s in over), open_ - over
        taken = Counter()
        for r in got:
            taken[r["source"]] += r["taken"]
            assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == size[r["source"]]
            assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
            assert (r["position"] is None) == (r["taken"] == 0) and (r["position"] is None or 0 <= r["position"] <= 1)
        assert all(abs(taken[s] - target[s]) <= 0.5001 for s in names)
        copies = mixing.mixed_documents(df).collect()
        assert sum(len(words(r["text"])) for r in copies) == sum(taken.values())
        key = lambda rows: sorted((str(r["doc_id"]), r["taken"], r["size"]) for r in rows)
        assert key(mixing.mix_sources(df.repartition(5), carry=("source",)).collect()) == key(got)


def test_every_copy_is_where_the_schedules_integral_reaches_it(spark, odd, docs):
    few = spark.createDataFrame([(i, f"w{i} x y z", "en", s, None, None, None, None) for i, s in enumerate("aaaabbbbbbbbcccc" * 3)], SCHEMA)
    grid = np.linspace(0, 1, 100001)
    for df in (odd, docs, few):
        got = mixing.mix_copies(df, carry=("source",)).collect()
        assert [r["position"] for r in got] == sorted(r["position"] for r in got)
        mixed = mixing.mixed_documents(df).collect()
        assert [(r["doc_id"], r["source"], len(words(r["text"]))) for r in mixed] == [(r["doc_id"], r["source"], r["words"]) for r in got]
        taken, passes = Counter(), Counter()
        for r in got:
            taken[r["doc_id"], r["source"]] += r["words"]
            passes[r["source"]] = max(passes[r["source"]], r["pass"] + 1)
        want = Counter()
        for r in mixing.mix_sources(df, carry=("source",)).collect():
            want[r["doc_id"], r["source"]] += r["taken"]
        assert taken == +want and max(passes.values()) > 1
        names = sorted({r["source"] for r in df.collect()}, key=lambda s: (s is None, (s or "").encode()))
        for k, name in enumerate(names):
            knots = mixing.SCHEDULES[k % 3]
            rate = np.interp(grid, [x[0] for x in knots], [x[1] for x in knots])
            area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)])
            copies, before = [r for r in got if r["source"] == name], 0
            total = sum(r["words"] for r in copies)
            for r in copies:
                assert abs(np.interp(r["position"], grid, area / area[-1]) - before / total) < 1e-4
                before += r["words"]
    heavy = [r["doc_id"] for r in mixing.mixed_documents(few).collect() if r["source"] == "a"]
    first = heavy[:12]
    assert len(set(first)) == 12 and heavy == (first * 3)[: len(heavy)] and len(heavy) > 12


def test_every_tenth_of_training_holds_the_scheduled_shares(spark):
    rows = [(i, "w x y z v", "en", "abc"[i % 3], None, None, None, None) for i in range(3000)]
    wide = spark.createDataFrame([r for r in rows if r[3] != "a" or r[0] % 4 == 0], SCHEMA)
    got = mixing.mix_copies(wide, carry=("source",)).collect()
    for k, name in enumerate("abc"):
        own = [r for r in got if r["source"] == name]
        total, words_in = sum(r["words"] for r in own), Counter()
        for r in own:
            words_in[min(int(r["position"] * 10), 9)] += r["words"]
        knots = mixing.SCHEDULES[k]
        for tenth in range(10):
            grid = np.linspace(tenth / 10, tenth / 10 + 0.1, 1001)
            want = np.interp(grid, [x[0] for x in knots], [x[1] for x in knots]).mean() / 10
            assert abs(words_in[tenth] / total - want) < 0.01 * want + 10 / total


def test_inverse_demand(spark):
    from pyspark.sql import functions as F

    for knots in mixing.SCHEDULES:
        rows = spark.range(101).select((F.col("id") / 100).alias("s")).select("s", mixing.inverse_demand(F.col("s"), knots).alias("t")).collect()
        grid = np.linspace(0, 1, 100001)
        rate = np.interp(grid, [k[0] for k in knots], [k[1] for k in knots])
        area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)])
        for r in rows:
            assert abs(np.interp(r["t"], grid, area / area[-1]) - r["s"]) < 1e-4


def test_sharding(spark, odd, docs):
    big = spark.range(20000).selectExpr("id AS doc_id", "cast(id % 3 AS string) AS text")
    for df in (odd, docs, big):
        got = sharding.shard_documents(df).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows_of(df))
        for s in range(16):
            assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
        assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
        texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of(df))
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    n = Counter(r["shard"] for r in got)
    assert min(n.values()) > 1100 and max(n.values()) < 1400 and 1000 < sum(r["grown_shard"] == 16 for r in got) < 1360


def test_weight_changes_move_within_changed_subtrees(spark):
    keys = spark.range(5000).selectExpr("id AS doc_id", "'x' AS text")
    tree = sharding.even_tree()
    heavier = tuple(x._replace(weight=2.0) if x.shard == 5 else x for x in tree)
    a = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(keys, tree=tree).collect()}
    b = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(keys, tree=heavier).collect()}
    region = {x.shard: x.region for x in tree}
    assert any(a[k] != b[k] for k in a)
    assert all(region[b[k]] == region[5] for k in a if a[k] != b[k])
    six = [sharding.grow(tree), sharding.grow(sharding.grow(tree))]
    c, d = ({r["doc_id"]: r["shard"] for r in sharding.shard_documents(keys, tree=t).collect()} for t in six)
    assert all(d[k] in (c[k], 17) for k in c)


def test_katz(spark, odd, docs):
    for df in (odd, docs):
        rows = [(i, [x.lower() for x in words(t)]) for i, t in rows_of(df)]
        held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
        one, two = Counter(), Counter()
        for (_, w), h in zip(rows, held):
            if not h:
                one.update([*w, 0])
                two.update(zip([1, *w], [*w, 0]))
        n, v = sum(one.values()), len(one)
        d1, d2 = (ngrams.discounts(np.array([Counter(c.values())[r] for r in range(1, 7)])) for c in (one, two))
        disc = lambda d, c: d[c - 1] if c <= 5 else 1.0
        free = sum((1 - disc(d1, c)) * c for c in one.values())
        bottom, free = (n, free) if free > 0 else (n + 1, 1.0)
        p1 = lambda w: disc(d1, one[w]) * one[w] / bottom if one[w] else free / bottom
        after = defaultdict(list)
        for (h, w), c in two.items():
            after[h].append((w, c))
        backoff = {}
        for h, f in after.items():
            total, freed = sum(c for _, c in f), sum((1 - disc(d2, c)) * c for _, c in f)
            low = total if freed > 0 else total + 1
            backoff[h] = (low, (freed if freed > 0 else 1.0) / low / (1 - sum(p1(w) for w, _ in f)))

        def p(w, h):
            if h not in after:
                return p1(w)
            c = two[(h, w)]
            return disc(d2, c) * c / backoff[h][0] if c else backoff[h][1] * p1(w)

        for h in list(after)[:20]:
            assert math.isclose(sum(p(w, h) for w in one) + p("never", h), 1, rel_tol=1e-9)
        want = sorted((str(i), h, len(w) + 1, sum(one[x] > 0 for x in [*w, 0]), n, round(sum(math.log10((one[x] + 1) / (n + v + 1)) for x in [*w, 0]), 4), round(sum(math.log10(p(x, y)) for y, x in zip([1, *w], [*w, 0])), 4)) for (i, w), h in zip(rows, held))
        got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4), round(r["score"], 4)) for r in ngrams.katz_scores(df).collect())
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert all(abs(g[k] - w[k]) < 2e-3 for g, w in zip(got, want) for k in (5, 6))


def test_katz_of_frequent_histories_and_any_ids(spark, odd, docs):
    """Spread histories, many small blocks and string ids don't change a score, and no partition gets all of a history."""
    keys = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for df, frequent in ((odd, 3), (docs.limit(150), 40)):
        held = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")) % 7 == 2
        named = df.withColumn("doc_id", F.concat(F.lit("document "), F.col("doc_id").cast("string")))
        want = sorted((str(r[0]), *r[1:]) for r in ngrams.katz_scores(named, held_out=held).select("doc_id", *keys).collect())
        got = sorted((str(r[0]), *r[1:]) for r in ngrams.katz_scores(named, held_out=held, block_bytes=20_000, frequent=frequent).select("doc_id", *keys).collect())
        assert [g[:4] for g in got] == [w[:4] for w in want]
        assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)


def test_followers_of_one_word_are_spread():
    """A block in which 20,000 different words follow one word sends no partition more than a small share of them."""
    import pyarrow as pa

    text = " ".join(f"the w{i}" for i in range(20_000)).encode()
    block = ngrams.Block(pa.table({"held_out": [False], "text": [text]}))
    bits = 4
    words_of = {k: [r for r in ngrams._send_words(block, 0, bits) if r[1] == k] for k in range(1 << bits)}
    told = pa.concat_tables([ngrams._table(ngrams._add_words(ngrams._table(rows))) for rows in words_of.values()])
    got = ngrams.Answers(told, bits)
    sent = {r[1]: r[3] for r in ngrams._send_pairs(block, got, 0, bits, 10_000)}
    assert sum(n for k, n in sent.items() if k >= 1 << bits) == 20_000
    assert max(n for k, n in sent.items() if k >= 1 << bits) < 2 * 20_000 / (1 << bits)
    together = {r[1]: r[3] for r in ngrams._send_pairs(block, got, 0, bits, 1 << 20)}
    assert max(together.values()) >= 20_000


def test_languages(spark, odd, docs):
    got = {r["doc_id"]: r for r in languages.identify_languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert held == [] or sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.95 * len(held)
    rows = languages.identify_languages(odd).collect()
    assert len(rows) == odd.count()
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3)) and 0 <= r["score"] <= 1 for r in rows)
    none = odd.selectExpr("doc_id", "text", "cast(null AS string) AS lang")
    assert {r["lang_pred"] for r in languages.identify_languages(none).collect()} == {"und"}


def test_every_label_is_learned_within_the_sample(spark, monkeypatch):
    """Labels beyond any number get a row each, and rows and their numbers stay within the documented bounds."""
    rows = [(i, f"word{i % 1300} term{i % 1300} " * (400 if i % 1300 == 7 else 1) + f"extra{i}", f"l{i % 1300}") for i in range(3900)]
    df = spark.createDataFrame(rows, "id long, text string, label string")
    got = languages.training_sample(df, "text", "label")
    assert Counter(Counter(x for x, _, _ in got).values()) == {3: 1300}
    monkeypatch.setattr(languages, "SAMPLE_ROWS", 2600)
    two = languages.training_sample(df, "text", "label")
    assert Counter(Counter(x for x, _, _ in two).values()) == {2: 1300}
    monkeypatch.setattr(languages, "SAMPLE_NUMBERS", 1300 * 50)
    few = languages.training_sample(df, "text", "label")
    assert len({x for x, _, _ in few}) == 1300
    most = defaultdict(list)
    for x, b, _ in few:
        most[x].append(len(b))
    assert all(sum(v) <= 50 or len(v) == 1 for v in most.values())


def test_tokens_equal_the_tokenizers_own(docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_tokenizer())
    encoder = packing.Encoder(packing.default_tokenizer())
    odd_texts = ["", " ", "  ", "a  b \n c\n \nd \t e  ", " x   y", "don't I'll  they've", "é\u0085 z", "\x1c x\x1c y", "日本語 テキスト  です", "<|endoftext|> a", "\n\n  x", "x\n  y", " \n", "a　 b", "a 　b", "x\x1f\x1e y \x1dz", "1 2  3", "\U0001f600 \U0001f600  ok"]
    for t in odd_texts + [t for _, t in rows_of(docs)]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == own.encode(t, add_special_tokens=False).ids


def test_packing(spark, odd, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_tokenizer())
    for df in (odd, docs):
        got = [r.asDict() for r in packing.pack_documents(df).collect()]
        want = Counter()
        for i, t in rows_of(df):
            ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
            first = len(ids) % 2048 or 2048
            cuts = [0, *range(first, len(ids), 2048), len(ids)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for pieces in sequences.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
            assert end <= 2048
        lengths, counts = np.unique([r["length"] for r in got], return_counts=True)
        assert len(sequences) <= 1 + 1.02 * packing.lower_bound(lengths, counts, lengths / 2048, 2048)


SPECIAL_TEXTS = ["end <|endoftext|> next", "<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endoftext|>  a", "a<|endoftext|>b c <|endoftext|>\n\n  x ", "<|endoftext|", "no such token", "é <|endoftext|> 日本語 <|ENDOFTEXT|> <pad>  <pad><pad>x x<pad>"]


def test_added_tokens_have_their_ids(spark, tmp_path):
    import json

    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    own = Tokenizer.from_file(path)
    assert own.encode(SPECIAL_TEXTS[0], add_special_tokens=False).ids == [437, 220, 50256, 1306]
    rows = spark.createDataFrame(list(enumerate(SPECIAL_TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pack_documents(rows).collect()}
    for i, t in enumerate(SPECIAL_TEXTS):
        ids = [*own.encode(t, add_special_tokens=False).ids, 0]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    with open(path) as f:
        model = json.load(f)
    for k, flags in enumerate([{}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}, {"normalized": True, "special": False}]):
        other = {**model, "added_tokens": [*model["added_tokens"], {**model["added_tokens"][0], "id": 50257, "content": "<pad>", **flags}, {**model["added_tokens"][0], "id": 50258, "content": "<pad><pad>"}]}
        file = tmp_path / f"{k}.json"
        file.write_text(json.dumps(other))
        for plain in (False, True):
            own = Tokenizer.from_file(str(file))
            own.encode_special_tokens = plain
            encoder = packing.Encoder(str(file), encode_special_tokens=plain)
            for t in SPECIAL_TEXTS:
                assert np.frombuffer(encoder.encode(t), "<u4").tolist() == own.encode(t, add_special_tokens=False).ids, (flags, plain, t)


def test_the_program_covers_what_it_says():
    rng = np.random.default_rng(5)
    for n, most in ((0, 1), (1, 50), (700, 12)):
        lengths = np.sort(rng.choice(np.arange(1, 2049), n, replace=False))
        counts = rng.integers(1, most + 1, n)
        solution, left, bound = packing.solve_configurations(lengths, counts, 2048) if n else ([], counts, 0)
        covered = left.copy()
        for times, config in solution:
            assert times >= 1 and packing.FULL[0] * 2048 <= sum(int(lengths[i]) * k for i, k in config.items()) <= 2048
            for i, k in config.items():
                covered[i] += times * k
        assert (covered == counts).all() and bound >= int((lengths * counts).sum()) / 2048
        rows, found = packing.plan_sequences(dict(zip(lengths.tolist(), counts.tolist())))
        assert found["bound"] == bound and found["program"] >= sum(t for t, _ in solution)
        assert found["program"] + found["rest"] <= sum(t for t, _ in solution) + sum(packing.best_fit(lengths, left, 2048).values())
        assert found["program"] + found["rest"] >= bound and sum(last - first for _, first, last, *_ in rows) == counts.sum()


def test_the_program_covers_long_pieces_and_single_lengths():
    """Histograms of which no configuration fills a sequence: the program makes them all, no worse than best fit alone."""
    odd = [{1500: 1000, 600: 10}, {1100: 50, 1300: 20}, {680: 1000, 1300: 50}, {1000: 400, 1010: 300, 30: 2}, {2048: 5}, {1: 3}, {1024: 7}, {1025: 1}, {int(n): int(n) % 9 + 1 for n in range(1025, 2048, 3)}]
    for histogram in odd:
        rows, found = packing.plan_sequences(histogram)
        alone = packing.best_fit(np.array(sorted(histogram)), np.array([histogram[n] for n in sorted(histogram)]), 2048)
        assert found["rest"] == 0 and found["bound"] <= found["program"] <= sum(alone.values())
        assert sum(last - first for _, first, last, *_ in rows) == sum(histogram.values())


def test_the_price_is_that_of_the_best_bounded_multiset():
    from itertools import product

    rng = np.random.default_rng(7)
    for _ in range(40):
        n = int(rng.integers(1, 6))
        lengths, most, values = rng.choice(np.arange(1, 12), n, replace=False), rng.integers(1, 5, n), rng.random(n) + 0.01
        config, value = packing.best_configuration(lengths, values, most, 20)
        force = max(sum(k * v for k, v in zip(c, values)) for c in product(*[range(m + 1) for m in most]) if sum(k * x for k, x in zip(c, lengths)) <= 20)
        assert abs(value - force) < 1e-9 and abs(sum(values[i] * k for i, k in config.items()) - force) < 1e-9
        assert all(k <= most[i] for i, k in config.items()) and sum(lengths[i] * k for i, k in config.items()) <= 20


def test_the_program_makes_nearly_all_sequences():
    """On a histogram like that of documents: at least 95 % from the program, and within half a percent of the lower bound."""
    rng = np.random.default_rng(3)
    sizes = np.minimum(np.exp(rng.normal(6.3, 1.1, 6000)).astype(int) + 1, 20_000)
    histogram = Counter()
    for n in sizes.tolist():
        histogram[n % 2048 or 2048] += 1
        histogram[2048] += (n - 1) // 2048
    _, found = packing.plan_sequences({k: v for k, v in histogram.items() if v})
    total = found["program"] + found["rest"]
    assert found["program"] >= 0.95 * total and total <= 1.005 * found["bound"] + 1


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert substrings.substring_dedup(none).collect() == []
    assert minhash.near_duplicates(none).collect() == [] and minhash.distinct_documents(none).collect() == []
    assert quality.quality_rules(none).collect() == [] and mixing.mix_sources(none).collect() == []
    assert sharding.shard_documents(none).collect() == [] and ngrams.katz_scores(none).collect() == []
    assert languages.identify_languages(none).collect() == [] and packing.pack_documents(none).collect() == []


def near_copies(n, seed):
    """A text of 60 words and copies with up to 7 words changed: many pairs lie just above and just below a similarity of 0.8."""
    import random

    r = random.Random(seed)
    base = [f"w{j}" for j in range(60)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randrange(8)):
            w[r.randrange(60)] = f"x{r.randrange(40)}" if r.random() < 0.3 else f"y{i}.{r.random()}"
        out.append((i, " ".join(w), None, None, None, None, None, None))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_a_large_group_of_near_copies(spark, size):
    """Groups as by brute force, from a number of comparisons that grows with the copies, not with their pairs."""
    from brindle.llm.common import checkpoint

    df = spark.createDataFrame(near_copies(600, size), SCHEMA)
    least, _, sets = groups_by_force(rows_of(df), size)
    got = minhash.near_duplicates(df, shingle=size).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((i, v[1]) for i, v in least.items())
    signed = minhash.signatures(df, "doc_id", "text", size, 10, 2)
    classes = checkpoint(signed.dropDuplicates(["set"]).select(F.col("id").alias("cls"), "left", "right"))
    pairs = minhash.hub_pairs(minhash.bucket_members(classes, 10)).count()
    assert pairs <= 20 * len(set(sets))


def test_hubs_prove_links_without_loss(spark):
    """Whatever the hub, the links around it are those of brute force between the sets that met it."""
    import random

    for seed in range(4):
        rows = [(i, frozenset(shingles(t, 2))) for i, t, *_ in near_copies(80, seed)]
        hub = random.Random(seed).randrange(80)
        number = {x: j for j, x in enumerate(set().union(*[s for _, s in rows]))}
        met = []
        for i, s in rows:
            if i != hub:
                d = s ^ rows[hub][1]
                met.append((hub, i, len(rows[hub][1]), len(s), len(d), [number[x] for x in d], 180 * len(d) - 20 * len(s)))
        df = spark.createDataFrame(met, "a long, b long, sa long, sb long, d long, delta array<long>, o long")
        direct = {(hub, m[1]) for m in met if 180 * m[4] <= 20 * (m[2] + m[3])}
        found = {(r["a"], r["b"]) for r in minhash.links_around_hubs(df, 80).collect()}
        links = {(i, j) for i, s in rows for j, t in rows if i < j and 100 * len(s & t) >= 80 * len(s | t)}
        assert {(min(x), max(x)) for x in found} <= links
        root = list(range(80))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in direct | found:
            root[find(a)] = find(b)
        assert all(find(a) == find(b) for a, b in links)


def test_families_of_variants_take_few_links(spark):
    """Two variants of a hub's text, of hundreds of copies each: every variant is connected, the two aren't, and links follow the copies, not their pairs."""
    n, hub = 400, frozenset(range(100))
    sets = {}
    for v in range(2):
        for i in range(n):
            new = [1000 * (v + 1) + j for j in range(15)]
            sets[v * n + i] = (hub - set(range(15))) | set(new) | {10_000 + 2 * (v * n + i) + j for j in range(2)}
    met = [(5000, i, 100, len(s), len(s ^ hub), sorted(s ^ hub), 180 * len(s ^ hub) - 20 * len(s)) for i, s in sets.items()]
    df = spark.createDataFrame(met, "a long, b long, sa long, sb long, d long, delta array<long>, o long")
    links = [(r["a"], r["b"]) for r in minhash.links_around_hubs(df, 80).collect()]
    assert len(links) <= 10 * len(sets)
    assert all(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in links)
    reached, at = {}, {}
    for a, b in links:
        at.setdefault(a, []).append(b), at.setdefault(b, []).append(a)
    for first in (0, n):
        todo, seen = [first], {first}
        while todo:
            more = [b for b in at.get(todo.pop(), ()) if b not in seen]
            seen |= set(more)
            todo += more
        reached[first] = seen
    assert reached == {0: set(range(n)), n: set(range(n, 2 * n))}


def test_written_shards_keep_every_column(spark, tmp_path):
    rows = [(i, f"text {i}" if i % 5 else None, i % 3, "own law", None) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, law string, slot string")
    sharding.write_shards(df, str(tmp_path / "out"), rows_in_file=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"], r["document_shard"], r["document_law"], r["document_slot"]) for r in back.collect()) == Counter(rows)
    want = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard_documents(df).collect()}
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()} == want
    sharding.write_shards(df.limit(0), str(tmp_path / "none"))


def test_columns_may_be_called_like_the_operators_own(spark, odd):
    df = odd.withColumns({name: F.lit(1) for name in ("__key", "__own", "id", "same", "own", "set", "group", "stays", "t", "s", "i", "n", "__text")})
    got = minhash.distinct_documents(df)
    assert got.columns == df.columns and got.count() == minhash.distinct_documents(odd).count()


def test_a_column_may_be_called_like_the_carried_struct_s_own_field(spark, tmp_path):
    rows = [(1, "a b " * 30, "x", 1), (2, "a b " * 30, None, 2), (None, None, "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __none string, ___NONE int")
    kept = substrings.deduplicated_documents(df)
    assert kept.columns == df.columns
    assert Counter((r[0], r[2], r[3]) for r in kept.collect()) == Counter((r[0], r[2], r[3]) for r in rows)
    sharding.write_shards(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).select(*df.columns)
    assert Counter(map(tuple, back.collect())) == Counter(rows)


def test_a_block_of_the_substring_pass_is_bounded():
    """The words, windows and sketch rows of a block of the usual size stay below 80 MB, and a shard's counters below its texts' size."""
    import tracemalloc

    text, n = " ".join(f"w{i % 50021}" for i in range(substrings.BLOCK_BYTES // 7)).encode(), 200 << 20
    layout = substrings.Layout(n, -(-n // substrings.BLOCK_BYTES))
    assert layout.cells_in_shard <= 8 << 20
    tracemalloc.start()
    substrings._sketch(substrings.Block(pa.table({"id": pa.array([1]), "text": pa.array([text], pa.binary())}), 20), layout, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20
