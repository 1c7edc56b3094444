"""The stages against brute force, one after another, and the whole."""

import math
from collections import Counter, defaultdict

import corpus_pipeline
from brindle.llm import packing
from tests.llm.test_corpus import groups_by_force, odd_rows, removed_by_force, rows_of, words

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "mix_sources", "pack"]

    def run(name, df):
        stages[name](spark, df, SF).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    good = run("quality_rules", docs)
    assert good.columns == own
    kept = {r["doc_id"] for r in good.select("doc_id").collect()}
    for r in docs.collect():
        w = words(r["text"])
        tri = Counter(zip(w, w[1:], w[2:]))
        repeat = len({p for s in range(len(w) - 2) if tri[tuple(w[s : s + 3])] > 1 for p in range(s, s + 3)})
        lines = [x for x in r["text"].split("\n") if words(x)]
        chars = sum(len(x.decode()) for x in w)
        bad = len(w) < 50 or 2 * repeat > len(w) or 100 * sum(r["text"].count(c) for c in "#*$%&|<>") > 30 * len(w)
        bad = bad or 2 * sum("A" <= c <= "Z" for c in r["text"]) > sum(c.isalpha() for c in r["text"]) or 2 * (len(lines) - len(set(lines))) > len(lines)
        bad = bad or not 2 * len(w) <= chars <= 40 * len(w) or 2 * sum(any(c.isalpha() for c in x.decode()) for x in w) < len(w)
        assert (r["doc_id"] in kept) == (not bad)

    single = run("near_dedup", good)
    rows = rows_of(good)
    least, group, _ = groups_by_force(rows, 5)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({least[i][1] for i in range(len(rows))})

    cut = run("substring_dedup", single)
    rows, kept = rows_of(single), removed_by_force(rows_of(single))
    text = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert len(text) == len(rows) and all(words(text[rows[i][0]]) == k for i, k in kept.items())
    assert all(text[i] == t for (i, t), k in zip(rows, [kept[j] for j in range(len(rows))]) if len(k) == len(words(t)))
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect() if r["n_chars"] is not None)

    mix = run("mix_sources", cut)
    size, taken = Counter(), Counter()
    for r in cut.collect():
        size[r["source"]] += len(words(r["text"]))
    for r in mix.collect():
        taken[r["source"]] += len(words(r["text"]))
        assert text[r["doc_id"]] == r["text"] or words(r["text"]) == words(text[r["doc_id"]])[: len(words(r["text"]))]
    names = sorted(size, key=lambda s: s.encode())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    level = min((sum(size.values()) / sum(weight.values()) * weight[s], s) for s in names)
    assert level and abs(sum(taken.values()) - sum(size.values())) <= len(names) and all(taken[s] <= 3 * size[s] for s in names)

    packed = run("pack", mix)
    sequences = defaultdict(int)
    for r in packed.collect():
        sequences[r["sequence_id"]] += r["length"]
    encoder = packing.Encoder(packing.default_tokenizer())
    assert sum(sequences.values()) == sum(len(encoder.encode(r["text"])) // 4 + 1 for r in mix.collect())
    assert max(sequences.values()) <= 2048 and len(sequences) <= 1.15 * math.ceil(sum(sequences.values()) / 2048)
    whole = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(whole) == key(packed)


def test_odd_rows_pass_through(spark):
    df = spark.createDataFrame(odd_rows(), "doc_id long, text string, lang string, source string, n_chars long, n_words string, size int, block string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, SF).cache()
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "size", "block"], name
        assert df.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() > 0


def test_stages_take_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == [], name
