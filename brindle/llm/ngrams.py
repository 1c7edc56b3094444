"""Katz backoff: Good-Turing discounted counts, backoff weights that normalise exactly, evaluated per token.

P(w | h) is d(c) * c / C(h) for a pair seen c times, else alpha(h) * P(w); P(w) is d(c) * c / N for a known word,
else the mass that the discounts free, given to unknown words as one. alpha(h) is the mass that h's discounts
free over the mass of the words not seen after h, so that the probabilities after every history add up to 1.
A history (or N) whose counts free nothing counts one more, which frees 1 / (C + 1).

The counts live in tables partitioned by the hash of the history. Each block of documents sends every partition
its distinct words, then its distinct word pairs, with counts; a partition adds them up and answers each block for
the entries that it sent, so what moves is a block's distinct entries, never its tokens, and no process holds the
model. Words are known by 64-bit hashes.

A history seen more than `FREQUENT` times (a very common word, or the start) may have that many different followers.
Its pairs are dealt by history and word to partitions of their own. What these free is added up history by history in a
second aggregation, and the sums, a row per partition of histories, go to every block: words that frequent are in most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import BLOCK_BYTES, WordIds, lean, mix, pack, pack_sorted, text_blocks, unpack, unpack_sorted

#: Counts up to this are discounted (Katz's k).
MOST_DISCOUNTED = 5
#: Hashes that stand for the start (a history only) and the end of a text.
START, END = np.uint64(0x51A27D0C0FFEE001), np.uint64(0xE4D0F7E5C0FFEE02)
#: Occurrences from which a history's pairs are spread over partitions.
FREQUENT = 1 << 20
PIECES = "kind int, key int, block int, n int, a binary, b binary, c binary, d binary, e binary"
WORDS, PAIRS, SUMS = 0, 1, 2


def discounts(n_r: np.ndarray) -> np.ndarray:
    """Good-Turing discounts of the counts 1..k from counts of counts n_1..n_(k+1); 1 where they aren't in (0, 1]."""
    k = len(n_r) - 1
    out = np.ones(k)
    if n_r[0] > 0:
        tail = (k + 1) * n_r[k] / n_r[0]
        for r in range(1, k + 1):
            if n_r[r - 1] > 0 and tail < 1:
                d = ((r + 1) * n_r[r] / (r * n_r[r - 1]) - tail) / (1 - tail)
                if 0 < d <= 1:
                    out[r - 1] = d
    return out


def counts_of_counts(c: np.ndarray, k: int = MOST_DISCOUNTED) -> np.ndarray:
    return np.bincount(c[(c > 0) & (c <= k + 1)], minlength=k + 2)[1:].astype(np.int64)


class Unigrams:
    """P(w) from a count, given N and the counts of counts."""

    def __init__(self, total: int, n_r: np.ndarray):
        self.d = discounts(n_r)
        freed = float(((1 - self.d) * np.arange(1, len(n_r)) * n_r[:-1]).sum())
        self.total = total if freed > 0 else total + 1
        self.unknown = (freed if freed > 0 else 1.0) / self.total

    def __call__(self, c: np.ndarray) -> np.ndarray:
        d = np.concatenate([[1.0], self.d, [1.0]])[np.minimum(c, len(self.d) + 1)]
        return np.where(c > 0, d * c / self.total, self.unknown)


class Block:
    """A block's tokens as ranks of its distinct words in hash order, and its distinct pairs."""

    def __init__(self, table: pa.Table):
        self.held_out = np.asarray(table.column("held_out").to_numpy(zero_copy_only=False), dtype=bool)
        local = WordIds()
        texts = [local.encode(t.lower().split()) if t else np.empty(0, np.int64) for t in table.column("text").to_pylist()]
        hashes = np.concatenate([local.hashes(), [START, END]]) if local.ids else np.array([START, END], dtype=np.uint64)
        start, end = len(hashes) - 2, len(hashes) - 1
        order = np.argsort(hashes)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.hashes = hashes[order]
        self.size = len(hashes)
        self.tokens = rank[np.concatenate([x for t in texts for x in (t, [end])])] if texts else np.empty(0, np.int64)
        self.before = rank[np.concatenate([x for t in texts for x in ([start], t)])] if texts else np.empty(0, np.int64)
        self.lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.train = ~np.repeat(self.held_out, self.lengths)
        self.start, self.n_train = int(rank[start]), int((~self.held_out).sum())

    def word_counts(self) -> np.ndarray:
        c = np.bincount(self.tokens[self.train], minlength=self.size)
        c[self.start] = self.n_train
        return c

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (history, word) in order, as history * size + word, and how often training texts have them."""
        key = self.before * self.size + self.tokens
        both = np.sort(key * 2 + self.train)
        new = np.ones(len(both), dtype=bool)
        new[1:] = both[1:] >> 1 != both[:-1] >> 1
        at = np.flatnonzero(new)
        return both[at] >> 1, np.add.reduceat(both & 1, at) if len(at) else np.empty(0, np.int64)


def _bounds(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


def _table(rows: list[tuple]) -> pa.Table:
    names = ["kind", "key", "block", "n", "a", "b", "c", "d", "e"]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int32() if i < 4 else pa.binary()) for i, c in enumerate(columns)], names=names)


def _send_words(block: Block, number: int, bits: int) -> list[tuple]:
    at, counts = _bounds(block.hashes, bits), block.word_counts()
    return [(WORDS, s, number, int(y - x), pack_sorted(block.hashes[x:y]), pack(counts[x:y]), None, None, None) for s, (x, y) in enumerate(zip(at, at[1:]))]


def _add_words(table: pa.Table) -> list[tuple]:
    """Counts of a partition's words. Each block gets back its words' places in the partition and their counts."""
    sizes = table.column("n").to_pylist()
    h = np.concatenate([unpack_sorted(x.as_py(), np.uint64) for x in table.column("a")])
    known, place = np.unique(h, return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([unpack(x.as_py(), np.int64) for x in table.column("b")]), minlength=len(known)).astype(np.int64) if len(h) else np.empty(0, np.int64)
    own = counts[known != START]
    stats = np.concatenate([[own.sum(), (own > 0).sum()], counts_of_counts(own)]).astype(np.int64).tobytes()
    out, at = [], 0
    for key, block, n in zip(table.column("key").to_pylist(), table.column("block").to_pylist(), sizes):
        p = place[at : at + n]
        out.append((WORDS, key, block, n, pack_sorted(p.astype(np.uint32)), pack(counts[p]), stats, None, None))
        at += n
    return out


class Answers:
    """What the partitions told a block: of its words, of its pairs, and of frequent histories."""

    def __init__(self, table: pa.Table, bits: int):
        rows = {(r["kind"], r["key"]): r for r in table.to_pylist()}
        self.words = [rows[WORDS, s] for s in range(1 << bits)]
        self.pairs = [rows[PAIRS, s] for s in range(2 << bits) if (PAIRS, s) in rows]
        self.sums = [r for (kind, _), r in rows.items() if kind == SUMS]
        self.counts = np.concatenate([unpack(r["b"], np.int64) for r in self.words])
        # a word anywhere: its partition and its place there, which ascend with its hash
        self.names = np.concatenate([unpack_sorted(r["a"], np.uint32).astype(np.uint64) | (np.uint64(s) << np.uint64(32)) for s, r in enumerate(self.words)])
        stats = np.sum([np.frombuffer(r["c"], np.int64) for r in self.words], axis=0)
        self.total, self.distinct, self.n_r = int(stats[0]), int(stats[1]), stats[2:]


class Deal:
    """A block's distinct pairs in the order of the partitions that they go to, and the histories that each partition gets."""

    def __init__(self, block: Block, got: Answers, bits: int, frequent: int):
        keys, counts = block.pairs()
        history, word = keys // block.size, keys % block.size
        key = (got.names[history] >> np.uint64(32)).astype(np.int64)
        spread = got.counts[history] > frequent
        both = mix(got.names[history[spread]]) ^ got.names[word[spread]]
        key[spread] = (1 << bits) + (mix(both) >> np.uint64(64 - bits)).astype(np.int64)
        self.place = np.argsort(key, kind="stable")
        self.keys, self.key = keys, key[self.place]
        self.history, self.word, self.counts = history[self.place], word[self.place], counts[self.place]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (self.history[1:] != self.history[:-1])
        #: where a partition's part of a history starts
        self.runs = np.flatnonzero(new)


def _send_pairs(block: Block, got: Answers, number: int, bits: int, frequent: int) -> list[tuple]:
    """Each partition gets: histories and their numbers of pairs, the pairs' words, counts of both."""
    deal, out = Deal(block, got, bits, frequent), []
    facts = np.concatenate([[got.total], got.n_r]).astype(np.int64).tobytes()
    at = np.searchsorted(deal.key, np.arange((2 << bits) + 1))
    runs = np.searchsorted(deal.runs, at)
    lengths = np.diff(deal.runs, append=len(deal.key)).astype(np.uint32)
    for s, (x, y) in enumerate(zip(at, at[1:])):
        if y > x or s < 1 << bits:
            r, w = slice(runs[s], runs[s + 1]), deal.word[x:y]
            out.append((PAIRS, s, number, int(y - x), pack_sorted(got.names[deal.history[deal.runs[r]]]), pack(lengths[r]), pack(got.names[w]), pack(np.stack([deal.counts[x:y], got.counts[w]]).ravel()), facts))
    return out


class Pairs:
    """A partition's distinct pairs, added up over the blocks that sent them, and what its part of each history frees."""

    def __init__(self, rows: list[dict]):
        k = MOST_DISCOUNTED
        sent_by = [unpack_sorted(r["a"], np.uint64) for r in rows]
        self.names, at = np.unique(np.concatenate(sent_by), return_inverse=True)
        self.histories = np.split(at, np.cumsum([len(x) for x in sent_by])[:-1])
        h = np.concatenate([np.repeat(x, unpack(r["b"], np.uint32)) for x, r in zip(self.histories, rows)])
        w = np.concatenate([unpack(r["c"], np.uint64) for r in rows])
        both = [unpack(r["d"], np.int64).reshape(2, -1) for r in rows]
        sent, cw = np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])
        words, w_place = np.unique(w, return_inverse=True)
        pairs, first, self.place = np.unique(h.astype(np.int64) * max(len(words), 1) + w_place, return_index=True, return_inverse=True)
        self.counts = np.bincount(self.place, weights=sent, minlength=len(pairs)).astype(np.int64) if len(h) else np.empty(0, np.int64)
        facts, n = np.frombuffer(rows[0]["e"], np.int64), len(self.names)
        p = Unigrams(int(facts[0]), facts[1:])(cw[first])
        of, seen = h[first], self.counts > 0
        self.mass = np.bincount(of[seen], weights=p[seen], minlength=n)
        self.follow = np.stack([np.bincount(of[self.counts == r], minlength=n) for r in range(1, k + 1)]) if n else np.empty((k, 0), np.int64)


def _add_pairs(table: pa.Table) -> list[tuple]:
    """Each block gets back its pairs' counts and, for each of its histories, how many different words of this partition
    follow 1..k times and the unigram mass of all that follow."""
    rows = table.to_pylist()
    found = Pairs(rows)
    stats = counts_of_counts(found.counts).tobytes()
    out, at = [], 0
    for r, x in zip(rows, found.histories):
        n = r["n"]
        out.append((PAIRS, r["key"], r["block"], n, pack(found.counts[found.place[at : at + n]]), pack(found.follow[:, x].astype(np.uint32).ravel()), found.mass[x].tobytes(), stats, None))
        at += n
    return out


def _partial_sums(table: pa.Table, bits: int) -> list[tuple]:
    """Of a partition of frequent histories' pairs: its part of their sums, for the partitions that the histories are in.
    The first of these also gets the counts of its counts."""
    key = table.column("key")[0].as_py()
    if key < 1 << bits:
        return []
    found = Pairs(table.to_pylist())
    home = (found.names >> np.uint64(32)).astype(np.int64)
    stats, out = counts_of_counts(found.counts), []
    for i, p in enumerate(np.unique(home)):
        m = home == p
        out.append((SUMS, int(p), key, int(m.sum()), pack_sorted(found.names[m]), pack(found.follow[:, m].astype(np.int64).ravel()), found.mass[m].tobytes(), (stats if i == 0 else 0 * stats).tobytes(), None))
    return out


def _add_sums(table: pa.Table) -> list[tuple]:
    """The whole sums of a partition's frequent histories, added up in the order of the parts' partitions."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    parts = [unpack_sorted(r["a"], np.uint64) for r in rows]
    names = np.unique(np.concatenate(parts))
    follow, mass = np.zeros((MOST_DISCOUNTED, len(names)), np.int64), np.zeros(len(names))
    for r, part in zip(rows, parts):
        x = np.searchsorted(names, part)
        follow[:, x] += unpack(r["b"], np.int64).reshape(MOST_DISCOUNTED, -1)
        mass[x] += np.frombuffer(r["c"], float)
    stats = np.sum([np.frombuffer(r["d"], np.int64) for r in rows], axis=0)
    return [(SUMS, rows[0]["key"], 0, len(names), pack_sorted(names), pack(follow.ravel()), mass.tobytes(), stats.tobytes(), None)]


def _scores(block: Block, got: Answers, bits: int, frequent: int) -> dict[str, np.ndarray]:
    k = MOST_DISCOUNTED
    unigram, deal = Unigrams(got.total, got.n_r), Deal(block, got, bits, frequent)
    counts = np.concatenate([unpack(r["a"], np.int64) for r in got.pairs])
    # every block hears of the partitions of frequent histories by their sums, of the others by its pairs
    stats = [r["d"] for r in got.pairs if r["key"] < 1 << bits] + [r["d"] for r in got.sums]
    d = discounts(np.sum([np.frombuffer(x, np.int64) for x in stats], axis=0))
    follow, mass = np.zeros((k, block.size), np.int64), np.zeros(block.size)
    sent = deal.history[deal.runs]
    follow[:, sent] = np.concatenate([unpack(r["b"], np.uint32).reshape(k, -1) for r in got.pairs], axis=1)
    mass[sent] = np.concatenate([np.frombuffer(r["c"], float) for r in got.pairs])
    for r in got.sums:
        names = unpack_sorted(r["a"], np.uint64)
        x = np.minimum(np.searchsorted(got.names, names), block.size - 1)
        here = got.names[x] == names
        follow[:, x[here]] = unpack(r["b"], np.int64).reshape(k, -1)[:, here]
        mass[x[here]] = np.frombuffer(r["c"], float)[here]
    total = got.counts
    freed = (follow * ((1 - d) * np.arange(1, k + 1))[:, None]).sum(axis=0)
    bottom = np.where(freed > 0, total, total + 1)
    alpha = np.where(total > 0, np.where(freed > 0, freed, 1.0) / bottom / (1 - mass), 1.0)
    dc = np.concatenate([[1.0], d, [1.0]])[np.minimum(counts, k + 1)]
    p1 = unigram(got.counts[deal.word])
    logs = np.empty(len(counts))
    logs[deal.place] = np.log10(np.where(counts > 0, dc * counts / bottom[deal.history], alpha[deal.history] * p1))
    of_token = logs[np.searchsorted(deal.keys, block.before * block.size + block.tokens)]
    c = got.counts[block.tokens]
    base = np.log10((c + 1) / (got.total + got.distinct + 1))
    starts = np.cumsum(block.lengths) - block.lengths
    return {"n_known": np.add.reduceat((c > 0).astype(np.int64), starts), "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(of_token, starts)}


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: F.Column | None = None, block_bytes: int = BLOCK_BYTES, frequent: int = FREQUENT) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    The model learns from the rows that aren't held out (by default those whose crc32 of the id modulo 7 isn't 2; a
    null id counts as the empty string). Null and empty texts are the end token alone. Repeated rows count
    as often as they occur and score alike. Without training rows every word is unknown, with probability 1.
    An empty table gives no rows. Columns that aren't named are ignored. Texts are read whole. Ids may be of any type.
    Histories seen more than `frequent` times are spread over partitions; scores don't depend on it, nor on `block_bytes`.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2
    named = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks, n_blocks, _ = text_blocks(named, "__id", "__text", ("held_out",), block_bytes, by=("__id", "__text"))
    bits = max(3, int(n_blocks).bit_length())

    def send_words(key, table):
        return _table(_send_words(Block(table), key[0].as_py(), bits))

    def add_words(table):
        return _table(_add_words(table))

    def send_pairs(key, table, got):
        return _table(_send_pairs(Block(table), Answers(got, bits), key[0].as_py(), bits, frequent))

    def add_pairs(table):
        return _table(_add_pairs(table))

    def partial_sums(table):
        return _table(_partial_sums(table, bits))

    def add_sums(table):
        return _table(_add_sums(table))

    def score(table, got):
        names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if table.num_rows:
            block, answers = Block(table), Answers(got, bits)
            found = _scores(block, answers, bits, frequent) | {"n_tokens": block.lengths, "train_tokens": np.full(table.num_rows, answers.total, dtype=np.int64)}
        else:  # sums also go to the numbers of blocks that no text is in
            found = dict.fromkeys(names[:3], np.empty(0, np.int64)) | dict.fromkeys(names[3:], np.empty(0))
        return pa.table([table.column("id"), table.column("held_out"), *[pa.array(found[c]) for c in names]], names=["id", "held_out", *names])

    words = blocks.groupBy("block").applyInArrow(lean(send_words), PIECES).groupBy("key").applyInArrow(lean(add_words), PIECES)
    sent = blocks.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(lean(send_pairs), PIECES)
    pairs = sent.groupBy("key").applyInArrow(lean(add_pairs), PIECES)
    parts = sent.groupBy("key").applyInArrow(lean(partial_sums), PIECES)
    sums = parts.groupBy("key").applyInArrow(lean(add_sums), PIECES).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    out = blocks.groupBy("block").cogroup(words.unionByName(pairs).unionByName(sums.select(words.columns)).groupBy("block")).applyInArrow(lean(score), schema)
    return out.withColumnRenamed("id", id_col)
