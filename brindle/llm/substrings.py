"""Substring dedup: words covered by a window that also starts earlier in the corpus are removed.

Pass one sketches each block's windows into a count-min sketch of two rows. The sketch is as wide as the corpus
has bytes, so it is kept in shards: a block sends every shard the cells it touches, a shard merges them into
dense counters and answers with one bit a cell, whether its count is two or more. Counts only overestimate, so a
window that repeats has both bits set. Pass two sends only windows with both bits set, under their 128-bit hash,
to the shard that groups them exactly and answers which block holds each window's first start.

Blocks, sketch shards and window shards hold a bounded number of bytes each, and a window sends one row per
block whatever its number of copies. Each text is read whole.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import WordIds, lean, nullable, pack, pack_bits, pack_sorted, text_blocks, unpack, unpack_bits, unpack_sorted, unused_name, window_hashes
from brindle.operators.clean import dense_ids

#: Any two odd numbers with inverses modulo 2^64 that are not powers of each other.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Types of ids that are their own place in the order; rows of other ids are numbered.
NUMBERS = ("tinyint", "smallint", "int", "bigint")
#: Bytes of text in a block on average; its words and windows take some 30 times that in a Python worker.
BLOCK_BYTES = 2 << 20
PIECES = "key long, block int, n int, a binary, b binary, c binary"


class Block:
    """The documents of a block in order of (id, text), and the hashes of their windows."""

    def __init__(self, table: pa.Table, width: int):
        ids = table.column("id").to_pylist()
        texts = [t or b"" for t in table.column("text").to_pylist()]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.texts = [texts[i] for i in self.order]
        self.words = [t.split() for t in self.texts]
        self.doc_ids = np.array([ids[i] for i in self.order], dtype=np.int64)
        local = WordIds()
        x = np.concatenate([local.encode(w) for w in self.words]) if len(ids) else np.empty(0, np.int64)
        self.n = len(x)
        inside = np.ones(max(self.n - width + 1, 0), dtype=bool)
        ends, at = [], 0
        for w in self.words:
            end = at + len(w)
            inside[max(at, end - width + 1) : end] = False
            ends.append(end)
            at = end
        self.ends = np.array(ends, dtype=np.int64)
        self.start = np.flatnonzero(inside)
        self.h = [window_hashes(hashes[x], width, base)[self.start] for hashes, base in zip((local.hashes(), local.second_hashes()), BASES)] if self.n else [np.empty(0, np.uint64)] * 2

    def documents(self, windows: np.ndarray) -> np.ndarray:
        """The ids of the documents that have these windows."""
        return self.doc_ids[np.searchsorted(self.ends, self.start[windows], side="right")]


class Layout:
    """Widths of the sketch and numbers of shards, all powers of two that follow the input's size. There are half as many shards as blocks or
    more: a shard's counters take a byte a cell, a block some 30 times its text."""

    def __init__(self, n_bytes: int, n_blocks: int):
        self.cell_bits = max(12, int(n_bytes).bit_length())
        self.shard_bits = min(max(3, int(n_blocks).bit_length() - 1), self.cell_bits - 8)
        self.shards = 1 << self.shard_bits
        self.cells_in_shard = 1 << (self.cell_bits - self.shard_bits)

    def cells(self, h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(64 - self.cell_bits)

    def bounds(self, sorted_values: np.ndarray, bits: int) -> np.ndarray:
        """Where each shard's values start and end in a sorted array of `bits`-bit values."""
        edges = np.arange(1, self.shards, dtype=np.uint64) << np.uint64(bits - self.shard_bits)
        return np.concatenate([[0], np.searchsorted(sorted_values, edges), [len(sorted_values)]])


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "block", "n", "a", "b", "c"])


def _sketch(block: Block, layout: Layout, number: int) -> list[tuple]:
    """For each row of the sketch and each shard: the cells that the block's windows touch, and which twice or more."""
    rows = []
    for r in (0, 1):
        cells, counts = np.unique(layout.cells(block.h[r]), return_counts=True)
        at = layout.bounds(cells, layout.cell_bits)
        inner = (cells & np.uint64(layout.cells_in_shard - 1)).astype(np.uint32)
        for s in range(layout.shards):
            a, b = at[s], at[s + 1]
            if b > a:
                rows.append((r * layout.shards + s, number, int(b - a), pack_sorted(inner[a:b]), pack_bits(counts[a:b] > 1), None))
    return rows


def _merge(table: pa.Table, layout: Layout) -> list[tuple]:
    """Counts of a shard over all blocks, saturating at two; each block learns which of its cells have two."""
    count = np.zeros(layout.cells_in_shard, dtype=np.uint8)
    for n, a, b in zip(table.column("n").to_pylist(), table.column("a"), table.column("b")):
        cells = unpack_sorted(a.as_py(), np.uint32)
        count[cells] = np.minimum(count[cells] + 1 + unpack_bits(b.as_py(), n), 2)
    return [(key, block, n, pack_bits(count[unpack_sorted(a.as_py(), np.uint32)] > 1), None, None) for key, block, n, a in zip(table.column("key").to_pylist(), table.column("block").to_pylist(), table.column("n").to_pylist(), table.column("a"))]


def _candidates(block: Block, layout: Layout, answers: dict[int, tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows (indices, equal ones together in the order of their hashes) whose cells have two in both rows, and for
    each of them where the block first has it."""

    def repeated(r: int) -> np.ndarray:
        bits = [unpack_bits(answers[k][1], answers[k][0]) for k in range(r * layout.shards, (r + 1) * layout.shards) if k in answers]
        return np.concatenate(bits) if bits else np.empty(0, dtype=bool)

    if not len(block.start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left = np.argsort(block.h[0])
    cells = layout.cells(block.h[0][left])
    new = np.ones(len(cells), dtype=bool)
    new[1:] = cells[1:] != cells[:-1]
    left = left[repeated(0)[np.cumsum(new) - 1]]
    cells = layout.cells(block.h[1])
    left = left[repeated(1)[np.searchsorted(np.unique(cells), cells[left])]]
    a, b = block.h[0][left], block.h[1][left]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):  # different windows with one equal half of their hashes
        left = left[np.lexsort((b, a))]
        a, b = block.h[0][left], block.h[1][left]
    new = np.ones(len(left), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    first = np.minimum.reduceat(left, at)[np.cumsum(new) - 1] if len(left) else left
    return left, first


def _ask(block: Block, layout: Layout, answers: dict, number: int) -> list[tuple]:
    """Each candidate window once, under its hash, with the document where the block first has it."""
    left, first = _candidates(block, layout, answers)
    first = left[left == first]
    a, b, docs = block.h[0][first], block.h[1][first], block.documents(first)
    at = layout.bounds(a, 64)
    return [(2 * layout.shards + s, number, int(y - x), pack_sorted(a[x:y]), pack(b[x:y]), pack(docs[x:y])) for s, (x, y) in enumerate(zip(at, at[1:])) if y > x]


def _group(table: pa.Table) -> list[tuple]:
    """Exact groups of a shard's windows; each block learns which of its windows start first there."""
    sizes = table.column("n").to_pylist()
    a = np.concatenate([unpack_sorted(x.as_py(), np.uint64) for x in table.column("a")])
    b = np.concatenate([unpack(x.as_py(), np.uint64) for x in table.column("b")])
    docs = np.concatenate([unpack(x.as_py(), np.int64) for x in table.column("c")])
    order = np.lexsort((docs, b, a))
    leads = np.ones(len(a), dtype=bool)
    leads[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    first = np.empty(len(a), dtype=bool)
    first[order] = leads
    ends = np.cumsum(sizes)
    return [(key, block, n, pack_bits(first[e - n : e]), None, None) for key, block, n, e in zip(table.column("key").to_pylist(), table.column("block").to_pylist(), sizes, ends)]


def _covered(block: Block, layout: Layout, answers: dict, width: int) -> np.ndarray:
    """Which words of the block a repeated window covers."""
    left, first_here = _candidates(block, layout, answers)
    bits = [unpack_bits(answers[k][1], answers[k][0]) for k in range(2 * layout.shards, 3 * layout.shards) if k in answers]
    first = np.concatenate(bits) if bits else np.empty(0, dtype=bool)
    stays = left == first_here
    stays[stays] = first
    starts = block.start[left[~stays]]
    step = np.zeros(block.n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0


def kept_text(text: bytes, removed: np.ndarray) -> bytes:
    """The text without the removed words and the white space after them; untouched if none is."""
    spans = re.finditer(rb"[^ \t-\r]+[ \t-\r]*", text)
    head = text[: len(text) - len(text.lstrip(b" \t\n\v\f\r"))]
    return b"".join([head, *[m.group() for m, gone in zip(spans, removed) if not gone]])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20, carry: tuple[str, ...] = (), texts: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, carried columns, n_words, n_removed, kept_sha256 and, with `texts`, the kept text.

    A window starts earlier in a document of smaller id, or earlier in its own document. Null ids come first;
    rows alike in id are taken in the order of their texts, so of equal rows one is kept. Where ids are null or no whole
    numbers, rows are first numbered in that order by a range shuffle, whose outcome is fixed in files, so ids may be of any type that
    Spark orders and any number of rows may have no id. Null and empty texts
    have no words; texts shorter than a window lose none. An empty table gives no rows. Columns that are
    neither named nor carried are ignored, whatever their names.
    """
    named = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), *([F.struct(*[F.col(c) for c in carry]).alias("own")] if carry else []))
    kinds, carried = dict(docs.dtypes), ("own",) if carry else ()
    total, without_id = named.agg(F.sum(F.octet_length("__text")), F.count_if(F.col("__id").isNull())).first()
    ranked = bool(without_id) or kinds[id_col] not in NUMBERS
    if ranked:
        named = dense_ids(named.withColumnRenamed("__id", "given"), [F.col("given").asc_nulls_first(), F.col("__text").asc_nulls_first()], "__id")
        carried = (*carried, "given")
    blocks, n_blocks, n_bytes = text_blocks(named.withColumn("__id", F.col("__id").cast("long")), "__id", "__text", carried, block_bytes, total=total or 0)
    layout = Layout(n_bytes, n_blocks)

    def number(key) -> int:
        return key[0].as_py() if hasattr(key[0], "as_py") else key[0]

    def answers(table: pa.Table) -> dict[int, tuple[int, bytes]]:
        return dict(zip(table.column("key").to_pylist(), zip(table.column("n").to_pylist(), table.column("a").to_pylist())))

    def sketch(key, table):
        return _table(_sketch(Block(table, width), layout, number(key)))

    def merge(table):
        return _table(_merge(table, layout))

    def ask(key, table, got):
        return _table(_ask(Block(table, width), layout, answers(got), number(key)) if table.num_rows else [])

    def group(table):
        return _table(_group(table))

    def remove(table, got):
        block = Block(table, width)
        gone = _covered(block, layout, answers(got), width)
        n_removed, digests, kept = [], [], []
        for text, words, end in zip(block.texts, block.words, block.ends):
            g = gone[end - len(words) : end]
            n = int(g.sum())
            n_removed.append(n)
            stay = words if not n else [w for w, x in zip(words, g) if not x]
            digests.append(hashlib.sha256(b" ".join(stay)).hexdigest())
            if texts:
                kept.append(kept_text(text, g) if n else text)
        own = table.take(pa.array(block.order, pa.int64()))
        columns = [own.column("id"), *[own.column(c).cast(nullable(own.schema.field(c).type)) for c in carried], pa.array([len(w) for w in block.words], pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
        if texts:
            columns.append(pa.array(kept, pa.binary()))
        return pa.table(columns, names=["id", *carried, "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])])

    merged = blocks.groupBy("block").applyInArrow(lean(sketch), PIECES).groupBy("key").applyInArrow(lean(merge), PIECES)
    grouped = blocks.groupBy("block").cogroup(merged.groupBy("block")).applyInArrow(lean(ask), PIECES).groupBy("key").applyInArrow(lean(group), PIECES)
    own = f"own struct<{', '.join(f'`{c}`: {kinds[c]}' for c in carry)}>, " if carry else ""
    given = f"given {kinds[id_col]}, " if ranked else ""
    schema = f"id bigint, {own}{given}n_words bigint, n_removed bigint, kept_sha256 string" + (", kept binary" if texts else "")
    out = blocks.groupBy("block").cogroup(merged.unionByName(grouped).groupBy("block")).applyInArrow(lean(remove), schema)
    return out.select((F.col("given") if ranked else F.col("id").cast(kinds[id_col])).alias(id_col), *[F.col("own").getField(c).alias(c) for c in carry], "n_words", "n_removed", "kept_sha256", *([F.col("kept").cast("string").alias("kept_text")] if texts else []))


def deduplicated_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", width: int = 20) -> DataFrame:
    """The documents with their columns and without repeated passages; other texts keep every byte.

    Every row stays, if need be with an empty text; null texts become empty. Null ids come first, and rows alike in id are taken in
    the order of their texts. An empty table gives no rows. Other columns may be null and have any names. A block holds its texts and
    words in memory, so a text of many megabytes makes its block that much larger.
    """
    own = docs.columns
    packed = docs.select(id_col, text_col, F.struct(F.lit(None).cast("string").alias(unused_name(own)), *[F.col(c) for c in own if c not in (id_col, text_col)]).alias("__own"))
    rows = substring_dedup(packed, id_col, text_col, width, carry=("__own",), texts=True)

    def column(c: str) -> F.Column:
        if c == id_col:
            return F.col(id_col)
        if c == text_col:
            return F.col("kept_text").alias(c)
        before = F.col("__own").getField(c)
        return (F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(before) if c == length_col else before).alias(c)

    return rows.select(*[column(c) for c in own])
