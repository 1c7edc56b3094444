"""Phrase collocation mining: frequent phrases of each language, scored against their parts.

Shards are blocks of an input partition's documents. A shard numbers its words and keeps its texts as word ids. A suffix array
over these ids, built by prefix doubling in numpy, and its LCP array give the shard's n-gram counts: an interval of
suffixes that share k words is an n-gram of k words, and its length is the count. Counts merge globally by key, level by level,
and a level only takes n-grams whose first and last k - 1 words are frequent themselves (a frequent phrase has no other):

* level 1 merges words by (language, word); suffix arrays have suffixes of frequent words alone
* level k merges n-grams by the pair of names that level k - 1 gave to their first and last k - 1 words

Most n-grams are rare, so a level first adds counts up by hashed cells: a shard sends each part of the cells its own counts, packed, and
learns which of its cells reach the threshold over all shards. Only n-grams in such cells, which a rare one only shares by chance and a
frequent one never misses, are sent as rows to be counted exactly.

Shards are dealt to teams, as many as leave work for all tasks (see `teams_of`). A task adds up the n-grams of a team's shards, one shard
after the other, before it sends them: a row is an n-gram of a team, with its places in the team's shards, so that a frequent
phrase is a row per team, not per shard.

A name is where a phrase stands first: the team (of a word: the shard) and place of one of its intervals. So names are exact, without
hashes or a pass to number them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import checkpoint, lean, mix, pack, pack_bits, pack_sorted, release_memory, remove_folder, scratch_folder, unpack, unpack_bits, unpack_sorted, write_step

PIECE_ENDS = re.compile(rb"[.,;:!?\n-\r]+")
#: Bytes of text in a shard. Its arrays take some 20 times that in a worker while they are sorted.
SHARD_BYTES = 8 << 20
#: Shards that one input partition may have; shard ids are the partition's number times this, plus their own.
MOST_SHARDS = 4096
ENCODED = "shard long, place int, lang string, word string, n long, ids binary"
ARRAYS = "team int, shard long, suffixes binary, common binary, names binary"
SKETCH = "part int, team int, shard long, n int, cells binary, counts binary"
HEAVY = "team int, shard long, part int, n int, bits binary"
LEVEL = "own long, places array<int>, first long, last long, n long"
#: Shards of a team at most: a task holds their packed arrays and unpacks one at a time.
TEAM = 32
#: Rows of a batch that a step returns.
BATCH_ROWS = 50_000
#: Cells of a part of the sketch; words of text per cell, so that a cell of rare n-grams alone stays far below any threshold in use.
PART_BITS, WORDS_PER_CELL = 16, 16


class Shard:
    """Word ids of texts, in their order; 0 ends a piece."""

    def __init__(self):
        self.number = count(1).__next__
        self.ids: dict[str, defaultdict] = {}
        self.texts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, lang: str, text: bytes) -> None:
        words = PIECE_ENDS.sub(b" . ", text.lower()).split()
        if lang not in self.ids:
            self.ids[lang] = defaultdict(self.number, {b".": 0})
        self.texts.append(np.fromiter(map(self.ids[lang].__getitem__, words), dtype=np.int32, count=len(words)))
        self.texts.append(np.zeros(1, np.int32))
        self.bytes += len(text)

    def rows(self, name: int) -> pa.Table:
        """A row of each word (place: its id, n: its count), and one of the texts' ids at place 0."""
        ids = np.concatenate(self.texts)
        counts = np.bincount(ids)
        parts = []
        for lang, own in self.ids.items():
            own.pop(b".")
            at = np.fromiter(own.values(), dtype=np.int32, count=len(own))
            k = len(at)
            parts.append(pa.table([pa.array(np.full(k, name), pa.int64()), pa.array(at), pa.array([lang] * k, pa.string()), pa.array(list(own), pa.binary()).cast(pa.string()), pa.array(counts[at], pa.int64()), pa.nulls(k, pa.binary())], names=["shard", "place", "lang", "word", "n", "ids"]))
        texts = [[name], [0], [None], [None], [0], [pack(ids)]]
        parts.append(pa.table([pa.array(x, f.type) for x, f in zip(texts, parts[0].schema if parts else pa.schema([("a", pa.int64()), ("b", pa.int32()), ("c", pa.string()), ("d", pa.string()), ("e", pa.int64()), ("f", pa.binary())]))], names=["shard", "place", "lang", "word", "n", "ids"]))
        return pa.concat_tables(parts)


def encoded(docs: DataFrame, lang_col: str, text_col: str, shard_bytes: int) -> DataFrame:
    """The shards of `docs` (see Shard.rows), made where the documents are read: no text is shuffled."""

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, made = TaskContext.get().partitionId(), count()

        def done(shard: Shard) -> Iterator[pa.RecordBatch]:
            k = next(made)
            if k >= MOST_SHARDS:
                raise ValueError(f"an input partition has over {MOST_SHARDS} shards of {shard_bytes} bytes: read it in smaller partitions")
            yield from shard.rows(partition * MOST_SHARDS + k).to_batches(max_chunksize=BATCH_ROWS)
            release_memory()

        shard = Shard()
        for part in parts:
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text")):
                shard.add(lang, text.as_py())
                if shard.bytes >= shard_bytes:
                    yield from done(shard)
                    shard = Shard()
        if shard.texts:
            yield from done(shard)

    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).mapInArrow(encode, ENCODED)


def suffix_array(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, common): starts of the suffixes in the order of their first `depth` words, and how many of these each has in common
    with the one before. 0 is no word: no suffix starts there, and nothing beyond it counts.

    Prefix doubling: ranks of d words, paired with those d words on (fewer at last), are ranks of 2 d words.
    """
    n = len(words)
    rank, d = words.astype(np.int64), 1
    while d < depth:
        step = min(d, depth - d)
        on = np.zeros(n, dtype=np.int64)
        on[: n - step] = rank[step:] + 1
        _, rank = np.unique(rank * (int(on.max(initial=0)) + 1) + on, return_inverse=True)
        d += step
    starts = np.flatnonzero(words)
    suffixes = starts[np.argsort(rank[starts], kind="stable")].astype(np.int32)
    common = np.zeros(len(suffixes), dtype=np.uint8)
    padded = np.concatenate([words, np.zeros(depth, words.dtype)])
    same = np.ones(max(len(suffixes) - 1, 0), dtype=bool)
    for k in range(depth):
        here = padded[suffixes[1:] + k]
        same &= (here == padded[suffixes[:-1] + k]) & (here > 0)
        common[1:] += same
    return suffixes, common


def intervals(suffixes: np.ndarray, common: np.ndarray, k: int, name: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, first, last, n) of the n-grams of k words whose parts of k - 1 words both have a name; `name` has one for each
    position of the texts, -1 where there's none, and is one longer."""
    starts = np.flatnonzero(common < k)
    sizes = np.diff(starts, append=len(suffixes))
    at = suffixes[starts]
    first, last = name[at], name[at + 1]
    good = (first >= 0) & (last >= 0)
    return starts[good], first[good], last[good], sizes[good]


def _named(places: np.ndarray, names: np.ndarray, size: int) -> np.ndarray:
    out = np.full(size, -1, dtype=np.int64)
    out[places] = names
    return out


def teams_of(shards: int, tasks: int) -> int:
    """How many teams shards are dealt to: as many as tasks run at a time, or a multiple, so that none has over `TEAM`."""
    return min(shards, tasks * -(-shards // (tasks * TEAM)))


def _arrays(key, texts: pa.Table, answers: pa.Table) -> pa.Table:
    """A shard's suffix array over its frequent words, and the names of these in its order."""
    columns = ["team", "shard", "suffixes", "common", "names"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    if not texts.num_rows or not answers.num_rows:
        return pa.table([pa.array([], k) for k in kinds], names=columns)
    ids = unpack(texts.column("ids")[0].as_py(), np.int32)
    name = _named(answers.column("place").to_numpy(), answers.column("name").to_numpy(), int(ids.max(initial=0)) + 1)[ids]
    suffixes, common = suffix_array(np.where(name >= 0, ids, 0), texts.column("depth")[0].as_py())
    row = (texts.column("team")[0].as_py(), texts.column("shard")[0].as_py(), pack(suffixes), pack(common), pack(name[suffixes[common < 1]]))
    return pa.table([pa.array([x], k) for x, k in zip(row, kinds)], names=columns)


def _counts(arrays: pa.Table, answers: pa.Table, k: int) -> Iterator[tuple]:
    """(shard, place, first, last, n) of the n-grams of k words with frequent parts, for one shard of a team after the other. Places are those in
    the team: a shard's go on from the end of the one before. `answers` has the names of the level before, by places."""
    told = answers.filter(answers.column("places").is_valid()) if answers.num_rows else answers
    places = names = np.empty(0, np.int64)
    if told.num_rows:
        lists = told.column("places").combine_chunks()
        places, names = lists.flatten().to_numpy(), np.repeat(told.column("name").to_numpy(), lists.value_lengths().to_numpy())
        order = np.argsort(places)
        places, names = places[order], names[order]
    column = {c: arrays.column(c) for c in arrays.column_names}
    first_place = 0
    for row in np.argsort(column["shard"].to_numpy()).tolist():
        suffixes, common = unpack(column["suffixes"][row].as_py(), np.int32), unpack(column["common"][row].as_py(), np.uint8)
        starts = np.flatnonzero(common < k - 1)
        if k == 2:
            of_interval = unpack(column["names"][row].as_py(), np.int64)
        else:
            own = slice(*np.searchsorted(places, [first_place, first_place + len(suffixes)]))
            of_interval = _named(places[own] - first_place, names[own], len(suffixes))[starts]
        name = np.full(int(suffixes.max(initial=0)) + 2, -1, dtype=np.int64)
        name[suffixes] = np.repeat(of_interval, np.diff(starts, append=len(suffixes)))
        place, first, last, n = intervals(suffixes, common, k, name)
        yield column["shard"][row].as_py(), first_place + place, first, last, n
        first_place += len(suffixes)


def cells_of(first: np.ndarray, last: np.ndarray, bits: int) -> np.ndarray:
    return mix(first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(last.view(np.uint64))) >> np.uint64(64 - bits)


def _sketch(arrays: pa.Table, answers: pa.Table, k: int, bits: int) -> pa.Table:
    """Counts by cell of each of a team's shards: a row for each part of the cells that a shard has any in."""
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    tables = [pa.table([pa.array([], kind) for kind in kinds], names=["part", "team", "shard", "n", "cells", "counts"])]
    for shard, _, first, last, n in _counts(arrays, answers, k) if arrays.num_rows else ():
        cells, where = np.unique(cells_of(first, last, bits), return_inverse=True)
        counts = np.bincount(where, n, minlength=len(cells)).astype(np.uint32)
        parts = cells >> np.uint64(PART_BITS)
        starts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(cells) else np.empty(0, int)
        inner, team = (cells & np.uint64((1 << PART_BITS) - 1)).astype(np.uint16), arrays.column("team")[0].as_py()
        rows = [(int(parts[a]), team, shard, int(b - a), pack_sorted(inner[a:b]), pack(counts[a:b])) for a, b in zip(starts, [*starts[1:], len(cells)])]
        tables.append(pa.table([pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [()] * 6, kinds)], names=tables[0].column_names))
    return pa.concat_tables(tables)


def _heavy(table: pa.Table, least: int) -> pa.Table:
    """Counts of a part of the cells over all shards; each shard learns which of its cells reach the threshold."""
    total = np.zeros(1 << PART_BITS, dtype=np.int64)
    cells = [unpack_sorted(c.as_py(), np.uint16) for c in table.column("cells")]
    for own, counts in zip(cells, table.column("counts")):
        total[own] += unpack(counts.as_py(), np.uint32)
    bits = [pack_bits(total[own] >= least) for own in cells]
    return pa.table([*(table.column(c) for c in ("team", "shard", "part", "n")), pa.array(bits, pa.binary())], names=["team", "shard", "part", "n", "bits"])


def _exact(arrays: pa.Table, answers: pa.Table, k: int, bits: int) -> pa.Table:
    """A row of each of a team's n-grams in a heavy cell. `answers` has names of the level before and the sketch's bits, each where
    the other is null."""
    found = []
    if arrays.num_rows and answers.num_rows:
        told = answers.filter(answers.column("part").is_valid()).sort_by([("shard", "ascending"), ("part", "ascending")])
        of_row, sizes, packed = told.column("shard").to_numpy(), told.column("n").to_pylist(), told.column("bits")
        for shard, place, first, last, n in _counts(arrays, answers, k):
            own = range(*np.searchsorted(of_row, [shard, shard + 1]))
            _, where = np.unique(cells_of(first, last, bits), return_inverse=True)
            good = np.concatenate([unpack_bits(packed[i].as_py(), sizes[i]) for i in own])[where] if own else np.zeros(len(first), dtype=bool)
            found.append((place[good], first[good], last[good], n[good]))
    place, first, last, n = (np.concatenate(x).astype(np.int64) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 4
    order = np.lexsort((place, last, first))
    place, first, last = place[order], first[order], last[order]
    starts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])])) if len(place) else np.empty(0, int)
    total = np.add.reduceat(n[order], starts) if len(place) else n
    own = place[starts] + ((arrays.column("team")[0].as_py() << 32) if arrays.num_rows else 0)
    places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(place)).astype(np.int32)), pa.array(place.astype(np.int32)))
    out = pa.table([pa.array(own), places, pa.array(first[starts]), pa.array(last[starts]), pa.array(total)], names=["own", "places", "first", "last", "n"])
    return pa.Table.from_batches(out.to_batches(max_chunksize=BATCH_ROWS), out.schema)


def _step(f, k: int, bits: int):
    def of_team(key, arrays, answers):
        return f(arrays, answers, k, bits)

    return lean(of_team)


def _merged(rows: DataFrame, key: list[str], least: int) -> DataFrame:
    """Rows (own, n, key) of the keys that are frequent over all, with their count and name. One shuffle by key."""
    over = Window.partitionBy(*key)
    summed = rows.withColumns({"f": F.sum("n").over(over), "name": F.min("own").over(over)}).where(F.col("f") >= least)
    return summed.drop("n").withColumn("leads", F.col("name") == F.col("own"))


def _longer_phrases(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases of a level (name, lang, words, f, firsts, rests, first, last): `firsts` has the counts of their first 1, 2, ... words, `rests`
    those of their last 1, 2, ..."""
    a = shorter.select(F.col("name").alias("first"), F.col("lang"), F.col("words").alias("a_words"), F.array_append("firsts", F.col("f")).alias("firsts"))
    b = shorter.select(F.col("name").alias("last"), F.element_at("words", -1).alias("word"), F.array_append("rests", F.col("f")).alias("rests"))
    return found.join(a, "first").join(b, "last").select("name", "lang", F.array_append("a_words", F.col("word")).alias("words"), "f", "firsts", "rests", "first", "last")


def candidates(docs: DataFrame, lang_col: str, text_col: str, least: int, longest: int, shard_bytes: int, folder: str) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, total) and, for each length from 1 to `longest`, the frequent phrases; all in tables below `folder`."""
    spark = docs.sparkSession
    table = lambda name: spark.read.parquet(f"{folder}/{name}")
    write_step(encoded(docs, lang_col, text_col, shard_bytes), f"{folder}/shards")
    shards = spark.read.schema(ENCODED).parquet(f"{folder}/shards")
    vocabulary = shards.where("place > 0").select((F.shiftleft(F.col("shard"), 32) + F.col("place")).alias("own"), "lang", "word", "n", F.xxhash64("lang", "word").alias("h"))
    write_step(vocabulary.groupBy("lang").agg(F.sum("n").alias("total")), f"{folder}/totals")
    write_step(_merged(vocabulary, ["h", "lang", "word"], least), f"{folder}/words1")
    empty = F.array().cast("array<long>")
    levels = [table("words1").where("leads").select("name", "lang", F.array("word").alias("words"), "f", empty.alias("firsts"), empty.alias("rests"))]
    words = table("totals").agg(F.sum("total")).first()[0] or 0
    bits = max(PART_BITS, (words // WORDS_PER_CELL).bit_length())
    texts = shards.where("place = 0")
    teams = max(1, teams_of(texts.count(), spark.sparkContext.defaultParallelism))
    # a row for each shard, so this window holds a few rows
    dealt = texts.select("shard", F.pmod(F.row_number().over(Window.orderBy("shard")), F.lit(teams)).alias("team"))
    texts = texts.join(F.broadcast(dealt), "shard").select("team", "shard", "ids", F.lit(longest).alias("depth"))
    shard, place = F.shiftright("own", 32).alias("shard"), F.col("own").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("place")
    write_step(texts.groupBy("shard").cogroup(table("words1").select(shard, place, "name").groupBy("shard")).applyInArrow(lean(_arrays), ARRAYS), f"{folder}/arrays")
    remove_folder(spark, f"{folder}/shards")
    arrays = spark.read.schema(ARRAYS).parquet(f"{folder}/arrays")
    for k in range(2, longest + 1):
        named = spark.createDataFrame([], "team int, places array<int>, name long") if k == 2 else table(f"words{k - 1}").select(F.shiftright("own", 32).cast("int").alias("team"), "places", "name")

        sketches = arrays.groupBy("team").cogroup(named.groupBy("team")).applyInArrow(_step(_sketch, k, bits), SKETCH)
        write_step(sketches.groupBy("part").applyInArrow(lean(lambda part: _heavy(part, least)), HEAVY), f"{folder}/heavy{k}")
        told = spark.read.schema(HEAVY).parquet(f"{folder}/heavy{k}").unionByName(named, allowMissingColumns=True)
        rows = arrays.groupBy("team").cogroup(told.groupBy("team")).applyInArrow(_step(_exact, k, bits), LEVEL)
        write_step(_merged(rows, ["first", "last"], least), f"{folder}/words{k}")
        remove_folder(spark, f"{folder}/heavy{k}")
        found = table(f"words{k}").where("leads").select("name", "first", "last", "f")
        write_step(_longer_phrases(found, levels[-1]), f"{folder}/phrases{k}")
        levels.append(table(f"phrases{k}"))
    return table("totals"), levels


def score(a: str, n: str, l: F.Column, r: F.Column) -> F.Column:
    """floor(1000 a n / (l r)), exact: products are decimals of 38 digits, and `div` of decimals has no digits after the point."""
    wide = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", wide(wide(F.lit(1000)) * F.col(a) * F.col(n)), wide(wide(l) * r)).cast("long")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases by score.

    Texts in lower case (A-Z) are cut into pieces at `[.,;:!?\\x0A-\\x0D]`, pieces into words `[^\\x20\\x09]+`. Phrases of 2 to `longest` words that occur
    `least` times or more score floor(1000 a n / (l r)) at the cut where that is lowest, the first of equal ones; a phrase within a longer one of at
    least `percent` of its count is left out. Arithmetic is in decimals of 38 digits. Ties go by count, then by bytes. Null
    texts are empty, a null language is `und`; equal rows count as often as they stand there; an empty table gives no rows. Other
    columns are ignored, whatever their names. A text is held whole by one worker.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "phrases")
    totals, levels = candidates(docs, lang_col, text_col, least, longest, shard_bytes, folder)
    kept = None
    for k in range(2, longest + 1):
        rows = levels[k - 1]
        if k < longest:
            # a phrase within any longer one of that count is also within one that is a word longer
            within = levels[k].select(F.explode(F.array("first", "last")).alias("part"), "f").groupBy("part").agg(F.max("f").alias("longer"))
            rows = rows.join(within, F.col("name") == F.col("part"), "left").where(F.coalesce(F.col("longer") * 100 < F.col("f") * percent, F.lit(True)))
        rows = rows.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "firsts", "rests")
        kept = rows if kept is None else kept.unionByName(rows)
    cuts = F.zip_with("firsts", F.reverse("rests"), lambda l, r: F.struct(l.alias("l"), r.alias("r")))
    scored = kept.join(totals, "lang").select("lang", "phrase", "a", F.col("total").alias("n"), cuts.alias("cuts"))
    best = F.array_min(F.transform("cuts", lambda c, i: F.struct(score("a", "n", c["l"], c["r"]).alias("score"), i.alias("at"), c["l"].alias("l"), c["r"].alias("r"))))
    scored = scored.select("lang", "phrase", "a", "n", best.alias("best")).select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # the first of each part of a language, then of these: no task gets all phrases of one
    part = F.pmod(F.xxhash64("phrase"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    first = scored.withColumn("part", part).withColumn("k", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("k") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    out = checkpoint(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    remove_folder(spark, folder)
    return out
