"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

Documents become token ids in one pass over the texts; what remains of a document is its pieces' lengths and
checksums. The histogram of lengths (at most `capacity` rows, whatever the corpus) goes to the driver, where
multiplicative weights solve the covering program over configurations (multisets of lengths that fit a
sequence): a length's weight falls exponentially with the share of its pieces that is covered, and an exact bounded
knapsack by dynamic programming prices the next configuration, which is used a whole number of times. It goes on with
configurations that fill less until every piece is covered; best fit places what an earlier stage leaves if that takes fewer sequences. Weights divided by their best price are a
dual solution, so the plan comes with a lower bound. Pieces then find their sequence by their number within their
length, in a join with the configurations.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import checkpoint, release_memory, worker_cache

CAPACITY, END_ID = 2048, 0
#: Entries of a worker's cache of chunk ids; a full cache is emptied, so memory stays bounded.
CACHE_ENTRIES = 150_000
#: Pieces of one length that one task numbers.
ROWS_IN_PART = 250
#: What share of a sequence a configuration has to fill: the program goes down from stage to stage, to the end.
FULL = (0.98, 0.9, 0.75, 0.5, 0.0)
#: Places of a length that are looked through at a time.
PLACES = 32


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---- tokens


def byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE file as bytes; in such a file a token's id is also its merge rank."""
    import json

    with open(path) as f:
        model = json.load(f)
    # byte-level BPE writes printable bytes as themselves and the others, in order, as characters from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    special = {t["content"] for t in model.get("added_tokens", [])}
    return {bytes(shown[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes; the vocabulary is that of the `tokenizers` file.

    That library takes about 1 MB of new words a second and core, so the merges are run by tiktoken on the same
    vocabulary, which gives the same ids several times as fast; tests hold one against the other.

    The tokenizer cuts a text before each run of white space that follows a word and starts with a space, so the
    chunks between such places have ids of their own. Chunks repeat; their ids are cached.

    The file's added tokens are cut out first and have their own ids, as in the library; as there, special ones among
    them are plain text under `encode_special_tokens`, which the library has off unless told otherwise. Texts with
    added tokens that take more than their own characters along (or that match in part) are left to the library.
    """

    def __init__(self, path: str, encode_special_tokens: bool = False):
        import json
        import re
        from array import array

        import public_tokenizers
        import tiktoken

        bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_ranks(path), special_tokens={})

        class Cache(dict):
            """Ids of the chunks that follow a space, by chunk."""

            def __missing__(self, chunk: str) -> bytes:
                out = self[chunk] = array("I", bpe.encode_ordinary(" " + chunk)).tobytes()
                return out

        self.ids = lambda text: array("I", bpe.encode_ordinary(text)).tobytes()
        self.cache = Cache()
        self.odd = re.compile(r"\s | \s| $").search
        self.runs = re.compile(r"(?<=\S)(?= )").split
        with open(path) as f:
            added = [t for t in json.load(f).get("added_tokens", []) if t["content"] and not (t["special"] and encode_special_tokens)]
        self.added = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        self.library = None
        release_memory()
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.encode_special_tokens = encode_special_tokens

    def encode(self, text: str) -> bytes:
        """The ids of one text."""
        from array import array

        if not any(t in text for t in self.added):
            return self.encode_plain(text)
        if self.library:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join([self.added.get(part) or self.encode_plain(part) for part in self.cut(text)])

    def encode_plain(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        get = self.cache.__getitem__
        if not self.odd(text):
            first, *rest = text.split(" ")
            return b"".join([self.ids(first) if first else b"", *map(get, rest)])
        first, *rest = self.runs(text)
        return b"".join([self.ids(first), *[get(c[1:]) for c in rest]])


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, carry: tuple[str, ...] = (), ids: bool = False) -> DataFrame:
    """A row per piece: id, carried columns, piece, start, length, ids_crc32 (and the ids as `<u4` bytes).

    A document is its ids, those of the tokenizer in its default setting, and `end_id`. Documents over `capacity` tokens are cut into full pieces from the end,
    so only the first piece may be shorter.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache()
        if path not in kept:
            kept[path] = Encoder(path)
        encoder = kept[path]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, piece, start, length, crc, raw = [], [], [], [], [], []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for i, text in enumerate(texts):
                    data = encoder.encode(text) + end
                    n = len(data) // 4
                    first = n % capacity or capacity
                    for k, a in enumerate([0, *range(first, n, capacity)]):
                        b = first if k == 0 else a + capacity
                        own = data[4 * a : 4 * b]
                        row.append(i), piece.append(k), start.append(a), length.append(b - a), crc.append(zlib.crc32(own)), raw.append(own if ids else None)
                keep = part.take(pa.array(row, pa.int64()))
                columns = [keep.column(0), *[keep.column(j) for j in range(2, keep.num_columns)], pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.array(raw, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        encoder.cache.clear()  # a worker lives on after its task
        release_memory()

    kinds = dict(docs.dtypes)
    names = [id_col, *carry, "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    schema = [f"`{id_col}` {kinds[id_col]}", *[f"`{c}` {kinds[c]}" for c in carry], "piece int, start bigint, length bigint, ids_crc32 bigint", *(["ids binary"] if ids else [])]
    return docs.select(F.col(id_col), F.col(text_col), *[F.col(c) for c in carry]).mapInArrow(pieces, ", ".join(schema))


# ---- the configuration program, on a histogram


def best_configurations(lengths: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int, many: int = 1, near: float = 0.98) -> list[tuple[dict[int, int], float]]:
    """Multisets of lengths within `capacity`, with at most `most` pieces of each, and their values: first the one of the
    largest value, then up to `many` - 1 others, each the best with another piece of more than half the capacity (or with
    none), of values of at least `near` times the largest.

    Exact: the counts of lengths up to half the capacity are split into powers of two and a rest, and each part is taken or not; of
    longer pieces a multiset has one at most, so their choice comes last. Values are positive, so what still fits is taken.
    """
    parts: list[tuple[int, int, int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        n, k = min(int(most[i]), capacity // int(lengths[i])) if 2 * lengths[i] <= capacity else 0, 1
        while n > 0:
            k = min(k, n)
            parts.append((int(i), k, k * int(lengths[i])))
            n, k = n - k, 2 * k
    best, taken, room = np.zeros(capacity + 1), np.zeros((len(parts), capacity + 1), dtype=bool), np.empty(capacity + 1)
    for j, (i, k, size) in enumerate(parts):
        with_it = np.add(best[: capacity + 1 - size], k * values[i], out=room[: capacity + 1 - size])
        np.greater(with_it, best[size:], out=taken[j, size:])
        np.maximum(with_it, best[size:], out=best[size:])
    long = np.flatnonzero((2 * lengths > capacity) & (lengths <= capacity) & (most > 0))
    total = np.append(values[long] + best[capacity - lengths[long]], best[capacity])
    out = []
    for c in np.argsort(-total, kind="stable")[:many]:
        if total[c] < near * total.max():
            break
        config: Counter = Counter()
        left = capacity
        if c < len(long):
            config[int(long[c])] += 1
            left -= int(lengths[long[c]])
        j = len(parts)
        while left > 0 and len(at := np.flatnonzero(taken[:j, left])):
            j = int(at[-1])
            config[parts[j][0]] += parts[j][1]
            left -= parts[j][2]
        out.append((dict(config), float(total[c])))
    return out


def best_configuration(lengths: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> tuple[dict[int, int], float]:
    return best_configurations(lengths, values, most, capacity)[0]


def lower_bound(lengths: np.ndarray, counts: np.ndarray, weights: np.ndarray, capacity: int) -> int:
    """The value of a dual solution: no packing has fewer sequences."""
    if not len(lengths):
        return 0
    price = best_configuration(lengths, weights, counts, capacity)[1]
    return math.ceil(float((counts * weights).sum()) / price - 1e-9)


def solve_configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int, rate: float = 1.0, tilt: float = 0.3, full: float = FULL[0], many: int = 16) -> tuple[list[tuple[int, dict[int, int]]], np.ndarray, int]:
    """(times, configuration) of an approximate solution of min sum(x) with every length covered `counts` times, the
    counts that it leaves, and a lower bound of the optimum.

    Lengths start with weights that grow a little faster than their size, so that of two full configurations the one
    of longer pieces pays more and short ones are left to fill gaps. Every round prices `many` configurations, uses each as
    often as its scarcest length allows, so that there are about as many of them as lengths, and lowers the weights of what
    they cover.
    """
    left = counts.copy()
    start = lengths / capacity * (1 + tilt * lengths / capacity)
    bound = max(lower_bound(lengths, counts, w, capacity) for w in (lengths / capacity, start))
    out: list[tuple[int, dict[int, int]]] = []
    while len(open_ := np.flatnonzero(left)):
        weights = start[open_] * np.exp(rate * (left[open_] / counts[open_] - 1))
        used = 0
        for found, _ in best_configurations(lengths[open_], weights, left[open_], capacity, many):
            config = {int(open_[i]): n for i, n in found.items()}
            times = min(int(left[i]) // n for i, n in config.items()) if config else 0
            if times and sum(int(lengths[i]) * n for i, n in config.items()) >= full * capacity:
                for i, n in config.items():
                    left[i] -= times * n
                out.append((times, config))
                used += times
        if not used:
            break
    return out, left, bound


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Counter:
    """Best-fit decreasing over a histogram: {configuration as sorted (length index, number) pairs: times}.

    Bins are kept in groups of equal content, so the work follows the number of lengths, not of pieces.
    """
    bins: list[Counter] = [Counter() for _ in range(capacity + 1)]  # by room left: content -> bins
    for i in np.argsort(-lengths):
        size, n = int(lengths[i]), int(counts[i])
        while n > 0:
            room = next((r for r in range(size, capacity) if bins[r]), capacity)
            if room == capacity:
                each = min(n, capacity // size)
                many = n // each
                bins[capacity - each * size][((int(i), each),)] += many
                n -= many * each
                continue
            content, many = next(iter(bins[room].items()))
            each = min(n, room // size)
            used = min(many, n // each)
            bins[room][content] -= used
            if not bins[room][content]:
                del bins[room][content]
            bins[room - each * size][(*content, (int(i), each))] += used
            n -= used * each
    out: Counter = Counter()
    for group in bins:
        out.update(group)
    return out


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], dict[str, int]]:
    """Rows (length, first, last, each, sequence, offset): pieces first..last-1 of a length go `each` to a
    sequence, the first ones to `sequence`, starting at `offset`. Every piece has a place. Beside them the numbers of
    sequences from the `program` and from best fit (`rest`), and the lower `bound`.

    The program runs until it covers every piece, with configurations that fill less and less. Of its stages the one counts that gives the fewest
    sequences with best fit for what it leaves, the latest of equal ones: best fit only places what the program has left.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    solution, left, bound = solve_configurations(lengths, counts, capacity)
    best = (solution, best_fit(lengths, left, capacity))
    for full in FULL[1:]:
        if not left.any():
            break
        more, left, _ = solve_configurations(lengths, left, capacity, full=full)
        solution = solution + more
        rest = best_fit(lengths, left, capacity)
        if sum(n for n, _ in solution) + sum(rest.values()) <= sum(n for n, _ in best[0]) + sum(best[1].values()):
            best = (solution, rest)
    solution, rest = best
    used = np.zeros(len(lengths), dtype=np.int64)
    rows, sequence = [], 0
    for config, times in [*((tuple(sorted(c.items())), n) for n, c in solution), *rest.items()]:
        offset = 0
        for i, each in config:
            rows.append((int(lengths[i]), int(used[i]), int(used[i] + each * times), int(each), sequence, offset))
            used[i] += each * times
            offset += each * int(lengths[i])
        sequence += times
    if not np.array_equal(used, counts):
        raise AssertionError("a piece has no place")
    return rows, {"program": sum(n for n, _ in solution), "rest": sum(rest.values()), "bound": bound}


# ---- the packing


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per piece: id, carried columns, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone, one piece of length 1. Texts of any length are encoded whole. Rows
    alike in id or text are documents of their own. An empty table gives no rows; null ids stay null. Columns
    that are neither named nor carried are ignored, whatever their names.

    The pieces (a few dozen bytes each, no texts) are written once to the checkpoint folder, so texts are encoded
    once. Numbers within a length are given in parts, so a length that most pieces have is spread over tasks.
    """
    spark = docs.sparkSession
    spread = F.xxhash64(F.col(id_col), F.col("ids_crc32"), F.col("piece"), F.col("start"))
    pieces = checkpoint(token_pieces(docs, id_col, text_col, tokenizer, capacity, end_id, carry).withColumn("__spread", spread))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not histogram:
        return pieces.drop("__spread").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    parts = max(1, -(-max(histogram.values()) // ROWS_IN_PART))
    cut = pieces.withColumn("__part", F.pmod(F.col("__spread"), F.lit(parts)).cast("int"))
    sizes = cut.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("length").alias("__l"), F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    order = Window.partitionBy("length", "__part").orderBy("__spread", id_col, "piece")
    numbered = cut.withColumn("__row", F.row_number().over(order) - 1).join(starts, (F.col("length") == F.col("__l")) & (F.col("__part") == F.col("__p"))).withColumn("__number", F.col("__first") + F.col("__row"))
    # at most capacity lengths and as many configurations, whatever the corpus, so the table of places is bounded. The places of a
    # length are in order, in groups of PLACES: the group is found by its first number, then the place in it
    by_length: dict[int, list] = {}
    for length, first, last, each, sequence, offset in plan_sequences(histogram, capacity)[0]:
        by_length.setdefault(length, []).append((first, last, each, sequence, offset))
    grouped = [(k, [v[i][0] for i in range(0, len(v), PLACES)], [v[i : i + PLACES] for i in range(0, len(v), PLACES)]) for k, v in by_length.items()]
    places = spark.createDataFrame(grouped, "__k bigint, __tops array<bigint>, __places array<array<struct<first: bigint, last: bigint, each: bigint, sequence: bigint, offset: bigint>>>")
    found = numbered.join(F.broadcast(places), F.col("length") == F.col("__k"))
    near = F.col("__places")[F.size(F.filter("__tops", lambda t: t <= F.col("__number"))) - 1]
    place = F.filter(near, lambda p: (p["first"] <= F.col("__number")) & (F.col("__number") < p["last"]))[0]
    found = found.withColumn("__place", place).withColumn("__at", F.col("__number") - F.col("__place.first"))
    each = F.col("__place.each")
    sequence = (F.col("__place.sequence") + F.floor(F.col("__at") / each)).cast("long")
    offset = (F.col("__place.offset") + (F.col("__at") % each) * F.col("length")).cast("long")
    return found.withColumns({"sequence_id": sequence, "offset": offset}).select(id_col, *carry, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
