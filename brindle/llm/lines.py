"""Line dedup: lines that many documents hold stay in the largest of these documents only.

The hashes of all lines are kept in levelled sorted runs. A run is a table of (line hash, number of documents, largest document),
bucketed and sorted by the hash. Documents come in batches, those of the largest ids first. A batch is aggregated by hash,
merge-anti-joined with each run (what a run has settled is not written again), and written as a run of level 0; as soon as a level has
`fanout` runs, they are compacted into one run of the next level. Runs and batches are bucketed alike, so the
joins move no run. At last the runs' counts are added up. Runs know a line by 64 bits; the lines that seem frequent are
counted again by 128 bits.

A hot line is a row per task and batch in the shuffles, whatever number of documents have it. The number of batches is
fixed, so each is a job of its own whose size follows the input.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from brindle.llm.common import checkpoint, nullable, release_memory, remove_folder, scratch_folder, small, write_step

WHITE = b" \t\n\v\f\r"
#: Bytes that continue a code point in UTF-8.
CONTINUING = bytes(range(0x80, 0xC0))
#: Batches that a table is dealt into, and the runs of a level that are compacted into one.
BATCHES, FANOUT = 6, 3


def line_key(line: bytes) -> bytes:
    """What makes lines the same: the line without white space at its ends, A-Z in lower case."""
    return line.strip(WHITE).lower()


def code_points(key: bytes) -> int:
    return len(key.translate(None, CONTINUING))


class LineRuns:
    """Levelled sorted runs of line hashes, in tables below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, top_type: str, documents: int, fanout: int = FANOUT):
        self.spark, self.folder, self.top_type, self.documents, self.fanout = spark, folder, top_type, documents, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        path = f"{self.folder}/{name}"
        rows.write.format("parquet").bucketBy(self.buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        # read by path, without their buckets: Spark 4.1 plans a union of bucketed tables as if it were still bucketed, and misses rows
        rows = self.spark.read.schema(f"h long, n int, top {self.top_type}").parquet(*[path for _, path in runs])
        # the count stops where it no longer matters, so no sum of runs overflows
        return rows.groupBy("h").agg(F.least(F.sum("n"), F.lit(self.documents)).cast("int").alias("n"), F.max("top").alias("top"))

    def add(self, batch: DataFrame) -> None:
        """(h, n, top) of a batch's lines, a row per line hash, as a run. What a run has settled, by enough documents and a
        larger one than the batch's, adds nothing and isn't written."""
        for name, _ in self.runs():
            settled = self.spark.table(name).where(F.col("n") >= self.documents).select(F.col("h").alias("__h"), F.col("top").alias("__top"))
            batch = batch.join(settled, (F.col("h") == F.col("__h")) & (F.col("__top") >= F.col("top")), "left_anti")
        self._write(batch, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full = self.levels[level]
            self._write(self._merged(full), level + 1)
            self.levels[level] = []
            self._drop(full)
            level += 1

    def frequent(self) -> DataFrame:
        """(h, n, top) of the hashes that enough documents have."""
        if not self.runs():
            return self.spark.createDataFrame([], f"h long, n int, top {self.top_type}")
        return self._merged(self.runs()).where(F.col("n") >= self.documents)

    def runs(self) -> list[tuple[str, str]]:
        return [x for level in self.levels for x in level]

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, _ in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        """Forgets the tables. Their files go with the folder."""
        self._drop(self.runs())
        self.levels = []


def _line_rows(table: pa.Table, least: int) -> pa.Table:
    """A row per line that is long enough: its document's batch, id and mark, its place, two hashes, and whether it is the first of its
    key in the document."""
    import xxhash

    row, at, h, g, first = [], [], [], [], []
    for i, text in enumerate(table.column("text")):
        seen = set()
        for k, line in enumerate((text.as_py() or b"").lower().split(b"\n")):
            key = line.strip(WHITE)
            if len(key) < least or len(key) < 4 * least and code_points(key) < least:
                continue
            a, b = xxhash.xxh3_64_intdigest(key), xxhash.xxh64_intdigest(key)
            row.append(i)
            at.append(k)
            h.append(a)
            g.append(b)
            first.append(not (a, b) in seen)
            seen.add((a, b))
    rows = table.select(["batch", "id", "mark"]).take(pa.array(row, pa.int64()))
    signed = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64), pa.int64())
    for name, values in (("at", pa.array(at, pa.int32())), ("h", signed(h)), ("g", signed(g)), ("first", pa.array(first, pa.bool_()))):
        rows = rows.append_column(name, values)
    return rows


def _batches(docs: DataFrame, id_col: str, batches: int) -> F.Column:
    """The batch of an id: the largest ids come first where ids are numbers, else ids are dealt by hash. It settles when a
    document is looked at, never what becomes of it."""
    if not isinstance(docs.schema[id_col].dataType, NumericType):
        return F.pmod(F.xxhash64(id_col), F.lit(batches)).cast("int")
    bounds = docs.agg(F.percentile_approx(F.col(id_col).cast("double"), [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    place = F.lit(0)
    for b in bounds:
        place = place + F.when(F.col(id_col).cast("double") > b, 0).otherwise(1)
    return place.cast("int")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, documents: int = 3, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(id, mark, dropped): the places of the lines that each document loses, for documents that lose any; `mark` is the hash of its text."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]
    folder = scratch_folder(spark, "lines")
    named = docs.select(_batches(docs, id_col, batches).alias("batch"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("binary").alias("text"))

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield from _line_rows(pa.Table.from_batches([part]), least).to_batches()
        release_memory()

    schema = f"batch int, id {kind}, mark long, at int, h long, g long, first boolean"
    write_step(named.mapInArrow(hashed, schema), f"{folder}/lines", by=("batch",))
    lines = spark.read.schema(schema).parquet(f"{folder}/lines")
    runs = LineRuns(spark, folder, kind, documents, fanout)
    try:
        for batch in range(batches):
            rows = lines.where(F.col("batch") == batch)
            runs.add(rows.groupBy("h").agg(F.least(F.count_if("first"), F.lit(documents)).cast("int").alias("n"), F.max("id").alias("top")))
        seem = checkpoint(runs.frequent().select("h"))
    finally:
        runs.close()
    exact = lines.join(small(seem), "h", "left_semi").groupBy("h", "g").agg(F.count_if("first").alias("n"), F.max("id").alias("top")).where(F.col("n") >= documents).select("h", "g", "top")
    lost = lines.join(small(checkpoint(exact)), ["h", "g"]).where(~F.col("id").eqNullSafe(F.col("top")))
    out = checkpoint(lost.groupBy("id", "mark").agg(F.collect_set("at").alias("dropped")))
    remove_folder(spark, folder)
    return out


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), texts: bool = False, least: int = 20, documents: int = 3, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """One row per input row: id, carried columns, n_lines, n_dropped, kept_sha256 and, with `texts`, the kept text.

    A line's key is the line without white space at its ends and with A-Z in lower case. Keys of at least `least` code points that
    at least `documents` documents have lose all their lines except in the largest id that has them. Null and empty texts
    have one empty line. A row is a document, so equal rows count as often as they stand there; all rows of the
    largest id keep a line. A null id is the smallest; lines that only null ids have stay. An empty table gives no
    rows. Columns that are neither named nor carried are ignored, whatever their names. A text is held whole by one worker.
    """
    kinds = dict(docs.dtypes)
    lost = dropped_lines(docs, id_col, text_col, least, documents, batches, fanout).select(F.col("id").alias("lost_id"), F.col("mark").alias("lost_mark"), "dropped")
    own = F.struct(F.col(id_col).alias("c0"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry, 1)])
    named = docs.select(own.alias("own"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("binary").alias("text"))
    joined = named.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("mark") == F.col("lost_mark")), "left").select("own", "text", "dropped")

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n_lines, n_dropped, digests, kept = [], [], [], []
            for text, dropped in zip(part.column("text"), part.column("dropped")):
                lines, gone = (text.as_py() or b"").split(b"\n"), set(dropped.as_py() or ())
                out = b"\n".join([x for i, x in enumerate(lines) if i not in gone] if gone else lines)
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
                digests.append(hashlib.sha256(out).hexdigest())
                if texts:
                    kept.append(out if text.is_valid else None)
            before = part.column("own")
            columns = [before.cast(nullable(before.type)), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.binary())] if texts else []), names=["own", "n_lines", "n_dropped", "kept_sha256"] + (["kept"] if texts else []))
        release_memory()

    fields = ", ".join(f"c{i}: {kinds[c]}" for i, c in enumerate((id_col, *carry)))
    out = joined.mapInArrow(keep, f"own struct<{fields}>, n_lines long, n_dropped long, kept_sha256 string" + (", kept binary" if texts else ""))
    return out.select(*[F.col("own").getField(f"c{i}").alias(c) for i, c in enumerate((id_col, *carry))], "n_lines", "n_dropped", "kept_sha256", *([F.col("kept").cast("string").alias("kept_text")] if texts else []))


def deduplicated_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """The documents with their columns, without the lines that they lose; texts that lose none keep every byte, null ones stay null.

    Every row stays, if need be with an empty text. Other columns may be null and have any names.
    """
    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(docs.columns)]).alias("own"))
    rows = line_dedup(packed, "id", "text", carry=("own",), texts=True, **options)

    def column(i: int, c: str) -> F.Column:
        before = F.col("own").getField(f"o{i}")
        if c == text_col:
            return F.col("kept_text").alias(c)
        return (F.when(F.col("n_dropped") > 0, F.length("kept_text").cast(dict(docs.dtypes)[c])).otherwise(before) if c == length_col else before).alias(c)

    return rows.select(*[column(i, c) for i, c in enumerate(docs.columns)])
