"""What the operators share: words, hashes, blobs, blocks, numbering and the checkpoint folder."""

from __future__ import annotations

import contextlib
import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white-space bytes, which is what bytes.split() cuts at.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of text that one block (the unit of the block operators, held by one Python worker) has on average.
BLOCK_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Has Spark remove a plan's shuffle files when the plan has run, not when the driver happens to collect its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that the session names. Only a local session may go without one: its one machine has its own folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="brindle-checkpoint-")
    sc.setCheckpointDir(named)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, for tables that a query writes and reads again."""
    import uuid

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of an Arrow batch while a step runs: ten thousand texts at a time, the default, are buffers of 100 MB and more in each task.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def step_settings(spark: SparkSession):
    """While a step runs: shuffles go with their plan, Arrow batches are small."""
    before = {k: spark.conf.get(k, None) for k in (REMOVE_SHUFFLES, ARROW_ROWS)}
    spark.conf.set(REMOVE_SHUFFLES, "true")
    spark.conf.set(ARROW_ROWS, "1024")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def checkpoint(df: DataFrame, sweep: bool = False) -> DataFrame:
    """Cut the lineage with files in the shared checkpoint folder. The shuffles that made them aren't needed again and go.

    Executors keep the broadcast relations of finished plans until the driver has collected the garbage that names them; with
    `sweep`, which is for queries of many steps, it does so now.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with step_settings(df.sparkSession):
        out = df.checkpoint(eager=True)
    if sweep:
        df.sparkSession.sparkContext._jvm.System.gc()
    return out


def write_step(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """A step's rows as a table in a scratch folder, compressed, for steps that read some of its columns."""
    with step_settings(df.sparkSession):
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)


#: Rows of a few numbers that a join may broadcast: some 30 MB.
MOST_BROADCAST = 500_000


def small(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """A checkpointed table of a few numbers a row, broadcast if its counted rows allow; a join shuffles it beyond that."""
    return F.broadcast(df) if df.count() <= most else df


def lean(f):
    """`f`, after which the worker gives the memory that it freed back to the system; workers live on between tasks."""

    def run(*args):
        out = f(*args)
        release_memory()
        return out

    import functools
    import inspect

    run = functools.wraps(f)(run)
    run.__signature__ = inspect.signature(f)
    return run


def release_memory() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def words_expr(text) -> F.Column:
    """The words of a text (null: none) as an array, on the JVM."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def n_words_expr(text) -> F.Column:
    """Their number, without the array of words."""
    packed = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w"), SPACE_CLASS + "+", "")
    return F.length(packed).cast("long")


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker (module globals of by-value functions don't)."""
    import sys
    import types

    return sys.modules.setdefault("_brindle_worker_cache", types.ModuleType("_brindle_worker_cache")).__dict__


# ---- words and hashes, in numpy


class WordIds:
    """Local ids of the words of a batch of texts, and two independent 64-bit hashes of each distinct word."""

    def __init__(self):
        from collections import defaultdict
        from itertools import count

        # a counter, not the dictionary's own length: a cycle of references would keep the words until the garbage collector runs
        self.ids = defaultdict(count().__next__)

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words))

    def hashes(self) -> np.ndarray:
        import xxhash

        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.ids), dtype=np.uint64, count=len(self.ids))

    def second_hashes(self) -> np.ndarray:
        import xxhash

        return np.fromiter(map(xxhash.xxh64_intdigest, self.ids), dtype=np.uint64, count=len(self.ids))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def window_hashes(x: np.ndarray, width: int, base: int) -> np.ndarray:
    """A polynomial hash of each run of `width` values: one prefix sum, whatever the width."""
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(x * powers(base, len(x)), out=sums[1:])
    return mix((sums[width:] - sums[:n]) * powers(pow(base, -1, 1 << 64), n))


# ---- blobs: arrays of integers as bytes


def pack(a: np.ndarray) -> bytes:
    """Bytes of an integer array, the low bytes of all values first, so that small values compress well."""
    import zstandard

    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes, dtype) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    size = np.dtype(dtype).itemsize
    if not raw:
        return np.empty(0, dtype=dtype)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    """Bytes of an ascending array: its differences."""
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(blob: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(blob, dtype), dtype=dtype)


def pack_bits(a: np.ndarray) -> bytes:
    return np.packbits(a).tobytes()


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=n).astype(bool)


# ---- blocks


def text_blocks(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES, by: tuple[str, ...] = (), total: int | None = None) -> tuple[DataFrame, int, int]:
    """Documents dealt into blocks of about `block_bytes` of text by a hash of the columns `by`, or of their id.

    Returns (block, id, text as bytes, carried columns), the number of blocks and of bytes. All rows that are alike in the
    hashed columns are in one block. Several passes over the same blocks reuse one shuffle. The bytes are counted unless `total` has them.
    """
    if total is None:
        total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64(*[F.col(c) for c in by or (id_col,)]), F.lit(n)).cast("int")
    return docs.select(block.alias("block"), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), *[F.col(c) for c in carry]), int(n), int(total)


# ---- numbering


def number_in_groups(df: DataFrame, group: list[str], order: list, spread: F.Column, n_rows: int, out: str, rows_in_task: int = 20_000) -> DataFrame:
    """Adds `out`: gapless numbers from 0 within each group, without a task that gets a whole group.

    `spread` is a hash; its pieces cut every group into parts of about `rows_in_task` rows at most. Rows are
    numbered within a part; the parts' sizes, summed up in order, give where each part starts.
    """
    parts = max(1, -(-n_rows // rows_in_task))
    with_part = df.withColumn("__part", F.pmod(spread, F.lit(parts)).cast("int"))
    sizes = with_part.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1) if group else Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    numbered = with_part.withColumn("__row", F.row_number().over(Window.partitionBy(*group, "__part").orderBy(*order)) - 1)
    keys = [*group, "__part"]
    starts = starts.select(*[F.col(k).alias(f"__s{k}") for k in keys], "__start")
    same = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__s{k}"))
        same = c if same is None else same & c
    return numbered.join(starts, same).withColumn(out, (F.col("__start") + F.col("__row")).cast("long")).drop("__part", "__row", "__start", *[f"__s{k}" for k in keys])


def unused_name(columns: list[str], name: str = "__none") -> str:
    """`name`, with as many more underscores as it takes to clash with no column."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def nullable(kind):
    """An Arrow type whose inner fields all allow nulls, as the types that Spark makes of DDL do."""
    import pyarrow as pa

    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, nullable(f.type)) for f in kind])
    if pa.types.is_map(kind):
        return pa.map_(nullable(kind.key_type), nullable(kind.item_type))
    if pa.types.is_list(kind):
        return pa.list_(pa.field("element", nullable(kind.value_type)))
    return kind
