"""MinHash near-dedup with tensored banding.

A table key needs `2 * half` minhashes. Two collections of `groups` half-keys each (of `half` minhashes) are
computed, and every pair of a half-key from each makes a table: groups^2 tables from 2 * groups * half
minhashes, where independent tables would take groups^2 * 2 * half.

Two sets of similarity s meet in a table with probability (1 - (1 - s^half)^groups)^2: with half = 2 and
groups = 10 that is 0.9999 at s = 0.8. Only half-keys that several sets have go into tables, so most sets send
2 * groups rows and none to tables.

Candidates are verified around hubs. The most central set of a bucket, the one that shares most buckets with most
sets, is the bucket's hub, and every other set of the bucket is compared with it in full. That gives each set X its
difference D(X) from the hub. Of two sets X and Y that both met the hub, |X ^ Y| = |D(X)| + |D(Y)| - 2 |D(X) & D(Y)|,
so whether they link is a question about their differences: if those are small the two link for certain, and otherwise
they must share a known number of elements, which a prefix join on the rarest elements of the differences finds
without loss. Pairs already connected aren't looked at, and where an element has a crowd of sets, these get a hub of
their own in place of a join with each other. A group of thousands of near copies thus takes a few comparisons a copy and hub.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import WordIds, checkpoint, mix, release_memory, remove_folder, scratch_folder, write_step
from brindle.llm.components import components

GROUPS, HALF = 10, 2
#: Rows of (id, hash) that are broadcast at most, so that texts needn't move; beyond it texts and rows meet in a shuffle.
MOST_BROADCAST = 2_000_000
#: Rounds of hubs within hubs, and steps in which labels are merged.
ROUNDS, LABEL_STEPS = 4, 3
#: Pairs a row that are few over all elements, and above which an element is a crowd. Elements that later ones rule out count too.
FEW, CROWD = 16, 16
BASE = 0x9E3779B97F4A7C15


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, one after another, and where each text's end.

    A text with fewer words than a shingle has its whole sequence as its one shingle; without words, none.
    """
    local = WordIds()
    words = [local.encode(t.lower().split()) if t else np.empty(0, np.int64) for t in texts]
    hashes = mix(local.hashes()) if local.ids else np.empty(0, np.uint64)
    base, sets = np.uint64(BASE), []
    for w in words:
        if not len(w):
            sets.append(np.empty(0, np.uint64))
            continue
        k = min(size, len(w))
        n = len(w) - k + 1
        h = hashes[w]
        key = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            key = key * base + h[j : j + n]
        sets.append(np.unique(mix(key)))
    ends = np.cumsum([len(s) for s in sets]) if sets else np.empty(0, np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), ends


def minhashes(x: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """n minhashes of each set, as (sets, n); only for sets that aren't empty (else the column is undefined)."""
    starts = np.concatenate([[0], ends[:-1]])
    full = starts < ends
    out = np.zeros((len(ends), n), dtype=np.uint64)
    if len(x):
        for t in range(n):
            seed = mix(np.array([t + 1], dtype=np.uint64))[0]
            h = (x ^ seed) * np.uint64(0xD6E8FEB86659FD93)
            out[full, t] = np.minimum.reduceat((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93), starts[full])
    return out


def set_ids(x: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set; none for empty sets."""
    import xxhash

    out, at = [], 0
    for e in ends:
        out.append(xxhash.xxh3_128_digest(x[at:e].tobytes()) if e > at else None)
        at = e
    return out


def half_keys(m: np.ndarray, half: int) -> np.ndarray:
    """Each run of `half` minhashes as one hash."""
    m = m.reshape(len(m), -1, half)
    key = np.zeros(m.shape[:2], dtype=np.uint64)
    for j in range(half):
        key = key * np.uint64(BASE) + m[:, :, j]
    return mix(key)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, groups: int, half: int) -> DataFrame:
    """id, same (hash of the text), n_shingles, set (128-bit name, null if empty), left and right half-keys of each row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, ends = shingle_sets(part.column(2).to_pylist(), shingle)
                sizes = np.diff(ends, prepend=0)
                keys = half_keys(minhashes(x, ends, 2 * groups * half), half).astype(np.int64)
                lists = [pa.array(list(k), pa.list_(pa.int64())) for k in (keys[:, :groups], keys[:, groups:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(set_ids(x, ends), pa.binary()), *lists], names=["id", "same", "n_shingles", "set", "left", "right"])
        release_memory()

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("same"), F.col(text_col).cast("binary").alias("text")).mapInArrow(sign, f"id {kind}, same bigint, n_shingles bigint, set binary, left array<bigint>, right array<bigint>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """cls, shingles of the classes in `wanted` (cls, id, same): read again from the text of one document each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, ends = shingle_sets(part.column(1).to_pylist(), shingle)
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else []
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], names=["cls", "shingles"])
        release_memory()

    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__same"), F.col(text_col).cast("binary").alias("__text"))
    # texts are hashed once a class, so the hash alone is the key; ids are no second key but say which of the copies is read
    chosen = F.coalesce(~(F.col("__id") < F.col("id")) & ~(F.col("__id") > F.col("id")), F.col("__id").isNull() & F.col("id").isNull())
    found = rows.join(small(wanted), (F.col("__same") == F.col("same")) & chosen)
    return found.select("cls", "__text").mapInArrow(build, "cls bigint, shingles binary").dropDuplicates(["cls"])


def small(rows: DataFrame) -> DataFrame:
    """Rows of two or three numbers, to be broadcast if a count shows that there are few enough; else as they are."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes with their sizes sa and sb, and the symmetric difference of their full sets: d elements, delta."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, deltas = [[], []], []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                sizes[0].append(len(p)), sizes[1].append(len(q))
                deltas.append(np.setxor1d(p, q, assume_unique=True).view(np.int64))
            columns = [*batch.columns[:2], *[pa.array(s, pa.int64()) for s in sizes], pa.array([len(x) for x in deltas], pa.int64()), pa.array(deltas, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "sa", "sb", "d", "delta"])
        release_memory()

    x = sets.select(F.col("cls").alias("ca"), F.col("shingles").alias("xa"))
    y = sets.select(F.col("cls").alias("cb"), F.col("shingles").alias("xb"))
    both = pairs.join(y, F.col("b") == F.col("cb")).select("a", "b", "xb").join(x, F.col("a") == F.col("ca")).select("a", "b", "xa", "xb")
    return both.mapInArrow(check, "a bigint, b bigint, sa bigint, sb bigint, d bigint, delta array<bigint>")


def bucket_members(classes: DataFrame, groups: int) -> DataFrame:
    """key, cls, n: every class in each of its buckets of n > 1 classes. classes: cls, left, right."""
    sides = F.array(*[F.struct(F.xxhash64(F.lit(i), F.col(side)[i]).alias("half"), F.lit(side == "left").alias("left")) for side in ("left", "right") for i in range(groups)])
    halves = classes.select("cls", F.explode(sides).alias("h")).select("cls", F.xxhash64("h.half", "h.left").alias("half"), "h.left")
    repeated = checkpoint(halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("half").alias("known")))
    own = halves.join(repeated, F.col("half") == F.col("known")).groupBy("cls").agg(F.collect_list(F.when(F.col("left"), F.col("half"))).alias("left"), F.collect_list(F.when(~F.col("left"), F.col("half"))).alias("right"))
    tables = checkpoint(own.select("cls", F.explode("left").alias("one"), "right").select("cls", "one", F.explode("right").alias("two")).select(F.xxhash64("one", "two").alias("key"), "cls"))
    buckets = checkpoint(tables.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "k"))
    return checkpoint(tables.join(buckets, F.col("key") == F.col("k")).select("key", "cls", "n"), sweep=True)


def hub_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each class b with the hubs a of its buckets. A hub is its bucket's class of the most company, over all of that class's buckets."""
    company = checkpoint(members.groupBy("cls").agg(F.sum("n").alias("met")).withColumnRenamed("cls", "of"))
    scored = members.join(company, F.col("cls") == F.col("of")).select("key", "cls", "met")
    hubs = checkpoint(scored.groupBy("key").agg(F.max(F.struct("met", "cls"))["cls"].alias("hub")).withColumnRenamed("key", "k"))
    return checkpoint(members.join(hubs, F.col("key") == F.col("k")).where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct())


def merged_labels(labels: DataFrame, links: DataFrame, kept) -> DataFrame:
    """labels (node, label) after `links` (a, b): nodes of one label are connected, and nearly all that are connected have one.

    Labels that meet go to the smallest of those they meet, twice followed. That is short of components where ways are long, which costs
    comparisons but no link.
    """
    for _ in range(LABEL_STEPS):
        x, y = (labels.select(F.col("node").alias(f"n{c}"), F.col("label").alias(c)) for c in "xy")
        met = links.join(x, F.col("a") == F.col("nx")).join(y, F.col("b") == F.col("ny")).where("x <> y").select("x", "y")
        both = met.union(met.select("y", "x"))
        least = kept(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("y")))
        if least.isEmpty():
            break
        for _ in range(2):
            on = least.select(F.col("x").alias("from"), F.col("y").alias("to"))
            least = least.join(on, F.col("y") == F.col("from"), "left").select("x", F.coalesce("to", "y").alias("y"))
        labels = kept(labels.join(kept(least), F.col("label") == F.col("x"), "left").select("node", F.coalesce("y", "label").alias("label")))
    return labels


def shared_prefixes(met: DataFrame, percent: int, kept) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links that are certain, (a, b); the sets around each hub that may have others; and which elements these must meet in, with `node`, the set
    whose label is theirs.

    With o(X) = (100 + p) |D(X)| - (100 - p) |X|, X and Y link for certain where o(X) + o(Y) <= 0. If X links so with any
    set of the hub, it does with that of the least o, so one link for each X says it all; where the hub's own o is the least, that
    link is known. Else they link only if they share t = (o(X) + o(Y)) / (2 (100 + p)) > 0 elements of their
    differences, rounded up. In any common order of elements the first shared one then lies among the first |D| - t + 1
    of both. Elements are ordered by how many differences of the hub have them, the rarest first; those that only one
    has come before all others and meet nothing, so only their number counts.
    """
    p, q = 100 + percent, 100 - percent
    outside = p * F.col("d") > q * (F.col("sa") + F.col("sb"))
    hubs = met.groupBy("a").agg(F.min(F.when(outside, F.col("o"))).alias("least"), F.max("sb").alias("longest"), F.count(F.lit(1)).alias("n"), F.min(F.struct("o", "b")).alias("best"))
    hubs = hubs.where("least is not null and n > 1").select(F.col("a").alias("hub"), "least", "longest", F.col("best.o").alias("lo"), F.col("best.b").alias("best"))
    hubs = kept(hubs)
    # the least that a class must share with any that it may link to; a set outside has a partner of a difference no smaller than that
    wider = F.least(F.col("longest"), F.floor(F.col("sb") * 100 / percent))
    t = F.greatest(F.lit(1), F.when(outside, F.ceil((F.col("o") - q * wider) / p)).otherwise(F.ceil((F.col("o") + F.col("least")) / (2 * p)))).cast("long")
    around = met.join(hubs, F.col("a") == F.col("hub"))
    around = kept(around.select("a", "b", "sa", F.col("sb").alias("size"), "d", "o", "delta", outside.alias("outside"), t.alias("t"), "lo", "best", F.when(outside, F.col("b")).otherwise(F.col("a")).alias("node")))
    certain = around.where((F.col("lo") < -q * F.col("sa")) & (F.col("b") != F.col("best")) & (F.col("o") + F.col("lo") <= 0)).select(F.col("best").alias("a"), "b")
    open_ = around.where("t <= d")
    parts = open_.select("a", "b", "size", "d", "o", "outside", "t", "node", F.explode("delta").alias("e"))
    shared = kept(parts.groupBy("a", "e").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("a").alias("ha"), F.col("e").alias("he"), "n"))
    common = parts.join(shared, (F.col("a") == F.col("ha")) & (F.col("e") == F.col("he"))).drop("ha", "he")
    one = Window.partitionBy("a", "b")
    at = F.col("d") - F.count(F.lit(1)).over(one) + F.row_number().over(one.orderBy("n", "e")) - 1
    return certain, open_, kept(common.withColumn("at", at).where("at <= d - t").select("a", "e", "b", "size", "d", "o", "outside", "at", "node"))


def links_around_hubs(met: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of two classes that both met a hub and of which one doesn't link with it, enough to connect all such.

    Sets that meet in an element (see `shared_prefixes`) and have different labels, so may not be connected yet, are pairs, which are checked in
    full if they are few. If not, the set of the least difference in a crowded element becomes a hub of the others: they are compared with
    it alone, and labels are merged. Only where an element is still crowded then, the next round looks at its sets' differences from
    that hub. So a crowd of copies of a variant gets one label at once. What is left after `ROUNDS` rounds is checked in full: no link is lost.
    """
    spark = met.sparkSession
    folder = scratch_folder(spark, "hubs")

    def kept(df: DataFrame) -> DataFrame:
        # plain tables: a checkpoint inherits the size estimates of its plan, which joins in rounds would square each time
        path = f"{folder}/{uuid.uuid4().hex}"
        write_step(df, path)
        return spark.read.schema(df.schema).parquet(path)

    p, q = 100 + percent, 100 - percent
    inside = p * F.col("d") <= q * (F.col("sa") + F.col("sb"))
    labels = kept(met.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("label")))
    labels = merged_labels(labels, met.where(inside).select("a", "b"), kept)
    found = []

    def labelled(prefix: DataFrame) -> DataFrame:
        return prefix.join(labels.select(F.col("node").alias("n"), "label"), F.col("node") == F.col("n")).drop("n", "node")

    def elements(prefix: DataFrame, all_: bool) -> DataFrame:
        """(ha, he, hub, pairs, crowded) of the elements of a hub whose sets have different labels."""
        alike = labelled(prefix).groupBy("a", "e", "label").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("o", "b")).alias("first"))
        apart = F.expr("(sum(n) * sum(n) - sum(n * n)) div 2").alias("pairs")
        out = alike.groupBy(F.col("a").alias("ha"), F.col("e").alias("he")).agg(F.sum("n").alias("n"), apart, F.min("first")["b"].alias("hub")).where("pairs > 0")
        out = kept(out.select("ha", "he", "hub", "pairs", (F.lit(not all_) & (F.col("pairs") > CROWD * F.col("n"))).alias("crowded")))
        few = all_ or (out.agg(F.sum("pairs")).first()[0] or 0) <= FEW * prefix.count()
        return out.withColumn("crowded", F.lit(False)) if few else out

    def in_full(pairs: DataFrame, open_: DataFrame) -> DataFrame:
        """(a, b, sa, sb, delta, d) of pairs (a, b, b2) around a hub a, by their differences from it."""
        first = open_.select(F.col("a").alias("h1"), F.col("b").alias("x"), F.col("size").alias("sa"), F.col("delta").alias("dx"))
        second = open_.select(F.col("a").alias("h2"), F.col("b").alias("y"), F.col("size").alias("sb"), F.col("delta").alias("dy"))
        both = pairs.join(first, (F.col("a") == F.col("h1")) & (F.col("b") == F.col("x"))).join(second, (F.col("a") == F.col("h2")) & (F.col("b2") == F.col("y")))
        differ = F.array_union(F.array_except("dx", "dy"), F.array_except("dy", "dx"))
        return both.select(F.col("x").alias("a"), F.col("y").alias("b"), "sa", "sb", differ.alias("delta")).withColumn("d", F.size("delta").cast("long"))

    for left in range(ROUNDS, -1, -1):
        certain, open_, prefix = shared_prefixes(met, percent, kept)
        found.append(kept(certain))
        if prefix.isEmpty():
            break
        labels = merged_labels(labels, found[-1], kept)
        at = (F.col("a") == F.col("ha")) & (F.col("e") == F.col("he"))
        told = elements(prefix, left == 0)
        asked = near_hubs = None
        if not told.where("crowded").isEmpty():
            asked = kept(prefix.join(told.where("crowded"), at).where("b <> hub").select("a", "e", "hub", "b"))
            near_hubs = kept(in_full(asked.select("a", F.col("hub").alias("b"), F.col("b").alias("b2")).distinct(), open_).dropDuplicates(["a", "b"]))
            found.append(kept(near_hubs.where(inside).select("a", "b")))
            labels = merged_labels(labels, found[-1], kept)
            told = elements(prefix, False)
        x = kept(labelled(prefix).join(told.where("not crowded"), at).drop("ha", "he", "hub", "pairs", "crowded"))
        y = x.select(*[F.col(n).alias(f"{n}2") for n in x.columns])
        both = F.col("o") + F.col("o2")
        once = ~F.col("outside2") | (F.col("b") < F.col("b2"))
        fits = 100 * F.least("size", "size2") >= percent * F.greatest("size", "size2")
        near = (F.col("at") + F.ceil(both / (2 * p)) <= F.col("d")) & (F.col("at2") + F.ceil(both / (2 * p)) <= F.col("d2"))
        meet = (F.col("a") == F.col("a2")) & (F.col("e") == F.col("e2")) & (F.col("label") != F.col("label2")) & (both > 0) & once & fits & near
        pairs = kept(x.where("outside").join(y, meet).select("a", "b", "b2").distinct())
        found.append(kept(in_full(pairs, open_).where(inside).select("a", "b")))
        if near_hubs is None:
            break
        still = asked.join(told.where("crowded").select("ha", "he"), at, "left_semi").select(F.col("hub").alias("h"), F.col("b").alias("s")).distinct()
        met = kept(near_hubs.join(still, (F.col("a") == F.col("h")) & (F.col("b") == F.col("s")), "left_semi").withColumn("o", p * F.col("d") - q * F.col("sb")))
        if met.isEmpty():
            break
        labels = merged_labels(labels, found[-1], kept)
    out = checkpoint(reduce(DataFrame.union, found).distinct(), sweep=True)
    remove_folder(spark, folder)
    return out


def grouped_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2, percent: int = 80, groups: int = GROUPS, half: int = HALF) -> DataFrame:
    """One row per input row: id, same (hash of the text), n_shingles, group (null for empty sets), component_id.

    Rows with equal sets are one class, linked by definition. Classes that meet in a table are candidates, and every
    candidate pair is one with its hub, compared in full, or proved to link or not to link, or compared, by its differences from the hub. `percent` is from 1 to 100.
    """
    signed = checkpoint(signatures(docs, id_col, text_col, shingle, groups, half))
    one = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "same"))
    classes = signed.where("set is not null").groupBy("set").agg(one.alias("one"), F.first("left").alias("left"), F.first("right").alias("right"))
    classes = checkpoint(classes.select("set", F.monotonically_increasing_id().alias("cls"), "one.id", "one.same", "left", "right"))
    pairs = hub_pairs(bucket_members(classes.select("cls", "left", "right"), groups))
    nodes = checkpoint(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    wanted = checkpoint(classes.join(nodes, F.col("cls") == F.col("node"), "left_semi").select("cls", "id", "same"))
    sets = checkpoint(full_sets(docs, id_col, text_col, shingle, wanted))
    met = compared(pairs, sets).withColumn("o", (100 + percent) * F.col("d") - (100 - percent) * F.col("sb"))
    met = checkpoint(met, sweep=True)
    linked = met.where((100 + percent) * F.col("d") <= (100 - percent) * (F.col("sa") + F.col("sb"))).select("a", "b")
    found = components(linked.union(links_around_hubs(met, percent)), "a", "b")
    named = checkpoint(wanted.select("cls", "id").join(found, F.col("cls") == F.col("node")).select("cls", "id", F.col("component").alias("group")), sweep=True)
    smallest = checkpoint(named.groupBy("group").agg(F.min("id").alias("component_id")).withColumnRenamed("group", "g"))
    grouped = checkpoint(named.join(smallest, F.col("group") == F.col("g")).select(F.col("cls").alias("c"), "group", "component_id"))
    of_set = classes.join(grouped, F.col("cls") == F.col("c"), "left").select(F.col("set").alias("of"), F.coalesce("group", "cls").alias("group"), F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    out = signed.select("id", "same", "n_shingles", "set").join(of_set, F.col("set") == F.col("of"), "left")
    return out.select("id", "same", "n_shingles", "group", F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable over links), kept.

    Null, empty and word-less texts have n_shingles 0 and link with nothing. Null ids come after all others: the
    component_id of a group with any id isn't null. Equal rows share a component and are kept alike. An empty
    table gives no rows; columns that aren't named are ignored. Texts are read whole, whatever their length.
    """
    rows = grouped_rows(docs, id_col, text_col, **options)
    return rows.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with their columns, of which one row of each group of near copies stays: that of the smallest id
    (and, among rows alike in id, the smallest text hash; of rows alike in both, one). Documents without words all stay, null and
    empty texts among them. Null ids come after all others. An empty table gives no rows. Columns may have any names.

    Most documents have no copy, so only the texts of groups of several rows are looked up: by a broadcast of their
    hashes where a count shows these to be few, else in a join.
    """
    rows = checkpoint(grouped_rows(docs, id_col, text_col, **options).where("group is not null").select("id", "same", "group"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "same"))
    # of a group with several rows, that row stays that has this id and text hash; of n rows alike in both, one
    keys = checkpoint(rows.groupBy("group", "id", "same").agg(F.count(F.lit(1)).alias("n")))
    several = keys.groupBy("group").agg(first.alias("one"), F.sum("n").alias("m")).where("m > 1")
    several = checkpoint(several.select(F.col("group").alias("g"), F.col("one.id").alias("i"), F.col("one.same").alias("s")))
    unique = keys.where("n > 1").join(several, F.col("group") == F.col("g")).where((F.col("same") == F.col("s")) & F.col("id").eqNullSafe(F.col("i"))).isEmpty()
    texts = rows.groupBy("group", "same").agg(F.lit(1)).select("group", F.col("same").alias("t"))
    texts = checkpoint(texts.join(several, F.col("group") == F.col("g")).select("t", "i", "s"), sweep=True)
    own = docs.columns
    whole = docs.select(F.struct(*[F.col(c) for c in own]).alias("own"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("same"))
    told = whole.join(small(texts), F.col("same") == F.col("t"), "left").withColumn("stays", F.when(F.col("t").isNotNull(), (F.col("same") == F.col("s")) & F.col("id").eqNullSafe(F.col("i"))))
    if unique:
        kept = told.where("stays is null or stays").select("own")
    else:
        kept = told.where("stays is null").select("own").unionByName(told.where("stays").dropDuplicates(["id", "same"]).select("own"))
    return kept.select(*[F.col("own").getField(c).alias(c) for c in own])
