"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells, one vector of a group kept.

A vector lives in the cell of its nearest centre (its home) and visits the cells whose boundary it is close to.
A pair is compared where one of the two is at home and the other lives or visits. Two unit vectors of cosine
`least` are `d = sqrt(2 - 2 * least)` apart, and their difference moves a boundary distance by d * z * s, z being about normal and
s the share of a difference that falls on one direction. Differences of near vectors are taken to spread as vectors do
around their centres: s is measured there, in the direction in which these spread most (1 / sqrt(dim) if they spread evenly, 1 / sqrt(8) in a
subspace of 8 dimensions); vectors visit up to z = 3. Recall against brute force is measured in the tests. Cells are compared in blocks of at most 2,048 by 2,048 vectors on average, each block
pair a group of its own, so a cell with a third of all vectors is spread over tasks. A block pair gives counts and
a spanning forest of its links, never its pairs. Equal vectors are one vector with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import checkpoint
from brindle.llm.components import components

#: Vectors of a cell on average; most cells (the centres are sent to every task: at most 4096 x dim doubles);
#: vectors that k-means is fitted on, for each centre; block edge; z of the boundary margin.
CELL_ROWS, MOST_CELLS, SAMPLE_ROWS, BLOCK, MARGIN = 256, 4096, 32, 2048, 3.0
#: Bytes that the sample for k-means has at most, as doubles on the driver.
SAMPLE_BYTES = 128 << 20


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, steps: int = 8, seed: int = 1) -> np.ndarray:
    """k unit centres of unit vectors; a centre without vectors stays where it is."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(steps):
        home = np.concatenate([(x[i : i + 8192] @ centres.T).argmax(axis=1) for i in range(0, len(x), 8192)])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norm = np.linalg.norm(sums, axis=1)
        ok = norm > 1e-12
        centres[ok] = sums[ok] / norm[ok, None]
    return centres


def widest_spread(x: np.ndarray, centres: np.ndarray) -> float:
    """Of what vectors differ from their centres, the root of the share along the direction that has most of it: 1 / sqrt(dim) to 1."""
    home = np.concatenate([(x[i : i + 8192] @ centres.T).argmax(axis=1) for i in range(0, len(x), 8192)])
    off = x - centres[home]
    scatter = off.T @ off
    whole = np.trace(scatter)
    return float(np.sqrt(np.linalg.eigvalsh(scatter)[-1] / whole)) if whole > 1e-12 * len(x) else 1.0


def visits(x: np.ndarray, centres: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cells, and which cells each vector lives in or visits: those whose bisector with home is within `margin`."""
    sim = x @ centres.T
    home = sim.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 1e-12))
    gap = sim[np.arange(len(x)), home][:, None] - sim
    inside = gap <= margin * apart[home]
    inside[np.arange(len(x)), home] = True
    return home, inside


def compare(ids, x, weight, homes, cells_of, at_home, cell, least) -> tuple[list, list, list, list]:
    """Partial link counts and forest of one block pair.

    A home vector counts every vector linked to it here. A visitor counts a home vector only if that one doesn't
    come to the visitor's own home, where the pair would be counted.
    """
    h, v = np.flatnonzero(at_home), np.flatnonzero(~at_home)
    if not len(h) or not len(v):
        return [], [], [], []
    linked = x[h] @ x[v].T >= least
    linked &= ids[h][:, None] != ids[v][None, :]
    if not linked.any():
        return [], [], [], []
    of_home = linked @ weight[v]
    known, place = np.unique(homes[v], return_inverse=True)
    comes = np.zeros((len(h), len(known)), dtype=bool)
    for i, cells in enumerate(cells_of[h]):
        comes[i] = np.isin(known, cells)
    of_visitor = weight[h] @ (linked & ~comes[:, place])
    # components of this block pair: the smallest index travels along links until nothing changes
    rows, cols = linked.any(axis=1), linked.any(axis=0)
    part, hh, vv = linked[np.ix_(rows, cols)], ids[h[rows]], ids[v[cols]]
    lab_h, big = hh.copy(), np.iinfo(np.int64).max
    while True:
        lab_v = np.minimum(np.where(part, lab_h[:, None], big).min(axis=0), vv)
        new = np.minimum(lab_h, np.where(part, lab_v[None, :], big).min(axis=1))
        if (new == lab_h).all():
            break
        lab_h = new
    who = np.concatenate([ids[h], ids[v]])
    count = np.concatenate([of_home, of_visitor])
    node, root = np.concatenate([hh, vv]), np.concatenate([lab_h, lab_v])
    some, off = count > 0, node != root
    return list(who[some]), list(count[some]), list(node[off]), list(root[off])


def _links_of_size(vectors: DataFrame, size: int, least: float) -> DataFrame:
    """(kind, a, b): kind 0 gives vector a's partial count b, kind 1 a link from a to b. vectors: id, x, weight."""
    n = vectors.count()
    k = int(min(MOST_CELLS, max(1, n // CELL_ROWS)))
    wanted = max(1, min(n, SAMPLE_ROWS * k, SAMPLE_BYTES // (8 * size)))
    # by a hash, so that reruns take the same rows; the share keeps the sort to about as many rows as are wanted
    hash_ = F.xxhash64("x")
    share = F.pmod(hash_, F.lit(1 << 20)) <= F.lit(int((1 << 20) * min(1.0, 1.2 * wanted / max(n, 1) + 0.001)) + 1)
    drawn = vectors.where(share).orderBy(hash_, "x").limit(wanted).select(F.col("x").cast("array<double>").alias("x")).toArrow().column("x").combine_chunks()
    sample = unit(drawn.flatten().to_numpy().reshape(-1, size)) if len(drawn) else np.zeros((0, size))
    centres = spherical_kmeans(sample, k) if len(sample) else np.zeros((1, size))
    margin = np.sqrt(2 - 2 * least) * min(1.0, MARGIN * (widest_spread(sample, centres) if len(sample) else 1.0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = unit(np.stack([np.asarray(v.values, dtype=float) for v in part.column(1)]))
                home, inside = visits(x, centres, margin)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v.tobytes() for v in x], pa.binary()), part.column(2), pa.array(home, pa.int32()), pa.array([np.flatnonzero(i).astype(np.int32) for i in inside], pa.list_(pa.int32()))], names=["id", "u", "weight", "home", "cells"])

    placed = checkpoint(vectors.select("id", "x", "weight").mapInArrow(assign, "id bigint, u binary, weight bigint, home int, cells array<int>"))
    live = placed.groupBy("home").agg(F.count(F.lit(1)).alias("n")).select(F.col("home").alias("cell"), "n", F.lit(0).alias("come"))
    come = placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("come")).select("cell", F.lit(0).alias("n"), "come")
    # one row a cell, so at most MOST_CELLS rows
    blocks = live.unionByName(come).groupBy("cell").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("hb"), F.ceil(F.sum("come") / BLOCK).cast("int").alias("vb")).where("hb > 0")
    hash_ = F.xxhash64("id")
    homes = placed.withColumn("cell", F.col("home")).join(F.broadcast(blocks), "cell").withColumns({"i": F.pmod(hash_, F.col("hb")).cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("vb") - 1)), "at_home": F.lit(True)})
    guests = placed.withColumn("cell", F.explode("cells")).join(F.broadcast(blocks), "cell").withColumns({"j": F.pmod(hash_, F.col("vb")).cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("hb") - 1)), "at_home": F.lit(False)})
    columns = ["cell", "i", "j", "at_home", "id", "u", "weight", "home", F.when(F.col("at_home"), F.col("cells")).alias("cells")]

    def products(key, table):
        x = np.frombuffer(b"".join(table.column("u").to_pylist()), dtype=float).reshape(table.num_rows, -1)
        cells = np.empty(table.num_rows, dtype=object)
        cells[:] = table.column("cells").to_pylist()
        get = lambda c: np.asarray(table.column(c).to_numpy(zero_copy_only=False))
        who, count, node, root = compare(get("id"), x, get("weight"), get("home"), cells, get("at_home").astype(bool), key[0].as_py(), least)
        return pa.table([pa.array([0] * len(who) + [1] * len(node), pa.int32()), pa.array(who + node, pa.int64()), pa.array(count + root, pa.int64())], names=["kind", "a", "b"])

    return homes.select(*columns).unionByName(guests.select(*columns)).groupBy("cell", "i", "j").applyInArrow(products, "kind int, a bigint, b bigint")


def embedding_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95) -> DataFrame:
    """One row per input row: id, n_links, component_id (smallest id reachable), kept.

    Vectors that are null, empty, zero or hold null or non-finite components have n_links 0 and are a group of
    their own, as are rows without an id. Vectors of different lengths never link. Equal rows are rows of their own that link with each other.
    An empty table gives no rows. Columns that aren't named are ignored. k-means is fitted on at most 32 vectors a
    centre, 4,096 centres and 128 MB; all vectors are placed and compared.
    """
    x = F.col(vector_col)
    fine = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0) & F.col(id_col).isNotNull(), F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.when(fine, x).alias("x"))
    # a vector has a number of its own: ids may stand for several vectors
    vectors = rows.where("x is not null").groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    vectors = checkpoint(vectors.withColumn("v", F.monotonically_increasing_id()))
    sizes = [r[0] for r in vectors.select(F.size("x")).distinct().collect()]
    found = None
    for size in sorted(sizes):
        part = _links_of_size(vectors.where(F.size("x") == size).select(F.col("v").alias("id"), "x", "weight"), size, least)
        found = part if found is None else found.unionByName(part)
    if found is None:
        nothing = rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
        return nothing
    found = checkpoint(found)
    counts = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("links"))
    groups = components(found.where("kind = 1"), "a", "b")
    info = vectors.join(counts, F.col("v") == F.col("a"), "left").join(groups, F.col("v") == F.col("node"), "left")
    info = checkpoint(info.select("x", "id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "v").alias("group")))
    smallest = checkpoint(info.groupBy("group").agg(F.min("id").alias("component")).withColumnRenamed("group", "g"))
    info = info.join(smallest, F.col("group") == F.col("g")).select(F.col("x").alias("vx"), "links", "component")
    out = rows.join(info, F.col("x") == F.col("vx"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
