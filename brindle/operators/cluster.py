"""Pairwise distances, complete linkage, flat cuts, elbow and classical scaling.

The merge tree needs all n^2 distances, as in any complete linkage. Up to `IN_TASK` items are one group; more are merged in rounds over blocks of
them, each of n^2 work, in which no distance is kept (see `linkage`). Distances alone are distributed, block by block, and so is all that follows a
tree (see tree.py).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators import clean
from brindle.operators import tree as trees
from brindle.operators.persist import Rounds, fixed

#: Features of a dense matrix, rows of a block.
MOST_ITEMS, BLOCK = 12_000, 512
#: Clusters that one task merges, and rows of a block in the rounds before that.
IN_TASK, ROUND_BLOCK = 8_000, 4_096
#: Neighbours of a cluster's list, rows of a block that looks for them at most, clusters of a group that merges by lists, products made at once there.
NEAR, NEAR_BLOCK, GROUP, PAIRS = 32, 32_768, 131_072, 1 << 18
#: A group stops when a step merges less than one of so many clusters; a round by lists that merges less than one of so many is one of all pairs.
STEPS, SLOW = 500, 50
#: Rows of a block where all pairs are the result, and rows whose distances to a block are made at once.
PAIR_BLOCK, SLICE = 16_384, 128
TREE = "merge_step bigint, left_id bigint, right_id bigint, merge_distance double, size bigint"


def weighted_clusters(features: DataFrame, weights: dict[str, float], k: int = 8) -> DataFrame:
    """(id, cluster): Euclidean complete linkage of long features (id, feature, value) times their weights, cut at k. Features of
    weight 0 and those without a weight are left out, weights of absent features have no effect; ids are 0..n-1."""
    used = {f: float(w) for f, w in weights.items() if w}
    if not used:
        raise ValueError("no feature has a weight")
    weight = F.create_map(*[F.lit(x) for pair in used.items() for x in pair])
    kept = features.where(F.col("feature").isin(*used)).select("id", "feature", (F.col("value") * F.element_at(weight, F.col("feature"))).alias("value"))
    # items without any used feature are at the origin
    absent = features.select("id").distinct().select("id", F.lit(sorted(used)[0]).alias("feature"), F.lit(0.0).alias("value"))
    return clusters(keep_tree(linkage(dense_matrix(kept.unionByName(absent)), "euclidean")), k)


def dense_matrix(features: DataFrame) -> DataFrame:
    """(id, vector): every feature's value in the features' order, 0 where absent."""
    names = features.select("feature").distinct().orderBy("feature").limit(MOST_ITEMS + 1).collect()
    if len(names) > MOST_ITEMS:
        raise ValueError(f"more than {MOST_ITEMS} features")
    if not names:
        raise ValueError("no features")
    order = F.create_map(*[F.lit(x) for i, r in enumerate(names) for x in (r[0], i)])
    cells = features.groupBy("id", F.element_at(order, F.col("feature")).alias("at")).agg(F.sum("value").alias("value"))
    by_place = cells.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("at", "value"))).alias("m"))
    return by_place.select("id", F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("vector"))


def distances(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        if (nx == 0).any() or (ny == 0).any():
            raise ValueError("cosine distance of a zero vector")
        out = 1 - (x / nx[:, None]) @ (y / ny[:, None]).T
    elif metric == "euclidean":
        out = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0))
    else:
        raise ValueError(f"unknown metric {metric!r}")
    if not np.isfinite(out).all():
        raise ValueError("a distance isn't finite")
    return np.maximum(out, 0)


def sparse_rows(features: DataFrame) -> DataFrame:
    """(id, features, values) of long features (id, feature, value): a row's features in order with their sums, and nothing where they are 0.
    As large as there are values, whatever the number of features."""
    cells = features.groupBy("id", "feature").agg(F.sum("value").alias("value")).where("value <> 0")
    pairs = F.array_sort(F.collect_list(F.struct("feature", "value")))
    return cells.groupBy("id").agg(pairs.alias("p")).select("id", F.col("p.feature").alias("features"), F.col("p.value").alias("values"))


def vector_columns(rows: DataFrame) -> list[str]:
    """The columns that hold a row's vector: dense, or sparse as of `sparse_rows`."""
    return ["vector"] if "vector" in rows.columns else ["features", "values"]


def vectors_of(rows: DataFrame) -> list:
    return [F.col("vector").cast("array<double>").alias("vector")] if "vector" in rows.columns else [F.transform("features", lambda f: f).alias("features"), F.col("values").cast("array<double>").alias("values")]


class Sparse:
    """Sparse rows of one block: entries sorted by feature, so that two blocks meet feature by feature."""

    def __init__(self, features: list[list[str]], values: list[list[float]]):
        names = [f for own in features for f in own]
        self.n = len(features)
        self.row = np.repeat(np.arange(self.n), [len(own) for own in features])
        self.value = np.array([v for own in values for v in own], dtype=float)
        self.names, of = np.unique(np.array(names, dtype=object), return_inverse=True) if names else (np.array([], dtype=object), np.array([], dtype=int))
        order = np.argsort(of, kind="stable")
        self.row, self.value = self.row[order], self.value[order]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(self.names)))]).astype(int)

    def squares(self) -> np.ndarray:
        return np.bincount(self.row, self.value * self.value, minlength=self.n)

    def product(self, other: "Sparse") -> np.ndarray:
        """All rows' products with all of the other's: of each feature that both have, the outer product of its values. A hot feature is
        split as its rows are, over blocks."""
        out = np.zeros((self.n, other.n))
        _, here, there = np.intersect1d(self.names, other.names, assume_unique=True, return_indices=True)
        for a, b in zip(here, there):
            p, q = slice(self.ends[a], self.ends[a + 1]), slice(other.ends[b], other.ends[b + 1])
            out[np.ix_(self.row[p], other.row[q])] += np.outer(self.value[p], other.value[q])
        return out


def matrix_of(table: pa.Table, where: np.ndarray):
    """The vectors of some rows of a table: an array, or sparse."""
    own = table.take(pa.array(where))
    if "vector" in table.column_names:
        return np.array(own.column("vector").to_pylist(), dtype=float)
    return Sparse(own.column("features").to_pylist(), own.column("values").to_pylist())


def block_distances(x, y, metric: str) -> np.ndarray:
    """Distances of all rows of x and y, which are both arrays or both sparse."""
    if not isinstance(x, Sparse):
        return distances(x, y, metric)
    dots, sx, sy = x.product(y), x.squares(), y.squares()
    if metric == "cosine":
        if (sx == 0).any() or (sy == 0).any():
            raise ValueError("cosine distance of a zero vector")
        out = 1 - dots / np.sqrt(sx[:, None] * sy[None, :])
    elif metric == "euclidean":
        out = np.sqrt(np.maximum(sx[:, None] + sy[None, :] - 2 * dots, 0))
    else:
        raise ValueError(f"unknown metric {metric!r}")
    if not np.isfinite(out).all():
        raise ValueError("a distance isn't finite")
    return np.maximum(out, 0)


def pair_blocks(n: int) -> int:
    """How many blocks n rows are cut into where all pairs meet: a row is sent once for each, so there are as few as leave work for all tasks, and
    no block has much more than `PAIR_BLOCK` rows."""
    return max(1, -(-n // PAIR_BLOCK), min(8, -(-n // BLOCK)))


def pair_distances(rows: DataFrame, metric: str = "cosine") -> DataFrame:
    """(i, j, distance) of all pairs i < j of rows (id, vector) or (id, features, values): blocks of ids meet block by block, as matrix products.
    A task holds two blocks of rows and the distances of a slice."""
    blocks = pair_blocks(rows.count())
    placed = rows.select("id", *vector_columns(rows), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("b"))
    both = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(F.least("b", o).alias("p"), F.greatest("b", o).alias("q")))
    dealt = placed.select("*", F.explode(both).alias("pair")).select("id", *vector_columns(rows), "b", "pair.p", "pair.q")

    def products(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        p, q = key[0].as_py(), key[1].as_py()
        ids, b = np.asarray(table.column("id").to_numpy()), np.asarray(table.column("b").to_numpy())
        left, right = np.flatnonzero(b == p), np.flatnonzero(b == q)
        if not len(left) or not len(right):
            return
        others = matrix_of(table, right)
        for k in range(0, len(left), SLICE):
            own = left[k : k + SLICE]
            d = block_distances(matrix_of(table, own), others, metric)
            a, c = np.meshgrid(ids[own], ids[right], indexing="ij")
            keep = (a < c) if p == q else (a != c)
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.minimum(a, c)[keep]), "j": pa.array(np.maximum(a, c)[keep]), "distance": pa.array(d[keep])})

    return dealt.groupBy("p", "q").applyInArrow(products, "i bigint, j bigint, distance double")


def meeting_ranges(targets: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of `nearest_in_ranges` with the block of others and the chunk of that block's targets that they meet in. A target has a row for each block that
    its range reaches; another has one for each chunk of targets that reach its block, so rows follow the pairs in range and not all pairs."""
    reached = F.explode(F.sequence(F.floor(F.col("lo") / BLOCK), F.floor((F.col("hi") - 1) / BLOCK))).alias("block")
    inside = targets.where("hi > lo")
    chunks = inside.select(reached).groupBy(F.col("block").alias("__b")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    left = inside.select("id", *vectors_of(targets), "lo", "hi", reached).join(chunks, F.col("block") == F.col("__b"))
    left = left.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).drop("__b", "chunks")
    right = others.select("id", *vectors_of(others), "rank", F.floor(F.col("rank") / BLOCK).alias("block")).join(chunks, F.col("block") == F.col("__b"))
    return left, right.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("__b", "chunks")


def nearest_in_ranges(targets: DataFrame, others: DataFrame, limit: int | None, metric: str = "cosine") -> DataFrame:
    """(target_id, like_id, distance): of each target's range of the others, all or the `limit` nearest of each block of them.

    targets: id, lo, hi and the vector; others: id, rank and the vector; a target's others have ranks lo to hi - 1. Blocks of targets meet the
    blocks of others that their ranges reach, as matrix products, so at most `limit` rows a target and block are sent on. Distances that agree to
    nine digits are ties, which go by id.
    """
    left, right = meeting_ranges(targets, others)

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        found = ([], [], [])
        if a.num_rows and b.num_rows:
            d = block_distances(matrix_of(a, np.arange(a.num_rows)), matrix_of(b, np.arange(b.num_rows)), metric)
            ids, rank, near = b.column("id").to_numpy(), b.column("rank").to_numpy(), np.round(d, 9)
            for i, (target, lo, hi) in enumerate(zip(a.column("id").to_pylist(), a.column("lo").to_pylist(), a.column("hi").to_pylist())):
                inside = np.flatnonzero((rank >= lo) & (rank < hi))
                best = inside[np.lexsort((ids[inside], near[i, inside]))][:limit]
                for out, values in zip(found, (np.full(len(best), target), ids[best], d[i, best])):
                    out.append(values)
        columns = [np.concatenate(x) if x else np.array([]) for x in found]
        return pa.table({"target_id": pa.array(columns[0].astype(np.int64)), "like_id": pa.array(columns[1].astype(np.int64)), "distance": pa.array(columns[2].astype(float))})

    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(nearest, "target_id bigint, like_id bigint, distance double")


class Half:
    """The distances of n items, each pair once: 4 n^2 bytes. Rows are given and taken whole, infinite to the item itself."""

    def __init__(self, n: int):
        self.n, self.data = n, np.full(n * (n - 1) // 2, np.inf)
        self.first = np.arange(n) * (2 * n - np.arange(n) - 1) // 2 - np.arange(n) - 1  # a pair a < b is at first[a] + b

    def __len__(self) -> int:
        return self.n

    def row(self, a: int) -> np.ndarray:
        return np.concatenate([self.data[self.first[:a] + a], [np.inf], self.data[self.first[a] + a + 1 : self.first[a] + self.n]])

    def put(self, a: int, values: np.ndarray) -> None:
        self.data[self.first[:a] + a] = values[:a]
        self.data[self.first[a] + a + 1 : self.first[a] + self.n] = values[a + 1 :]

    def put_pairs(self, a: int, others: np.ndarray, values: np.ndarray) -> None:
        keep = others != a
        others, values = others[keep], values[keep]
        self.data[self.first[np.minimum(a, others)] + np.maximum(a, others)] = values

    @classmethod
    def of(cls, d: np.ndarray) -> "Half":
        out = cls(len(d))
        for a in range(len(d)):
            out.data[out.first[a] + a + 1 : out.first[a] + len(d)] = d[a, a + 1 :]
        return out


def nearest_neighbour_chain(d: "np.ndarray | Half") -> np.ndarray:
    """Merges (left, right, height, size) of complete linkage, heights ascending, clusters numbered from n on.

    Follows nearest neighbours until two clusters are each other's nearest, merges them, and goes on; equal distances
    go to the smallest index. Quadratic time; works in the half matrix itself, which is used up.
    """
    n, d = len(d), d if isinstance(d, Half) else Half.of(d)
    alive, chain, merges = np.ones(n, dtype=bool), [], []
    while alive.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            a = chain[-1]
            far = d.row(a)
            b = int(np.argmin(far))
            if len(chain) > 1 and far[chain[-2]] <= far[b]:
                b = chain[-2]
                break
            chain.append(b)
        chain.pop(), chain.pop()
        a, b = min(a, b), max(a, b)
        one, two = d.row(a), d.row(b)
        merges.append((a, b, one[b]))
        d.put(a, np.maximum(one, two))
        d.put(b, np.full(n, np.inf))
        alive[b] = False
    merges.sort(key=lambda m: m[2])
    name, size, root = list(range(n)), [1] * n, list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for step, (a, b, height) in enumerate(merges):
        x, y = find(a), find(b)
        left, right = sorted((name[x], name[y]))
        root[y] = x
        size[x] += size[y]
        name[x] = n + step
        out.append((left, right, height, size[x]))
    return np.array(out, dtype=float).reshape(-1, 4)


def linkage(rows: DataFrame, metric: str = "cosine", most: int | None = None, in_task: int = IN_TASK) -> DataFrame:
    """(merge_step, left_id, right_id, merge_distance, size) over rows (id, vector), ids being 0..n-1 (see dense_ids).

    Up to `in_task` items are one group. More are merged in rounds: blocks of clusters meet as matrix products, each cluster gets its nearest
    one, and all pairs that are each other's nearest merge, as complete linkage would do sooner or later; what is left at `in_task` clusters
    is one group. A task holds two blocks, or the last group's distances; no distance is written until then. Equal distances go by a hash of
    the pair there, so trees of rows with ties may differ from a single group's, in which they go to the smallest index. `most` makes more
    items an error.
    """
    n = rows.count()
    if most is not None and n > most:
        raise ValueError(f"complete linkage needs all pairs; more than {most} items")
    rows = rows.select("id", F.col("vector").cast("array<double>").alias("vector"))
    if n > in_task:
        return merged_in_rounds(rows, n, metric, in_task)

    def merge(table):
        order = np.argsort(table.column("id").to_numpy())
        x = vectors_in(table)[order]
        d = Half(len(x))
        for i in range(0, len(x), BLOCK):
            for a, far in enumerate(distances(x[i : i + BLOCK], x[i:], metric), i):
                d.data[d.first[a] + a + 1 : d.first[a] + len(x)] = far[a - i + 1 :]
        m = nearest_neighbour_chain(d) if len(x) > 1 else np.empty((0, 4))
        return pa.table({"merge_step": pa.array(np.arange(len(m))), "left_id": pa.array(m[:, 0].astype(np.int64)), "right_id": pa.array(m[:, 1].astype(np.int64)), "merge_distance": pa.array(m[:, 2]), "size": pa.array(m[:, 3].astype(np.int64))})

    return rows.withColumn("g", F.lit(0)).groupBy("g").applyInArrow(lambda t: merge(t), TREE)


def vectors_in(table: pa.Table) -> np.ndarray:
    """The column `vector` as an array, without a Python object for each number."""
    column = table.column("vector").combine_chunks()
    if column.null_count or len(pc.unique(pc.list_value_length(column))) > 1:
        raise ValueError("a vector is null or not as long as the others")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def merged_in_rounds(rows: DataFrame, n: int, metric: str, in_task: int) -> DataFrame:
    """The merge tree of more items than one task takes (see `linkage`).

    Clusters are named by their smallest member. Merges (left, right, height) of named clusters, left staying the name, are numbered at the end,
    by height, then by the round that they were found in; a height is never below those of its parts.
    """
    state = Rounds(rows.sparkSession)
    # equal rows merge at distance 0 first, each into the smallest, so that the rounds don't take them up pair by pair
    alike = Window.partitionBy("vector")
    numbered = fixed(rows.select("id", "vector", F.min("id").over(alike).alias("name"), F.count(F.lit(1)).over(alike).alias("weight"), (F.row_number().over(alike.orderBy("id")) - 2).cast("long").alias("at")))
    found = [numbered.where("at >= 0").select(F.col("name").alias("left"), F.col("id").alias("right"), F.lit(0.0).alias("height"), (F.col("at") + 2).alias("size"), F.lit(0).alias("round"), "at")]
    now = state.keep(numbered.where("at < 0").select(F.col("name").alias("cluster"), F.lit(0.0).alias("height"), "weight", "vector"))
    left, at = now.count(), 0
    while left > in_task:
        at += 1
        placed = fixed(in_blocks(now, round_block(now.count())))
        got = fixed(certain_merges(placed, near_lists(placed, metric), left, metric, at))
        made, renamed = got.where("at >= 0"), got.where("at < 0").select(F.col("left").alias("__into"), F.col("height").alias("__height"), F.col("right").alias("cluster"))
        count = made.count()
        if count * SLOW < left:
            # crowds of equal distances, or neighbours in other groups: all pairs that are each other's nearest, by a hash where distances are equal
            made = fixed(mutual_merges(placed, metric, at))
            renamed = made.select(F.col("left").alias("__into"), F.col("height").alias("__height"), F.explode(F.array("left", "right")).alias("cluster"))
            count = made.count()
        found.append(made)
        now = state.keep(now.join(renamed, "cluster", "left").select(F.coalesce("__into", "cluster").alias("cluster"), F.coalesce("__height", "height").alias("height"), "weight", "vector"))
        left -= count
    # fixed, because numbering by a range shuffle would run them once for its bounds and again for its rows
    found.append(fixed(last_merges(fixed(in_blocks(now, ROUND_BLOCK)), metric, at + 1)))
    return named_by_step(reduce(DataFrame.unionByName, found), n)


def round_block(n: int) -> int:
    """Rows of a block where each cluster looks for its nearest ones: a row is sent twice for each block, so there are as few as leave work for all tasks."""
    return max(1, min(NEAR_BLOCK, max(ROUND_BLOCK, -(-n // 6))))


def in_blocks(now: DataFrame, rows: int) -> DataFrame:
    """Adds `b`, the block, and the size of a row's cluster, after the rows are put in the order of their clusters. Clusters aren't cut: one of more than
    `rows` rows makes a larger block."""
    about = clean.dense_ids(now.select("cluster", "weight"), [F.col("cluster")], "at").groupBy("cluster").agg(F.min("at").alias("at"), F.sum("weight").alias("size"))
    return now.join(about.select("cluster", "size", F.floor(F.col("at") / rows).cast("int").alias("b")), "cluster").drop("weight")


def meeting_blocks(placed: DataFrame) -> DataFrame:
    """A copy of each row for each pair (p, q), p <= q, of blocks that its own is in."""
    known = F.array([F.lit(r[0]) for r in placed.select("b").distinct().orderBy("b").collect()])
    both = F.transform(known, lambda o: F.struct(F.least("b", o).alias("p"), F.greatest("b", o).alias("q")))
    return placed.select("*", F.explode(both).alias("pair")).select(*placed.columns, "pair.p", "pair.q")


def prepared(x: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and their squares as `rising` takes them: unit vectors for cosine."""
    with np.errstate(over="ignore"):
        squares = (x * x).sum(1)
    if not np.isfinite(squares).all():
        raise ValueError("a distance isn't finite")
    if metric == "euclidean":
        return x, squares
    if metric != "cosine":
        raise ValueError(f"unknown metric {metric!r}")
    length = np.linalg.norm(x, axis=1)
    if (length == 0).any():
        raise ValueError("cosine distance of a zero vector")
    return x / length[:, None], squares


def rising(dots: np.ndarray, sx: np.ndarray, sy: np.ndarray, metric: str) -> np.ndarray:
    """What rises with the distance, made of the products in place: itself for cosine, its square for Euclidean."""
    if metric == "cosine":
        np.subtract(1, dots, out=dots)
    else:
        dots *= -2
        dots += sx
        dots += sy
    return np.maximum(dots, 0, out=dots)


class Clusters:
    """The rows of some clusters in the order of the clusters' sizes, and of equal sizes all first rows, then all second ones, so that the greatest of the
    clusters' distances is taken over whole slices. `names` ascend, `rank` is a name's place in that order."""

    def __init__(self, cluster: np.ndarray, x: np.ndarray, metric: str):
        self.names, self.at, of, self.sizes = np.unique(cluster, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(of, kind="stable")
        place = np.empty(len(of), dtype=np.int64)
        place[order] = np.arange(len(of)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.by_size = np.argsort(self.sizes, kind="stable")
        self.rank = np.empty(len(self.names), dtype=np.int64)
        self.rank[self.by_size] = np.arange(len(self.names))
        self.x, self.squares = prepared(x[np.lexsort((self.rank[of], place, self.sizes[of]))], metric)
        sizes, counts = np.unique(self.sizes, return_counts=True)
        self.groups = list(zip(sizes.tolist(), counts.tolist(), (np.cumsum(counts) - counts).tolist(), (np.cumsum(counts * sizes) - counts * sizes).tolist()))

    def greatest(self, d: np.ndarray) -> np.ndarray:
        """Of columns for rows, columns for clusters."""
        if len(self.groups) == 1 and self.groups[0][0] == 1:
            return d
        out = np.empty((len(d), len(self.names)))
        for size, count, first, start in self.groups:
            own = out[:, first : first + count]
            if count < size:
                d[:, start : start + size * count].reshape(len(d), size, count).max(axis=1, out=own)
            else:
                own[:] = d[:, start : start + count]
                for k in range(1, size):
                    np.maximum(own, d[:, start + k * count : start + (k + 1) * count], out=own)
        return out

    def farthest(self, other: "Clusters", metric: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces of these clusters (places in `names`) and what rises with their complete linkage distances to all of the other's, in order of size."""
        for size, count, first, start in self.groups:
            wide = max(1, SLICE // size)
            for k in range(0, count, wide):
                w = min(wide, count - k)
                rows = (start + k + np.arange(size)[:, None] * count + np.arange(w)).reshape(-1)
                out = None
                for i in range(0, len(rows), SLICE):
                    own = rows[i : i + SLICE]
                    d = other.greatest(rising(self.x[own] @ other.x.T, self.squares[own][:, None], other.squares, metric))
                    d = d if size == 1 else d.reshape(-1, w, d.shape[1]).max(axis=0)
                    out = d if out is None else np.maximum(out, d, out=out)
                yield self.by_size[first + k : first + k + w], out


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each pair, the same from both sides."""
    low, high = np.minimum(a, b).astype(np.uint64), np.maximum(a, b).astype(np.uint64)
    h = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)).astype(np.int64)


def sides(table: pa.Table, left: np.ndarray, right: np.ndarray, metric: str) -> tuple[Clusters, Clusters]:
    names, x = table.column("cluster").to_numpy(), vectors_in(table)
    return Clusters(names[left], x[left], metric), Clusters(names[right], x[right], metric)


def least_of(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of each row's finite values among its `k` least (row, column), and what all others of the row aren't below."""
    rows, n = d.shape
    bound = np.full(rows, np.inf)
    parts = n // (4 * k)
    if parts > 1:
        # the k-th least of the least of 4 k parts has k values that aren't above it
        wide = n // parts
        low = d[:, :wide].copy()
        for i in range(1, parts):
            np.minimum(low, d[:, i * wide : (i + 1) * wide], out=low)
        bound = np.partition(low, k, axis=1)[:, k]
    row, column = np.nonzero(d <= bound[:, None]) if parts > 1 else np.nonzero(np.isfinite(d))
    value = d[row, column]
    order = np.lexsort((value, row))
    row, column, value = row[order], column[order], value[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    cut = np.flatnonzero(place == k)
    bound[row[cut]] = np.minimum(bound[row[cut]], value[cut])
    keep = (place < k) & np.isfinite(value)
    return row[keep], column[keep], bound


def near_lists(placed: DataFrame, metric: str) -> DataFrame:
    """(cluster, height, size, others, distances, bound): the `NEAR` nearest clusters of each by complete linkage; all that aren't among its others are at
    least `bound` away. A block looks through each block by itself, then its lists are put together."""
    blocks = [r[0] for r in placed.select("b").distinct().orderBy("b").collect()]
    known = F.array([F.lit(b) for b in blocks])
    own = placed.select("*", F.col("b").alias("p"), F.explode(known).alias("q"), F.lit(True).alias("own"))
    dealt = own.unionByName(placed.select("*", F.explode(known).alias("p"), F.col("b").alias("q"), F.lit(False).alias("own")))

    def near(key, table):
        is_own = table.column("own").to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(is_own), np.flatnonzero(~is_own)
        one, two = sides(table, left, right, metric)
        heights, sizes = (table.column(c).to_numpy()[left][one.at] for c in ("height", "size"))
        same, back, out = key[0].as_py() == key[1].as_py(), two.names[two.by_size], []
        for at, d in one.farthest(two, metric):
            if same:
                d[np.arange(len(at)), two.rank[at]] = np.inf
            row, column, bound = least_of(d, NEAR)
            value = d[row, column]
            if metric == "euclidean":
                value, bound = np.sqrt(value), np.sqrt(bound)
            ends = pa.array(np.searchsorted(row, np.arange(len(at) + 1)).astype(np.int32))
            out.append(pa.table({"cluster": pa.array(one.names[at]), "height": pa.array(heights[at]), "size": pa.array(sizes[at]), "others": pa.ListArray.from_arrays(ends, pa.array(back[column])), "distances": pa.ListArray.from_arrays(ends, pa.array(value)), "bound": pa.array(bound)}))
        return pa.concat_tables(out)

    def together(key, table):
        names, at, of = np.unique(table.column("cluster").to_numpy(), return_index=True, return_inverse=True)
        row, other, far = entries(table, of)
        bound = np.full(len(names), np.inf)
        np.minimum.at(bound, of, table.column("bound").to_numpy())
        order = np.lexsort((mixed(names[row], other), far, row))
        row, other, far = row[order], other[order], far[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        cut = np.flatnonzero(place == NEAR)
        bound[row[cut]] = np.minimum(bound[row[cut]], far[cut])
        keep = (place < NEAR) & (far <= bound[row])
        ends = pa.array(np.searchsorted(row[keep], np.arange(len(names) + 1)).astype(np.int32))
        return pa.table({"cluster": pa.array(names), "height": pa.array(table.column("height").to_numpy()[at]), "size": pa.array(table.column("size").to_numpy()[at]), "others": pa.ListArray.from_arrays(ends, pa.array(other[keep])), "distances": pa.ListArray.from_arrays(ends, pa.array(far[keep])), "bound": pa.array(bound)})

    shape = "cluster bigint, height double, size bigint, others array<bigint>, distances array<double>, bound double"
    # more partitions than pairs, which adaptive execution leaves as they are, so that few tasks have several of these long pairs
    each = dealt.repartition(min(1000, 4 * len(blocks) ** 2), "p", "q").groupBy("p", "q").applyInArrow(near, shape)
    return each.groupBy(F.pmod(F.xxhash64("cluster"), F.lit(4 * len(blocks))).alias("part")).applyInArrow(together, shape)


def entries(table: pa.Table, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A list's entries, one by one: the number (`of`) of its row, the other and the distance."""
    others, far = table.column("others").combine_chunks(), table.column("distances").combine_chunks()
    return np.repeat(of, pc.list_value_length(others).to_numpy(zero_copy_only=False).astype(np.int64)), others.flatten().to_numpy(), far.flatten().to_numpy()


def certain_merges(placed: DataFrame, lists: DataFrame, n: int, metric: str, round_: int) -> DataFrame:
    """The merges that lists of neighbours prove, in as many steps as they reach (left, right, height, size, round, at), and each cluster's new name (at -1:
    left, of the height; right is its old one).

    Distances only grow as clusters merge, so whatever isn't in a list stays beyond its bound, and a merged cluster can go on with the list of its part
    with the greater bound, whose distances are made again where they are the least. Two that are each other's nearest within their bounds merge, as
    complete linkage would do sooner or later. Groups hold `GROUP` clusters; those of other groups are bounds only.
    """
    group = F.pmod(F.xxhash64("cluster", F.lit(round_)), F.lit(max(1, -(-n // GROUP)))).cast("int")

    def merge(a: pa.Table, b: pa.Table) -> pa.Table:
        found = proved_merges(a, b, metric)
        return pa.table({"left": found[0], "right": found[1], "height": found[2], "size": found[3], "round": pa.array(np.full(len(found[0]), round_, np.int32)), "at": found[4]})

    rows = placed.select("cluster", "vector", group.alias("g")).groupBy("g")
    return rows.cogroup(lists.withColumn("g", group).groupBy("g")).applyInArrow(merge, "left bigint, right bigint, height double, size bigint, round int, at bigint")


def greatest_of_pairs(x: np.ndarray, squares: np.ndarray, starts: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """The complete linkage distances of clusters a and b, pair by pair; a cluster's rows are together."""
    out, n = np.empty(len(a)), sizes[a] * sizes[b]
    upto, i = np.concatenate([[0], np.cumsum(n)]), 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + PAIRS, "right")) - 1)
        if n[i] > PAIRS:
            one, two = slice(starts[a[i]], starts[a[i]] + sizes[a[i]]), slice(starts[b[i]], starts[b[i]] + sizes[b[i]])
            out[i] = max(rising(x[k : min(k + SLICE, one.stop)] @ x[two].T, squares[k : min(k + SLICE, one.stop)][:, None], squares[two], metric).max() for k in range(one.start, one.stop, SLICE))
        else:
            at = np.arange(upto[j] - upto[i]) - np.repeat(upto[i:j] - upto[i], n[i:j])
            of = np.repeat(sizes[b[i:j]], n[i:j])
            p, q = np.repeat(starts[a[i:j]], n[i:j]) + at // of, np.repeat(starts[b[i:j]], n[i:j]) + at % of
            out[i:j] = np.maximum.reduceat(rising(np.einsum("ij,ij->i", x[p], x[q]), squares[p], squares[q], metric), upto[i:j] - upto[i])
        i = j
    return np.sqrt(out) if metric == "euclidean" else out


def proved_merges(rows: pa.Table, lists: pa.Table, metric: str) -> list[np.ndarray]:
    """See `certain_merges`: left, right, height, size, at."""
    order = np.argsort(lists.column("cluster").to_numpy())
    names, height, size, bound = (lists.column(c).to_numpy()[order].copy() for c in ("cluster", "height", "size", "bound"))
    n, back = len(names), np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(n)
    src, other, far = entries(lists, back)
    dst = np.minimum(np.searchsorted(names, other), n - 1)
    outside = names[dst] != other
    np.minimum.at(bound, src[outside], far[outside])
    src, dst, far, exact = src[~outside], dst[~outside], far[~outside].copy(), np.ones((~outside).sum(), dtype=bool)
    x, squares = prepared(vectors_in(rows), metric)
    of, now, out, at = np.searchsorted(names, rows.column("cluster").to_numpy()), np.arange(n), [], 0
    while True:
        order = np.argsort(of, kind="stable")
        x, squares, of = x[order], squares[order], of[order]
        counts = np.bincount(of, minlength=n)
        # distances of merged clusters are made if they may be the least
        best = np.full(n, np.inf)
        np.minimum.at(best, src[exact], far[exact])
        open_ = np.flatnonzero(~exact & (far <= np.minimum(best, bound)[src]))
        far[open_], exact[open_] = np.maximum(far[open_], greatest_of_pairs(x, squares, np.cumsum(counts) - counts, counts, src[open_], dst[open_], metric)), True
        np.minimum.at(best, src[open_], far[open_])
        keep = np.flatnonzero(far <= bound[src])
        src, dst, far, exact = src[keep], dst[keep], far[keep], exact[keep]
        first = np.flatnonzero(exact & (far == best[src]))
        first = first[np.lexsort((mixed(names[src[first]], names[dst[first]]), src[first]))]
        first = first[np.flatnonzero(np.diff(src[first], prepend=-1))]
        nearest, distance = np.full(n, -1), np.full(n, np.inf)
        nearest[src[first]], distance[src[first]] = dst[first], far[first]
        a = np.flatnonzero(nearest > np.arange(n))
        a = a[nearest[nearest[a]] == a]
        b = nearest[a]
        if len(a):
            height[a] = np.maximum(np.maximum(distance[a], distance[b]), np.maximum(height[a], height[b]))
            size[a] += size[b]
            out.append((names[a], names[b], height[a], size[a], np.full(len(a), at)))
        at += 1
        into, changed, gone = np.arange(n), np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        into[b] = a
        of, now = into[of], into[now]
        if len(a) * STEPS < n:
            break
        changed[a] = changed[b] = True
        wider = bound[b] > bound[a]
        gone[np.where(wider, a, b)] = True
        bound[a] = np.maximum(bound[a], bound[b])
        keep = ~gone[src] & (into[src] != into[dst])
        src, dst, far, exact = src[keep], dst[keep], far[keep], exact[keep] & ~(changed[src[keep]] | changed[dst[keep]])
        src, dst = into[src], into[dst]
        # two others that became one: the greater distance
        made = np.flatnonzero(~exact)
        made = made[np.lexsort((-far[made], dst[made], src[made]))]
        keep = np.ones(len(src), dtype=bool)
        keep[made] = (np.diff(src[made], prepend=-1) != 0) | (np.diff(dst[made], prepend=-1) != 0)
        src, dst, far, exact = src[keep], dst[keep], far[keep], exact[keep]
    out.append((names[now], names, height[now], size[now], np.full(n, -1)))
    return [np.concatenate(c) for c in zip(*out)]


def mutual_merges(placed: DataFrame, metric: str, round_: int) -> DataFrame:
    """The merges (left, right, height, size, round, at) of all clusters that are each other's nearest."""
    near = fixed(nearest_clusters(placed, metric))
    back = near.select(F.col("cluster").alias("__c"), F.col("other").alias("__o"), F.col("size").alias("__s"), F.col("height").alias("__h"))
    pairs = near.where("cluster < other").join(back, (F.col("other") == F.col("__c")) & (F.col("cluster") == F.col("__o")))
    return pairs.select(F.col("cluster").alias("left"), F.col("other").alias("right"), F.greatest("distance", "height", "__h").alias("height"), (F.col("size") + F.col("__s")).alias("size"), F.lit(round_).alias("round"), F.lit(0).cast("long").alias("at"))


def farthest(table: pa.Table, p: int, q: int, metric: str):
    """The clusters of blocks p and q (names, heights, sizes of each) and the greatest distance between the rows of each two, infinite to itself."""
    b = table.column("b").to_numpy()
    left, right = np.flatnonzero(b == p), np.flatnonzero(b == q)
    one, two = sides(table, left, right, metric)
    about = [(own.names, *(table.column(c).to_numpy()[where][own.at] for c in ("height", "size"))) for own, where in ((one, left), (two, right))]
    d = np.empty((len(one.names), len(two.names)))
    for at, far in one.farthest(two, metric):
        d[at] = far[:, two.rank]
    if metric == "euclidean":
        np.sqrt(d, out=d)
    if p == q:
        d = np.maximum(d, d.T)  # a product's two halves may differ in their last bits
        np.fill_diagonal(d, np.inf)
    return *about, d


def nearest_clusters(placed: DataFrame, metric: str) -> DataFrame:
    """(cluster, height, size, distance, other): each cluster's nearest by complete linkage; equal distances go by a hash of the pair, the same from both
    sides, so that many alike don't all choose one."""

    def best(one, names, d):
        out = []
        for i in range(0, len(d), BLOCK):
            part = d[i : i + BLOCK]
            row, column = np.nonzero((part == part.min(axis=1)[:, None]) & np.isfinite(part))
            tie = mixed(one[0][i + row], names[column])
            order = np.lexsort((names[column], tie, row))
            order = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
            row, column, tie = row[order], column[order], tie[order]
            out.append((*[c[i + row] for c in one], part[row, column], tie, names[column]))
        return [np.concatenate(c) for c in zip(*out)]

    def nearest(key, table):
        p, q = key[0].as_py(), key[1].as_py()
        one, two, d = farthest(table, p, q, metric)
        found = [best(one, two[0], d)] if d.size else []
        if p != q and d.size:
            found.append(best(two, one[0], np.ascontiguousarray(d.T)))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.array([])] * 6
        return pa.table({c: pa.array(v.astype(t)) for c, v, t in zip(("cluster", "height", "size", "distance", "tie", "other"), columns, (np.int64, float, np.int64, float, np.int64, np.int64))})

    each = meeting_blocks(placed).groupBy("p", "q").applyInArrow(nearest, "cluster bigint, height double, size bigint, distance double, tie bigint, other bigint")
    least = F.min(F.struct("distance", "tie", "other")).alias("n")
    return each.groupBy("cluster").agg(F.max("height").alias("height"), F.max("size").alias("size"), least).select("cluster", "height", "size", "n.distance", "n.other")


def last_merges(placed: DataFrame, metric: str, round_: int) -> DataFrame:
    """The merges of as few clusters as one task takes: block pairs send the clusters' distances, and one group merges."""

    def sent(key, table):
        p, q, pieces = key[0].as_py(), key[1].as_py(), []
        one, two, d = farthest(table, p, q, metric)
        for k in range(0, len(two[0]), BLOCK):
            own = d[:, k : k + BLOCK]
            ends = np.arange(len(own) + 1, dtype=np.int32) * own.shape[1]
            pieces.append(pa.table({**{c: pa.array(v) for c, v in zip(("cluster", "height", "size"), one)}, "b": pa.array(np.full(len(own), p, np.int32)), "q": pa.array(np.full(len(own), q, np.int32)), "start": pa.array(np.full(len(own), k, np.int32)), "d": pa.ListArray.from_arrays(pa.array(ends), pa.array(own.reshape(-1)))}))
        return pa.concat_tables(pieces)

    def merge(table):
        names, at = np.unique(table.column("cluster").to_numpy(), return_index=True)
        heights, sizes = list(table.column("height").to_numpy()[at]), list(table.column("size").to_numpy()[at])
        d, blocks = Half(len(names)), table.column("b").to_numpy()[at]
        of = {block: np.flatnonzero(blocks == block) for block in np.unique(blocks)}
        columns = [table.column(c).to_numpy() for c in ("cluster", "q", "start")]
        for cluster, q, start, far in zip(*columns, table.column("d")):
            d.put_pairs(int(np.searchsorted(names, cluster)), of[q][start : start + len(far)], far.values.to_numpy())
        merges, least, out = nearest_neighbour_chain(d) if len(names) > 1 else np.empty((0, 4)), list(range(len(names))), []
        for step, (a, b, height, _) in enumerate(merges):
            a, b = int(a), int(b)
            heights.append(max(height, heights[a], heights[b]))
            sizes.append(sizes[a] + sizes[b])
            least.append(min(least[a], least[b]))
            out.append((names[least[-1]], names[max(least[a], least[b])], heights[-1], sizes[-1], round_, step))
        columns = list(zip(*out)) if out else [()] * 6
        return pa.table({c: pa.array(list(v), t) for c, v, t in zip(("left", "right", "height", "size", "round", "at"), columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int32(), pa.int64()))})

    far = meeting_blocks(placed).groupBy("p", "q").applyInArrow(sent, "cluster bigint, height double, size bigint, b int, q int, start int, d array<double>")
    return far.withColumn("g", F.lit(0)).groupBy("g").applyInArrow(lambda t: merge(t), "left bigint, right bigint, height double, size bigint, round int, at bigint")


def named_by_step(merges: DataFrame, n: int) -> DataFrame:
    """The tree of merges (left, right, height, size, round, at) of clusters named by their smallest member: numbered by height, round and place."""
    steps = fixed(clean.dense_ids(merges, [F.col(c) for c in ("height", "round", "at", "left")], "merge_step"))
    before = F.lag("merge_step").over(Window.partitionBy("left").orderBy("merge_step"))
    last = steps.groupBy(F.col("left").alias("__name")).agg(F.max("merge_step").alias("__last"))
    nodes = steps.withColumn("__before", before).join(last, F.col("right") == F.col("__name"), "left")
    a, b = F.coalesce(F.col("__before") + n, "left"), F.coalesce(F.col("__last") + n, "right")
    return nodes.select("merge_step", F.least(a, b).alias("left_id"), F.greatest(a, b).alias("right_id"), F.col("height").alias("merge_distance"), "size")


def keep_tree(tree: DataFrame) -> DataFrame:
    """The tree fixed in files, so that linkage runs once however often it is read."""
    return fixed(tree)


def clusters(tree: DataFrame, k: int) -> DataFrame:
    """(id, cluster) of the flat cut into at most k clusters, labelled 1, 2, ... by descending size, then smallest member. Merges of equal height go
    together, so ties may leave fewer than k."""
    members = fixed(trees.cut_nodes(tree, k))
    return members.join(trees.labelled(members), "node").select("id", "cluster")


def elbow(rows: DataFrame, tree: DataFrame, most: int = 16) -> DataFrame:
    """The scores of the flat cuts with 2 to `most` clusters (fewer items give fewer cuts), see `cut_scores`."""
    n = tree.count() + 1
    ks = list(range(2, min(most, n - 1) + 1))
    if not ks:
        return cut_scores(rows, tree.sparkSession.createDataFrame([], "id bigint, labels array<bigint>"), 2)
    return cut_scores(rows, cut_labels(tree, ks), 2)


def cut_labels(tree: DataFrame, ks: list[int]) -> DataFrame:
    """(id, labels): each item's cluster in the cut for each of `ks`, labelled as in `clusters`.

    Items climb once, to the clusters of the finest cut. Coarser cuts merge these few clusters, so the driver works on
    as many rows as the finest cut has clusters.
    """
    n = tree.count() + 1
    members = fixed(trees.cut_nodes(tree, max(ks)))
    finest = {r["node"]: (r["n"], r["first"]) for r in members.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).collect()}
    above = trees.merges_of_cut(tree, n, max(ks))
    merges = tree.where(F.col("merge_step") >= above).orderBy("merge_step").collect()
    labels: dict[int, list[int]] = {node: [] for node in finest}
    for k in ks:
        stop, groups = trees.merges_of_cut(tree, n, k), {node: [node] for node in finest}
        for m in merges:
            if m["merge_step"] < stop:
                groups[n + m["merge_step"]] = groups.pop(m["left_id"]) + groups.pop(m["right_id"])
        order = sorted(groups.values(), key=lambda g: (-sum(finest[x][0] for x in g), min(finest[x][1] for x in g)))
        for label, group in enumerate(order, 1):
            for node in group:
                labels[node].append(label)
    named = tree.sparkSession.createDataFrame(list(labels.items()), "node bigint, labels array<bigint>")
    return members.join(F.broadcast(named), "node").select("id", "labels")


def cut_scores(rows: DataFrame, members: DataFrame, first_k: int) -> DataFrame:
    """requested_k, actual_k, within_cluster_sse (unit vectors), min and max cluster size, sse_drop, elbow_distance_to_line.

    members: id, labels, an array of the item's cluster in the cut for first_k, first_k + 1, ... The line runs from the first
    cut to the last, over actual_k. Without cuts there are no rows.
    """
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))
    unit = rows.select("id", F.col("vector").cast("array<double>").alias("vector")).withColumn("l", length).select("id", F.posexplode(F.transform("vector", lambda v: F.when(F.col("l") > 0, v / F.col("l")).otherwise(F.lit(0.0)))).alias("f", "v"))
    long = unit.join(members, "id").select("f", "v", F.posexplode("labels").alias("at", "cluster"))
    per = long.groupBy("at", "cluster", "f").agg(F.sum(F.col("v") * F.col("v")).alias("q"), F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    sse = per.groupBy("at").agg(F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within_cluster_sse"), F.countDistinct("cluster").alias("actual_k"), F.min("n").alias("min_cluster_size"), F.max("n").alias("max_cluster_size"))
    # a row for each cut, so these windows hold a few rows
    out = sse.withColumn("requested_k", (F.col("at") + first_k).cast("int")).withColumn("sse_drop", F.lag("within_cluster_sse").over(Window.orderBy("requested_k")) - F.col("within_cluster_sse"))
    ends = Window.orderBy("requested_k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = out.withColumns({"x1": F.first("actual_k").over(ends), "y1": F.first("within_cluster_sse").over(ends), "x2": F.last("actual_k").over(ends), "y2": F.last("within_cluster_sse").over(ends)})
    run = F.sqrt((F.col("x2") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y2") - F.col("y1")) * (F.col("y2") - F.col("y1")))
    far = F.abs((F.col("x2") - F.col("x1")) * (F.col("y1") - F.col("within_cluster_sse")) - (F.col("y2") - F.col("y1")) * (F.col("x1") - F.col("actual_k")))
    return out.select("requested_k", "actual_k", "within_cluster_sse", "min_cluster_size", "max_cluster_size", "sse_drop", F.when(run > 0, far / run).otherwise(F.lit(0.0)).alias("elbow_distance_to_line"))


def classical_scaling(rows: DataFrame, metric: str = "cosine", most: int = 5000) -> DataFrame:
    """(id, x, y): double-centred squared distances, the two largest eigenpairs, each with its sign by its greatest feature.

    Squared distances are sums of products of features: Euclidean ones of the vector itself, cosine ones of the unit vector u and of all u_i u_j,
    1 - 2 u.v + (u.v)^2. So the eigenpairs follow from the features' moments, which partitions add up, whatever the number of rows: the driver holds
    a matrix of p x p for p features (2,144 for 64 dimensions). Vectors with more than `most` features, which are also too many for that, can be
    scaled by all their distances, for at most `most` items.
    """
    rows = rows.select("id", F.col("vector").cast("array<double>").alias("vector"))
    first = rows.first()
    if first is None:
        return rows.sparkSession.createDataFrame([], "id bigint, x double, y double")
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    wide = len(first["vector"])
    p = wide if metric == "euclidean" else wide + wide * (wide + 1) // 2
    if p > most:
        return scaling_of_distances(rows, metric, most)
    upper, lower = np.triu_indices(wide)

    def features_of(x: np.ndarray) -> np.ndarray:
        if metric == "euclidean":
            out = x
        else:
            length = np.linalg.norm(x, axis=1)
            if (length == 0).any():
                raise ValueError("cosine distance of a zero vector")
            u = x / length[:, None]
            out = np.hstack([u, u[:, upper] * u[:, lower] * np.where(upper == lower, 1.0, np.sqrt(2.0))])
        if not np.isfinite(out).all():
            raise ValueError("a distance isn't finite")
        return out

    def moments(batches):
        n, total, square = 0, np.zeros(p), np.zeros((p, p))
        for batch in batches:
            x = vectors_in(pa.Table.from_batches([batch]))
            for i in range(0, len(x), BLOCK):
                f = features_of(x[i : i + BLOCK])
                n, total, square = n + len(f), total + f.sum(axis=0), square + f.T @ f
        for at in range(p if n else 0):
            yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "n": pa.array([n]), "s": pa.array([total[at]]), "row": pa.array([square[at].tolist()], pa.list_(pa.float64()))})

    def summed(key, table):
        return pa.table({"at": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([int(pc.sum(table.column("n")).as_py())]), "s": pa.array([float(pc.sum(table.column("s")).as_py())]), "row": pa.array([table.column("row").combine_chunks().flatten().to_numpy().reshape(table.num_rows, p).sum(axis=0)], pa.list_(pa.float64()))})

    shape = "at int, n bigint, s double, row array<double>"
    parts = rows.select("vector").coalesce(MOMENT_PARTS).mapInArrow(moments, shape)
    got = parts.groupBy("at").applyInArrow(summed, shape).toArrow().sort_by("at")
    n, mean = got.column("n")[0].as_py(), got.column("s").to_numpy() / got.column("n")[0].as_py()
    square = got.column("row").combine_chunks().flatten().to_numpy().reshape(p, p) - n * np.outer(mean, mean)
    # B = F S F' with centred features F, and S of 1 for u and -1/2 for its products: its eigenvalues are those of R S R', R R = F'F
    sign = np.ones(p) if metric == "euclidean" else np.where(np.arange(p) < wide, 1.0, -0.5)
    values, vectors = np.linalg.eigh(square)
    root = vectors * np.sqrt(np.maximum(values, 0))
    values, inner = np.linalg.eigh((root.T * sign) @ root)
    k = min(2, p)
    values, inner = np.maximum(values[::-1][:k], 0), inner[:, ::-1][:, :k]
    # an eigenvector of B is F S root w / value, of length 1, as B = F S F' and F'F = root root'
    to = (sign[:, None] * (root @ inner)) / np.where(values > 1e-12 * max(values[0], 1e-300), np.sqrt(np.maximum(values, 1e-300)), np.inf)
    to = to * np.sign(to[np.abs(to).argmax(axis=0), np.arange(k)] + 0.0)

    def placed(batches):
        for batch in batches:
            x = vectors_in(pa.Table.from_batches([batch]))
            y = np.vstack([np.zeros((0, k)), *[(features_of(x[i : i + BLOCK]) - mean) @ to for i in range(0, len(x), BLOCK)]])
            y = np.hstack([y, np.zeros((len(y), 2 - k))])
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "x": pa.array(y[:, 0]), "y": pa.array(y[:, 1])})

    return rows.select(F.col("id").cast("bigint").alias("id"), "vector").mapInArrow(placed, "id bigint, x double, y double")


#: Partitions that add up moments before they are sent, a matrix each.
MOMENT_PARTS = 12


def scaling_of_distances(rows: DataFrame, metric: str, most: int) -> DataFrame:
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} items")
    x = np.array([r["vector"] for r in got], dtype=float)
    d2 = distances(x, x, metric) ** 2
    centre = np.eye(len(x)) - 1 / len(x)
    values, vectors = np.linalg.eigh(-centre @ d2 @ centre / 2)
    top = vectors[:, ::-1][:, :2] * np.sqrt(np.maximum(values[::-1][:2], 0))
    return rows.sparkSession.createDataFrame([(r["id"], float(a[0]), float(a[1])) for r, a in zip(got, top)], "id bigint, x double, y double")
