"""Linkage against a naive merge, cuts with ties, roles and like items."""

import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from brindle.operators import cluster, features, likeitems, tree


def naive(d):
    groups, heights = [[i] for i in range(len(d))], []
    while len(groups) > 1:
        best = min((max(d[x, y] for x in a for y in b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        heights.append(best[0])
        groups[best[1]] += groups.pop(best[2])
    return heights


@settings(max_examples=25, deadline=None)
@given(st.integers(2, 30), st.integers(0, 10_000))
def test_chain_equals_naive_merge(n, seed):
    x = np.random.default_rng(seed).normal(size=(n, 4))
    d = cluster.distances(x, x, "euclidean")
    np.fill_diagonal(d, 0)
    m = cluster.nearest_neighbour_chain(d.copy())
    assert np.allclose(m[:, 2], naive(d)) and (np.diff(m[:, 2]) >= 0).all()
    members = {i: [i] for i in range(n)}
    for k, (a, b, height, size) in enumerate(m):
        members[n + k] = both = members[int(a)] + members[int(b)]
        assert size == len(both) and np.isclose(height, max(d[i, j] for i in both for j in both))


TREE = "merge_step bigint, left_id bigint, right_id bigint, merge_distance double, size bigint"


def labels_of(df):
    return [c for _, c in sorted((r["id"], r["cluster"]) for r in df.collect())]


def test_cut_with_ties_and_bounds(spark):
    m = spark.createDataFrame([(0, 0, 1, 1.0, 2), (1, 2, 3, 1.0, 2), (2, 4, 5, 2.0, 4)], TREE)
    assert labels_of(cluster.clusters(m, 2)) == [1, 1, 2, 2]
    assert labels_of(cluster.clusters(m, 3)) == [1, 1, 2, 2]
    assert labels_of(cluster.clusters(m, 4)) == [1, 2, 3, 4]
    assert labels_of(cluster.clusters(m, 1)) == [1, 1, 1, 1]
    assert {r["id"]: r["labels"] for r in cluster.cut_labels(m, [2, 3]).collect()} == {0: [1, 1], 1: [1, 1], 2: [2, 2], 3: [2, 2]}
    with pytest.raises(ValueError):
        cluster.clusters(m, 5)


def by_walk(merges, n, held):
    """Each holdout item's first merge with history: (node, size, its historical members)."""
    members, out = {i: {i} for i in range(n)}, {}
    for step, (a, b, *_) in enumerate(merges):
        members[n + step] = members.pop(a) | members.pop(b)
        for t in members[n + step] & held - set(out):
            if members[n + step] - held:
                out[t] = (n + step, len(members[n + step]), members[n + step] - held)
    return out


@pytest.mark.parametrize("n, seed", [(2, 0), (17, 1), (60, 2), (61, 3)])
def test_first_merges_and_cuts_by_walk(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    m = cluster.nearest_neighbour_chain(cluster.distances(x, x, "euclidean"))
    merges = [(int(a), int(b), float(h), int(s)) for a, b, h, s in m]
    held = {int(i) for i in np.flatnonzero(rng.random(n) < 0.7)}
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(merges)], TREE)
    members = spark.createDataFrame([(i, i not in held) for i in range(n)], "id bigint, flag boolean")
    found, ranks = tree.first_with(table, members, "flag")
    rank = {r["id"]: r["rank"] for r in ranks.collect()}
    assert sorted(rank.values()) == list(range(n - len(held))) and set(rank) == set(range(n)) - held
    got = {r["id"]: (r["node"], r["cluster_size"], {i for i, k in rank.items() if r["lo"] <= k < r["hi"]}) for r in found.collect()}
    assert got == by_walk(merges, n, held)
    for k in (1, 2, max(1, n // 3), n):
        root, stop = list(range(n)), n - k
        groups = {i: [i] for i in range(n)}
        for step in range(stop):
            groups[n + step] = groups.pop(merges[step][0]) + groups.pop(merges[step][1])
        want = [0] * n
        for label, g in enumerate(sorted(groups.values(), key=lambda g: (-len(g), min(g))), 1):
            for i in g:
                want[i] = label
        assert labels_of(cluster.clusters(table, k)) == want


def test_a_chain_of_20000_merges_stays_bounded(spark):
    """A caterpillar: no table of all its 200 million ancestors, a few rounds."""
    n = 20_000
    m = spark.range(n - 1).select(F.col("id").alias("merge_step"), F.when(F.col("id") == 0, 0).otherwise(F.col("id") + (n - 1)).cast("long").alias("left_id"), (F.col("id") + 1).alias("right_id"), F.col("id").cast("double").alias("merge_distance"), (F.col("id") + 2).alias("size"))
    members = spark.range(n).select("id", (F.col("id") % 1000 == 999).alias("flag"))
    found, ranks = tree.first_with(m, members, "flag")
    rows = {r["id"]: (r["node"], r["cluster_size"], r["lo"], r["hi"]) for r in found.where("id IN (0, 500, 998, 1000, 19998)").collect()}
    assert found.count() == n - 20 and ranks.count() == 20
    assert rows[0] == rows[500] == rows[998] == (n + 998, 1000, 0, 1)
    assert rows[1000] == (n + 999, 1001, 0, 1) and rows[19998] == (n + 19997, 19999, 0, 19)


def test_sparse_rows_give_the_dense_distances(spark):
    rng = np.random.default_rng(4)
    cells = [(i, f"f{j}", float(rng.normal())) for i in range(700) for j in [0, *rng.choice(40, 3)]]
    long = spark.createDataFrame(cells, "id bigint, feature string, value double")
    for metric in ("cosine", "euclidean"):
        a = cluster.pair_distances(cluster.dense_matrix(long), metric).withColumnRenamed("distance", "a")
        b = cluster.pair_distances(cluster.sparse_rows(long), metric).withColumnRenamed("distance", "b")
        row = a.join(b, ["i", "j"]).agg(F.count(F.lit(1)), F.max(F.abs(F.col("a") - F.col("b")))).first()
        assert row[0] == 700 * 699 // 2 and row[1] < 1e-6


def test_items_are_sent_to_targets_that_reach_them(spark):
    """An item goes to the chunks of targets that reach its block, not to all: 1,000 targets with 8 items each are sent each item once."""
    n = 8_000
    vector = F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector")
    others = spark.range(n).select("id", vector, F.col("id").alias("rank"))
    targets = spark.range(n, n + n // 8).select("id", vector, ((F.col("id") - n) * 8).alias("lo"), ((F.col("id") - n) * 8 + 8).alias("hi"))
    left, right = cluster.meeting_ranges(targets, others)
    assert right.count() == n and left.count() == n // 8
    assert cluster.nearest_in_ranges(targets, others, None, "euclidean").count() == n
    crowd = spark.range(n, n + 2 * cluster.BLOCK + 1).select("id", vector, F.lit(0).alias("lo"), F.lit(10).alias("hi"))
    left, right = cluster.meeting_ranges(crowd, others)
    assert right.count() == 3 * cluster.BLOCK and right.where("rank < 10").groupBy("rank").count().where("count <> 3").isEmpty()
    assert cluster.nearest_in_ranges(crowd, others, None, "euclidean").count() == 10 * crowd.count()


def test_the_last_group_is_merged_once(spark, monkeypatch):
    """Its task is the longest, and numbering its merges takes several jobs."""
    runs, merges = spark.sparkContext.accumulator(0), cluster.last_merges

    def counted(*args):
        out = merges(*args)

        def count(batches):
            for batch in batches:
                runs.add(batch.num_rows)
                yield batch

        return out.mapInArrow(count, out.schema)

    monkeypatch.setattr(cluster, "last_merges", counted)
    x = np.random.default_rng(2).normal(size=(60, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    assert cluster.linkage(rows, "euclidean", in_task=20).count() == 59
    assert 0 < runs.value < 20


def test_nearest_items_by_block(spark):
    rng = np.random.default_rng(6)
    x, t = rng.normal(size=(1300, 2)), rng.normal(size=(600, 2))
    others = spark.createDataFrame([(10_000 + i, i, v.tolist()) for i, v in enumerate(x)], "id bigint, rank bigint, vector array<double>")
    ranges = [sorted(rng.choice(1301, 2, replace=False)) for _ in t]
    targets = spark.createDataFrame([(i, int(lo), int(hi), v.tolist()) for i, (v, (lo, hi)) in enumerate(zip(t, ranges))], "id bigint, lo bigint, hi bigint, vector array<double>")
    sent = cluster.nearest_in_ranges(targets, others, 4, "euclidean")
    rows = {}
    for r in sent.collect():
        rows.setdefault(r["target_id"], []).append((r["distance"], r["like_id"]))
    assert sum(map(len, rows.values())) <= 600 * 4 * 3
    for i, (lo, hi) in enumerate(ranges):
        d = np.linalg.norm(x[lo:hi] - t[i], axis=1)
        assert [p - 10_000 for _, p in sorted(rows[i])[:4]] == [lo + k for k in np.argsort(d)[:4]]


def test_small_inputs_and_errors(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "id bigint, vector array<double>")
    assert [r["merge_distance"] for r in cluster.linkage(rows).collect()] == [1.0]
    assert cluster.linkage(rows.where("id = 0")).count() == 0
    with pytest.raises(ValueError, match="more than"):
        cluster.linkage(rows, most=1)
    with pytest.raises(ValueError, match="zero vector"):
        cluster.distances(np.zeros((1, 2)), np.ones((1, 2)), "cosine")
    with pytest.raises(ValueError, match="no usable"):
        features.feature_table(rows, "id", {"absent": 1.0})


def test_pair_distances_cover_all_pairs(spark):
    x = np.random.default_rng(1).normal(size=(1100, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    got = cluster.pair_distances(rows, "euclidean")
    assert got.count() == 1100 * 1099 // 2 and got.where("i >= j").count() == 0
    for r in got.limit(20).collect():
        assert abs(r["distance"] - np.linalg.norm(x[r["i"]] - x[r["j"]])) < 1e-9


def test_roles(spark):
    d = datetime.date
    rows = [(i, d(2024, 1, 1) if i < 3 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "id bigint, d date")
    assert [r["id"] for r in likeitems.roles(df, "id", "d").where("role = 'holdout_new_game'").collect()] == [0]
    assert likeitems.roles(df.limit(1), "id", "d").first()["role"] == "holdout_new_game"
    assert likeitems.roles(df.limit(0), "id", "d").count() == 0


def test_like_items_follow_the_first_merge_with_history(spark):
    x = {0: [0.0], 1: [0.1], 2: [1.0], 3: [10.0]}
    items = spark.createDataFrame([(i, v) for i, v in x.items()], "id bigint, vector array<double>")
    merges = cluster.keep_tree(cluster.linkage(items, "euclidean"))
    role = spark.createDataFrame([(0, likeitems.HOLDOUT), (1, likeitems.HOLDOUT), (2, likeitems.HISTORICAL), (3, likeitems.HISTORICAL)], "id bigint, role string")
    got = likeitems.like_items(merges, role, items, cluster.clusters(merges, 2), metric="euclidean").collect()
    assert {(r["target_id"], r["like_id"], r["candidate_rank"], r["same_flat_cluster"]) for r in got} == {(0, 2, 1, True), (1, 2, 1, True)}


def test_categorical_levels(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["a", "a", "b", "b", "c", None])], "id bigint, c string")
    got = {r["id"]: r["feature"] for r in features.categorical(df, "id", "c", 1.0).collect()}
    assert got == {0: "cat__c_a", 1: "cat__c_a", 2: "cat__c_b", 3: "cat__c_b", 4: "cat__c___other__", 5: "cat__c___other__"}
    assert features.categorical(df, "id", "c", 1.0, drop_missing=True).count() == 4
    with pytest.raises(ValueError, match="forbidden"):
        features.feature_metadata(features.categorical(df, "id", "c", 1.0), 6, ("__c_a",)).collect()


def test_scaling_keeps_planar_distances(spark):
    x = np.random.default_rng(2).normal(size=(12, 2))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    got = np.array([(r["x"], r["y"]) for r in cluster.classical_scaling(rows, "euclidean").orderBy("id").collect()])
    assert np.allclose(cluster.distances(got, got, "euclidean"), cluster.distances(x, x, "euclidean"), atol=1e-6)


@pytest.mark.parametrize("n, metric, seed", [(300, "cosine", 1), (700, "euclidean", 2)])
def test_rounds_make_the_tree_of_one_group(spark, monkeypatch, n, metric, seed):
    """More items than a task takes: small blocks, so that clusters are larger than a block, and copies."""
    monkeypatch.setattr(cluster, "ROUND_BLOCK", 60)
    x = np.random.default_rng(seed).normal(size=(n, 5))
    x[10:14], x[n - 5] = x[9], x[20]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")

    def members(tree):
        made, out = {i: frozenset([i]) for i in range(n)}, []
        for r in sorted(tree.collect()):
            assert r["left_id"] < n + r["merge_step"] and r["right_id"] < n + r["merge_step"]
            made[n + r["merge_step"]] = both = made.pop(r["left_id"]) | made.pop(r["right_id"])
            assert len(both) == r["size"]
            out.append((both, r["merge_distance"]))
        assert len(out) == n - 1 and [h for _, h in out] == sorted(h for _, h in out)
        return {m: h for m, h in out if h > 1e-7}

    one, many = members(cluster.linkage(rows, metric)), members(cluster.linkage(rows, metric, in_task=40))
    assert set(one) == set(many) and all(abs(one[m] - many[m]) < 1e-9 for m in one)


def test_rounds_end_with_equal_distances(spark):
    """All distances between 30 corners are ties; copies of a corner merge first."""
    x = np.vstack([np.eye(30)] * 3)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    got = sorted(cluster.linkage(rows, in_task=5).collect())
    assert [r["merge_distance"] for r in got] == [0.0] * 60 + [1.0] * 29 and got[-1]["size"] == 90


@pytest.mark.parametrize("metric, dims", [("cosine", 6), ("euclidean", 6), ("cosine", 1)])
def test_scaling_by_moments_is_that_of_all_distances(spark, metric, dims):
    """6,000 items were an error; of 300 both ways agree, but for signs."""
    x = np.random.default_rng(5).normal(size=(300, dims)) * (np.arange(dims) + 1) + 0.5
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    a = np.array([(r["x"], r["y"]) for r in cluster.classical_scaling(rows, metric).orderBy("id").collect()])
    b = np.array([(r["x"], r["y"]) for r in cluster.scaling_of_distances(rows, metric, 5000).orderBy("id").collect()])
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-6)
    many = spark.range(6000).select("id", F.array(*[F.rand(i) for i in range(3)]).alias("vector"))
    assert cluster.classical_scaling(many, metric).count() == 6000


def test_blocks_of_all_pairs_follow_the_rows_slowly():
    """A row is sent once for each block; blocks of 512 rows made that 200 times for 102,560 rows."""
    assert [cluster.pair_blocks(n) for n in (0, 1, 600, 10_256, 102_560, 360_000)] == [1, 1, 2, 8, 8, 22]


def test_lists_of_neighbours_prove_many_merges_a_round(spark, monkeypatch):
    """A merge a cluster and round at most left 2 to 5 % of the clusters merged in a round, so 600 items took dozens of rounds to 40 clusters."""
    rounds, in_blocks = [], cluster.in_blocks
    monkeypatch.setattr(cluster, "in_blocks", lambda *args: rounds.append(1) or in_blocks(*args))
    x = np.random.default_rng(3).normal(size=(600, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    got = sorted(r["merge_distance"] for r in cluster.linkage(rows, in_task=40).collect())
    assert len(rounds) <= 6
    assert np.allclose(got, cluster.nearest_neighbour_chain(cluster.distances(x, x, "cosine") + np.diag(np.full(600, np.inf)))[:, 2])


def test_merges_across_groups_and_lists_of_few(spark, monkeypatch):
    """Groups of 50 clusters and lists of 3: what the others hold are bounds, and the tree is still that of all pairs."""
    monkeypatch.setattr(cluster, "GROUP", 50)
    monkeypatch.setattr(cluster, "NEAR", 3)
    x = np.random.default_rng(8).normal(size=(200, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    got = sorted(r["merge_distance"] for r in cluster.linkage(rows, "euclidean", in_task=90).collect())
    assert np.allclose(got, naive(cluster.distances(x, x, "euclidean")))


def test_least_of_rows_bound_the_others():
    d = np.random.default_rng(1).random((20, 3000))
    d[0], d[1, :2000], d[2, 5] = 0.5, 0.25, np.inf
    row, column, bound = cluster.least_of(d, 8)
    for i in range(20):
        own = column[row == i]
        assert len(own) == 8 and np.allclose(np.sort(d[i, own]), np.sort(d[i])[:8])
        assert np.delete(d[i], own).min() >= bound[i] >= d[i, own].max()
    row, column, bound = cluster.least_of(d[:, :5], 8)
    assert len(row) == 100 and np.isinf(bound).all()
