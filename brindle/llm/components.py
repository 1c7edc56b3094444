"""Connected components over a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import checkpoint


#: Links in a file between steps.
ROWS_IN_FILE = 200_000


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame, a: str, b: str, max_steps: int = 60) -> DataFrame:
    """(node, component) for every node of `links`, component being the smallest node reachable.

    Each step is an aggregation (smallest neighbour) and an equi-join back. Both sides of that join are written tables,
    dealt out by the join alone, so that Spark can split the links of a node with many over tasks. Steps are logarithmic in the
    longest path. Links are written to the checkpoint folder after each step.
    Self-links give a node of its own; nulls are no nodes; repeated links count once; no links, no rows.
    """
    u, v = F.col(a), F.col(b)
    linked = links.where(u.isNotNull() & v.isNotNull())
    nodes = linked.select(u.alias("node")).union(linked.select(v.alias("node"))).distinct()
    edges = checkpoint(linked.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    nodes = checkpoint(nodes)
    before = _digest(edges)
    for _ in range(max_steps):
        if not before[0]:
            break
        # large star: every larger neighbour of u links to the smallest of u and its neighbours
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpoint(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m")))
        large = both.join(least, F.col("u") == F.col("x")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = checkpoint(large)
        # small star: u and its smaller neighbours link to the smallest of them
        small_least = checkpoint(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m"))
        small = large.join(small_least, F.col("u") == F.col("x"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        # a step leaves no more links than there were, so few links need few files
        edges = checkpoint(small.coalesce(max(1, -(-before[0] // ROWS_IN_FILE))))
        after = _digest(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components didn't settle in {max_steps} steps")
    roots = edges.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(roots, F.col("node") == F.col("u"), "left").select("node", F.coalesce("v", "node").alias("component"))
