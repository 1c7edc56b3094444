"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each node every child draws -ln(u) / weight from a hash of the key and the child's path; the smallest draw
wins, so a child wins in proportion to its weight. A child whose weight changes wins or loses keys against its
siblings alone, and draws of other nodes don't change: movement stays within the changed subtrees.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import number_in_groups, unused_name


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(n: int = 16, racks: int = 2, shards: int = 2) -> tuple[Leaf, ...]:
    """n equal shards, `shards` to a rack and `racks` to a region."""
    return tuple(Leaf(f"region{i // (racks * shards)}", f"rack{i // shards % racks}", i) for i in range(n))


def grow(tree: tuple[Leaf, ...]) -> tuple[Leaf, ...]:
    """One more shard, in a region of its own: only that region's draw is new, so rows move into it and nowhere else."""
    n = max((x.shard for x in tree), default=-1) + 1
    return (*tree, Leaf(f"region+{n}", "rack0", n))


def draw(key, path: str, weight: float) -> F.Column:
    """An exponential draw with the given weight: 52 bits of md5 of the path and the key."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(path + "\x00"), key).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 52))) / F.lit(weight)


def shard_expr(key, tree: tuple[Leaf, ...]) -> F.Column:
    """The shard of a key (a string): the winner of each level's draws, level by level."""

    def pick(children: list[tuple[str, float, F.Column]]) -> F.Column:
        if len(children) == 1:
            return children[0][2]
        best = F.least(*[draw(key, path, weight) for path, weight, _ in children])
        out = children[-1][2]
        for path, weight, value in reversed(children[:-1]):
            out = F.when(draw(key, path, weight) == best, value).otherwise(out)
        return out

    def level(leaves: tuple[Leaf, ...], path: str, names: tuple[str, ...]) -> F.Column:
        if not names:
            return F.lit(leaves[0].shard)
        groups: dict[str, list[Leaf]] = {}
        for x in leaves:
            groups.setdefault(str(getattr(x, names[0])), []).append(x)
        return pick([(f"{path}/{k}", sum(x.weight for x in v), level(tuple(v), f"{path}/{k}", names[1:])) for k, v in groups.items()])

    return level(tree, "", ("region", "rack", "shard")).cast("int")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree: tuple[Leaf, ...] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, carried columns, size, text_crc32, law (`key`), shard, slot, grown_shard.

    shard depends on the id and the tree alone; grown_shard is the shard after one more was added. slot numbers
    a shard's rows from 0 without gaps, in parts of about 20,000 rows cut by a hash of id and text, so no task
    holds a whole shard. A null id is the key of the empty string; rows alike in id share a shard and have slots
    of their own; a null text has size 1 and the checksum of the empty text. Empty tables give no rows.
    Columns that are neither named nor carried are ignored, whatever their names.
    """
    tree = even_tree() if tree is None else tree
    key, text = F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("__id"),
        *[F.col(c).alias(f"__c_{c}") for c in carry],
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_expr(key, tree).alias("shard"),
        shard_expr(key, grow(tree)).alias("grown_shard"),
    )
    numbered = number_in_groups(rows, ["shard"], ["__id", "text_crc32", "size"], F.xxhash64("__id", "text_crc32"), -(-docs.count() // max(1, len(tree))), "slot")
    return numbered.select(F.col("__id").alias(id_col), *[F.col(f"__c_{c}").alias(c) for c in carry], "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tree: tuple[Leaf, ...] | None = None, rows_in_file: int = 100_000) -> None:
    """The documents as Parquet, a folder per shard, in files of about `rows_in_file` rows in order of their slots.

    Documents keep all their columns; one that is called like a column of the sharding is written as `document_<name>`. Nulls, equal rows and
    long texts are written as they are; an empty table gives an empty folder.
    """
    names = ("shard", "slot", "size", "law", "text_crc32", "grown_shard")
    own = [c for c in docs.columns if c != id_col]
    carried = docs.select(id_col, text_col, F.struct(F.lit(None).cast("string").alias(unused_name(own)), *[F.col(c) for c in own if c != text_col]).alias("__own"), F.col(text_col).alias("__text"))
    rows = shard_documents(carried, id_col, text_col, tree, carry=("__own", "__text"))
    value = {c: F.col("__text") if c == text_col else F.col("__own").getField(c) for c in own}
    out = rows.select(F.col(id_col).alias(f"document_{id_col}" if id_col in names else id_col), *[v.alias(f"document_{c}" if c in names else c) for c, v in value.items()], *names)
    file = F.floor(F.col("slot") / rows_in_file)
    out.repartition("shard", file).sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
