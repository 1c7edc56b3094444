"""What only the operators' own results said so far: held-out rows, rejection, and shards, computed again in Python."""

import hashlib
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from brindle.llm import languages, quality, sharding
from brindle.llm.oracle import OP7

SF = "/root/testdata/sf0.001"


def test_held_out_rows_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(10_000 + i, t, None) for i, t in enumerate(["Ωξψ фжщ ьъы " * 20, "qzx wvk jjq xxz " * 20, "のはがをに" * 30])], docs.schema)
    rows = {r["doc_id"]: r for r in languages.identify_languages(docs.unionByName(strange)).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    truth = {r["doc_id"]: r["lang"] for r in docs.where("lang IS NOT NULL AND length(text) > 200").collect()}
    held = [rows[i] for i in truth if rows[i]["held_out"]]
    assert sum(r["accepted"] for r in held) >= 0.9 * len(held)
    wrong = [r for r in held if r["accepted"] and r["lang_pred"] != truth[r["doc_id"]]]
    assert len(wrong) <= 0.05 * len(held)
    assert max(rows[10_000 + i]["score"] for i in range(3)) < np.mean([r["score"] for r in held])


def shard_by_hand(key, tree):
    """The winner of each level's draws: the least -ln(u) / weight, u from md5 of the child's path and the key."""

    def draw(path, weight):
        bits = int(hashlib.md5(f"{path}\x00{key}".encode()).hexdigest()[:13], 16)
        return -math.log((bits + 0.5) / (1 << 52)) / weight

    path, leaves = "", list(tree)
    for name in ("region", "rack", "shard"):
        groups = {}
        for x in leaves:
            groups.setdefault(f"{path}/{getattr(x, name)}", []).append(x)
        path = min(groups, key=lambda p: draw(p, sum(x.weight for x in groups[p])))
        leaves = groups[path]
    return leaves[0].shard


def test_shards_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tree = sharding.even_tree()
    for r in sharding.shard_documents(docs).collect():
        assert (r["shard"], r["grown_shard"]) == (shard_by_hand(str(r["doc_id"]), tree), shard_by_hand(str(r["doc_id"]), sharding.grow(tree)))


def test_quality_sql_has_the_rule_of_the_operator(spark):
    """Clean prose in another script with one acronym, and texts that shout, by SQL as by the operator."""
    import duckdb

    greek = "Το κείμενο αυτό είναι καθαρό και μιλά για το NATO σήμερα μαζί με άλλα πολλά πράγματα που δεν έχουν σχέση μεταξύ τους αλλά γεμίζουν χώρο "
    texts = [greek + " ".join(f"λέξη{i}ω" for i in range(60)), " ".join(f"LOUD{i}WORDS" for i in range(80)), " ".join(f"half{i} HALF{i}A" for i in range(60))]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = dict(con.execute(f"SELECT doc_id, kept FROM ({OP7})").fetchall())
    rows = quality.quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["kept"] for r in rows.collect()} == want
    assert want[0] and not want[1]
