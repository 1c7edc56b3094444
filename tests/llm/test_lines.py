"""Line dedup against brute force, at several numbers of batches and fanouts."""

import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from brindle.llm import lines
from brindle.llm.oracle import OP13

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, batch string, at string, own int, id string, n_chars long"


def odd_rows():
    common, other = "This is a line that many have", "A second line, found in many places"
    texts = [
        (1, f"{common}\nshort\nshort"), (2, f"  {common.upper()}\t\r\nTail of two"), (3, f"{common}\n{common}\n\n{other}"), (4, f"{other}\n{common}"),
        (None, f"{other}\nof a null id"), (None, f"{common}"), (5, None), (6, ""), (7, "\n\n"), (8, f"{other}\n" * 2000 + "end"),
        (9, "nineteen signs herè"), (10, "nineteen signs herè"), (11, "nineteen signs herè"), (12, "twenty signs are herè"), (13, "twenty signs are herè "), (13, "twenty signs are herè"),
        (14, "ÉTÉ est un mot à lettres"), (15, "été est un mot à lettres"), (16, "ÉTÉ EST UN MOT à LETTRES"), (17, "ÉTÉ est un mot à lettres\n"), (17, "ÉTÉ est un mot à lettres\n"),
    ]
    return [(i, t, "b", None, 7, "x", None) for i, t in texts] + [(i, f"{common}\nown line of document {i}", "b", "a", None, None, 3) for i in range(100, 160)]


def by_force(rows):
    holders, out = defaultdict(list), []
    split = [(t or "").encode().split(b"\n") for _, t in rows]
    for (i, _), ls in zip(rows, split):
        for key in {lines.line_key(x) for x in ls}:
            holders[key].append(i)
    for (i, _), ls in zip(rows, split):
        kept = []
        for x in ls:
            key = lines.line_key(x)
            top = max((h for h in holders[key] if h is not None), default=None)
            if len(key.decode()) < 20 or len(holders[key]) < 3 or i == top:
                kept.append(x)
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (6, 3), (7, 2)])
def test_by_force(odd, batches, fanout):
    assert got(lines.line_dedup(odd, batches=batches, fanout=fanout)) == by_force([(r[0], r[1]) for r in odd_rows()])


def test_documents_keep_their_columns(odd):
    out = lines.deduplicated_documents(odd)
    assert out.schema.names == odd.schema.names
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[3]["text"] == "" and rows[3]["n_chars"] == 0  # all four lines go
    assert rows[8]["n_chars"] is None and rows[8]["text"].endswith("places\nend")  # the largest id with the other line
    assert rows[5]["text"] is None and rows[159]["text"].startswith("This is a line")
    assert rows[1]["batch"] == "b" and rows[1]["own"] == 7 and rows[1]["id"] == "x"


def test_ids_that_are_texts(odd):
    rows = odd.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    want = [(None if i is None else str(i), t) for i, t, *_ in odd_rows()]
    assert got(lines.line_dedup(rows)) == by_force(want)


def test_empty_table(spark, odd):
    assert lines.line_dedup(odd.limit(0)).count() == 0


def test_levels_are_compacted_and_settled_lines_not_written_again(spark):
    folder = lines.scratch_folder(spark, "test")
    runs = lines.LineRuns(spark, folder, "bigint", 3, 2)
    rows = lambda *r: spark.createDataFrame(list(r), "h long, n int, top long")
    try:
        runs.add(rows((1, 3, 90), (2, 1, 91)))
        runs.add(rows((1, 2, 80), (2, 1, 85)))
        assert [len(x) for x in runs.levels] == [0, 1]
        assert {tuple(r) for r in spark.table(runs.levels[1][0][0]).collect()} == {(1, 3, 90), (2, 2, 91)}
        runs.add(rows((1, 3, 70), (2, 1, 75), (3, 1, 76)))
        assert {r["h"] for r in spark.table(runs.levels[0][0][0]).collect()} == {2, 3}  # line 1 was settled
        runs.add(rows((3, 1, 60)))
        assert [len(x) for x in runs.levels] == [0, 0, 1]
        assert {tuple(r) for r in runs.frequent().collect()} == {(1, 3, 90), (2, 3, 91)}
        plan = spark.table(runs.levels[2][0][0]).groupBy("h").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan  # runs are bucketed by the hash
    finally:
        runs.close()
        lines.remove_folder(spark, folder)


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({OP13})").fetchall(), key=str)
    rows = got(lines.line_dedup(spark.read.parquet(f"{SF}/documents.parquet")))
    assert rows == want and any(r[2] for r in rows)
