"""Upserts, marks, outcomes, and the stream that replaces a mark by a checkpoint."""

import datetime

import pytest
from pyspark.sql import functions as F

from brindle.operators import incremental, joins, versioned
from brindle.streaming.upsert import stream_upsert

T = datetime.datetime
SCHEMA = "k int, g string, v string, w int, ts timestamp"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def values(df):
    return sorted(tuple(r) for r in df.select("k", "v", "w").na.fill({"k": -1, "v": "-", "w": -1}).collect())


def test_upsert_matches_null_keys_and_overwrites_with_nulls(spark):
    target = frame(spark, [(None, "g", "old", 1, None), (2, "g", "old", 2, None), (3, None, "old", 3, None)])
    source = frame(spark, [(None, "g", None, 9, None), (3, None, "new", None, None), (4, "g", "ins", 4, None)])
    out = joins.upsert(target, source, ["K", "g"])
    assert values(out) == [(-1, "-", 9), (2, "old", 2), (3, "new", -1), (4, "ins", 4)]
    assert values(joins.upsert(out, source, ["k", "g"])) == values(out)
    assert values(joins.upsert(target, source, ["k", "g"], "v")) == [(-1, "-", 1), (2, "old", 2), (3, "new", 3), (4, "ins", 4)]
    with pytest.raises(ValueError, match="key"):
        joins.upsert(target, source, [])


def test_latest_row_has_a_stable_tie(spark):
    rows = [(1, "a", "x", 1, T(2024, 1, 1)), (1, "a", "y", 2, T(2024, 1, 1)), (1, "a", "z", 3, None), (2, "a", "n", 4, None)]
    a = incremental.dedup_latest(frame(spark, rows), ["k"], "ts").collect()
    b = incremental.dedup_latest(frame(spark, rows[::-1]).repartition(3), ["k"], "ts").collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 2 and all(r["v"] != "z" for r in a)


def test_outcomes(spark):
    versioned.drop(spark, "t_out"), spark.sql("DROP TABLE IF EXISTS t_log")
    run = lambda rows, **more: incremental.incremental_upsert(frame(spark, rows), "t_out", "k", "ts", "t_log", **more)
    first = [(1, "a", "x", 1, T(2024, 1, 1)), (2, "a", "x", 1, None), (1, "a", "older", 0, T(2023, 1, 1))]
    assert run(first)["operation"] == "create"
    assert spark.table("t_out").count() == 2
    assert run([(3, "a", "late", 1, T(2024, 1, 1)), (4, "a", "null", 1, None)])["operation"] == "skip"
    assert spark.table("t_log").count() == 1
    assert run([(1, "a", "newer", 2, T(2024, 2, 1)), (5, "a", "y", 1, T(2024, 2, 2))])["operation"] == "merge"
    assert {r["v"] for r in spark.table("t_out").collect()} == {"x", "newer", "y"}
    assert incremental.read_mark(spark, "t_log", "t_out", "ts") == T(2024, 2, 2)
    assert run([(9, "a", "only", 1, T(2020, 1, 1))], full_refresh=True)["operation"] == "full_refresh"
    assert spark.table("t_out").count() == 1
    assert not incremental.append_mark(spark, "t_log", "j", "ts", None, None, "t_out", 0, "merge")
    versioned.drop(spark, "t_out"), spark.sql("DROP TABLE t_log")


def test_stream_merges_what_is_new_and_restarts(spark, tmp_path):
    versioned.drop(spark, "t_stream")
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    run = lambda: stream_upsert(spark.readStream.schema(SCHEMA).parquet(source), "t_stream", "k", "ts", checkpoint)
    frame(spark, [(1, "a", "x", 1, T(2024, 1, 2)), (2, "a", "x", 1, T(2024, 1, 1))]).write.parquet(source)
    run()
    frame(spark, [(2, "a", "late", 2, T(2023, 1, 1)), (3, "a", "new", 3, T(2024, 1, 3))]).write.mode("append").parquet(source)
    run(), run()
    assert values(spark.table("t_stream")) == [(1, "x", 1), (2, "late", 2), (3, "new", 3)]
    versioned.drop(spark, "t_stream")


def test_full_join_is_hashed(spark):
    a, b = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v")), spark.range(10).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    plan = joins.upsert(a, b, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
