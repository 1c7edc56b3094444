"""Readers, writers and configuration."""

import json

import pytest

from brindle import config
from brindle.sources import readers, writers


def test_config(tmp_path, monkeypatch):
    monkeypatch.delenv("BRINDLE_X", raising=False)
    path = tmp_path / "config" / "a.yml"
    path.parent.mkdir()
    path.write_text('a: 1\ntokens:\n  - "#"\n')
    assert config.load_config(path) == {"a": 1, "tokens": ["#"]}
    with pytest.raises(FileNotFoundError):
        config.load_config(tmp_path / "none.yml")
    path.write_text("- 1\n")
    with pytest.raises(ValueError):
        config.load_config(path)
    assert config.merge_overrides({"a": 1, "b": 2}, {"a": " "}, {"a": 3, "b": None}, {"a": 4}) == {"a": 3, "b": 2}
    (tmp_path / ".env").write_text("# c\nBRINDLE_X='y'\n")
    assert config.load_env(tmp_path / ".env") == {"BRINDLE_X": "y"}
    assert config.project_root(path) == tmp_path and config.resolve_path(tmp_path, "b") == tmp_path / "b"


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x ""q"""\n2, NA \n3,null\n')
    path = str(tmp_path / "a.csv")
    assert [r["v"] for r in readers.read_csv(spark, path).collect()] == ['x "q"', " NA ", None]
    assert [r["v"] for r in readers.read_csv_tokens(spark, path, ["NA", "null"], ["v"]).collect()] == ['x "q"', None, None]
    assert readers.read_by_config(spark, {"input_path": path}).count() == 3
    with pytest.raises(ValueError, match="unknown input format"):
        readers.read_by_config(spark, {"input_path": path, "input_format": "exe"})
    (tmp_path / "u.txt").write_text("k\tv\n1\tĂ\n2\tb\n", encoding="utf-16")
    assert [r["v"] for r in readers.read_utf16(spark, str(tmp_path / "u.txt")).collect()] == ["Ă", "b"]
    assert not readers.table_exists(spark, "no_such_table")


def test_pushdown(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_orderkey > 5").select("o_custkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,5)]" in plan and "o_totalprice" not in plan


def test_writers(spark, tmp_path):
    df = spark.range(3)
    assert writers.write_by_config(df, {"output_path": str(tmp_path / "o"), "output_format": "csv"}) == str(tmp_path / "o")
    assert spark.read.option("header", "true").csv(str(tmp_path / "o")).count() == 3
    writers.write_by_config(df, {"output_table": "t_w", "output_mode": "merge"})
    assert spark.table("t_w").count() == 3
    spark.sql("DROP TABLE t_w")
    with pytest.raises(ValueError):
        writers.write_by_config(df, {"output_path": "x", "output_format": "a;b"})
    assert writers.write_report(df, None) is None and writers.write_report(df, str(tmp_path)).endswith("excluded_items_summary")
    assert writers.write_single_csv(df, str(tmp_path / "one.csv")) == 3
    with pytest.raises(ValueError):
        writers.write_single_csv(df, str(tmp_path / "one.csv"), most_rows=2)
    writers.write_manifest(str(tmp_path / "m.json"), df.selectExpr("count(*) AS rows"), path="p")
    assert json.loads((tmp_path / "m.json").read_text()) == {"rows": 3, "path": "p"}
