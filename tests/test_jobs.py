"""Whole jobs, each started from a configuration file."""

import datetime
import json

import pytest
import yaml

from brindle import jobs
from brindle.operators import versioned

T = datetime.datetime


def config_file(tmp_path, settings):
    path = tmp_path / "config" / "job.yml"
    path.parent.mkdir(exist_ok=True)
    path.write_text(yaml.safe_dump(settings))
    return str(path)


def run(spark, tmp_path, job, settings, *more):
    return jobs.main([job, "--config", config_file(tmp_path, settings), "--env-file", str(tmp_path / "none"), *more], spark)


def table(spark, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").saveAsTable(name)


def drop(spark, *names):
    for n in names:
        versioned.drop(spark, n)
        spark.sql(f"DROP TABLE IF EXISTS {n}")


RAW = "`Game Name` string, `Own-Status` string, supplier string, slots string, spare string, released string, region string, ts timestamp"
CLEAN = {
    "source": {"table": "j_raw", "filters": {"region": "us"}},
    "output": {"table": "j_clean", "format": "parquet"},
    "incremental": {"enabled": True, "watermark_column": "ts", "watermark_table": "j_log", "key_columns": ["game_name"]},
    "cleaning": {"numeric_cols": ["slots", "absent"], "string_cols": ["game_name"], "date_cols": ["released"], "missing_tokens": ["-", "N/A"], "typo_maps": {"game_name": {"bufalo": "buffalo", "buffalo": "bison"}}},
    "complementary_columns": {"slots": ["spare"]},
    "drop_complementary_fallbacks": True,
    "supplier": {"column": "supplier", "map": {"SGI": "light & wonder"}},
    "ownership_mapping": {"input_col": "own_status", "owned_exact": ["O"], "leased_exact": ["n"], "owned_contains": ["own"], "leased_contains": ["%"]},
    "diagnostics": {"ownership_counts_column": "own_status"},
}


def test_clean_creates_skips_merges_and_logs(spark, tmp_path):
    drop(spark, "j_raw", "j_clean", "j_log")
    rows = [
        (" Bufalo ", "O", "sgi ", "1,200", None, "2024-01-05", "us", T(2024, 1, 1)),
        ("Buffalo", "20% net", "Other", "-", "7", "soon", "us", T(2024, 1, 2)),
        ("Dragon", "N/A", None, "N/A", None, None, "us", T(2024, 1, 2)),
        ("Gone", "o", "sgi", "1", None, None, "eu", T(2025, 1, 2)),
    ]
    table(spark, "j_raw", rows, RAW)
    seen = run(spark, tmp_path, "clean", CLEAN, "--no-write")
    assert (seen["operation"], seen["rows"], seen["new_mark"]) == ("no_write", 3, T(2024, 1, 2)) and not spark.catalog.tableExists("j_clean")
    first = run(spark, tmp_path, "clean", CLEAN | {"manifest_path": str(tmp_path / "log.json")})
    assert (first["operation"], first["rows"], first["previous_mark"]) == ("create", 3, None)
    assert json.loads((tmp_path / "log.json").read_text())["new_mark"].startswith("2024-01-02")
    got = {r["game_name"]: r for r in spark.table("j_clean").collect()}
    assert set(got) == {"buffalo", "bison", "dragon"} and "spare" not in got["dragon"]
    facts = lambda r: (float(r["slots"]), r["supplier"], r["own_status"], r["released"])
    assert facts(got["buffalo"]) == (1200.0, "light & wonder", "owned", datetime.date(2024, 1, 5))
    assert facts(got["bison"]) == (7.0, "other", "leased", None)
    assert got["dragon"]["slots"] is None and got["dragon"]["supplier"] is None and got["dragon"]["own_status"] is None
    assert {r["own_status"]: r["count"] for r in first["ownership"].collect()} == {"owned": 1, "leased": 1, None: 1}
    assert {r["column_name"]: r["missing_count"] for r in first["missing"].collect()}["supplier"] == 1
    assert run(spark, tmp_path, "clean", CLEAN)["operation"] == "skip"
    table(spark, "j_raw", [*rows, ("DRAGON", "own it", "sgi", "3", None, None, "us", T(2024, 2, 1)), ("Late", "o", None, "1", None, None, "us", T(2023, 1, 1))], RAW)
    later = run(spark, tmp_path, "clean", CLEAN)
    assert (later["operation"], later["rows"], later["previous_mark"], later["new_mark"]) == ("merge", 1, T(2024, 1, 2), T(2024, 2, 1))
    got = {r["game_name"]: r["own_status"] for r in spark.table("j_clean").collect()}
    assert got == {"buffalo": "owned", "bison": "leased", "dragon": "owned"}
    assert run(spark, tmp_path, "clean", CLEAN, "--full-refresh")["operation"] == "full_refresh"
    assert {r["game_name"] for r in spark.table("j_clean").collect()} == {"buffalo", "bison", "dragon", "late"}
    assert [r["operation"] for r in spark.table("j_log").orderBy("updated_at").collect()] == ["create", "merge", "full_refresh"]
    drop(spark, "j_raw", "j_clean", "j_log")


def test_clean_without_marks_refreshes_in_full(spark, tmp_path):
    drop(spark, "j_raw", "j_clean")
    table(spark, "j_raw", [("A", "o", "s", "1", None, None, "us", None)] * 3, RAW)
    out = run(spark, tmp_path, "clean", CLEAN | {"incremental": {}})
    assert (out["operation"], out["rows"], spark.table("j_clean").count()) == ("full_refresh", 3, 3)
    with pytest.raises(ValueError, match="source.table"):
        run(spark, tmp_path, "clean", CLEAN | {"source": {}})
    with pytest.raises(ValueError, match="output.table"):
        run(spark, tmp_path, "clean", CLEAN | {"output": {}})
    with pytest.raises(ValueError, match="watermark"):
        run(spark, tmp_path, "clean", CLEAN | {"incremental": {"enabled": True}})
    drop(spark, "j_raw", "j_clean")


def test_attributes(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,kind,theme,empty,old,list\n1,a,x,-,1,\"['p', 'q r']\"\n2,a,x,,1,null\n3,a, - ,,1,['p']\n4,b,null,,1,\n")
    settings = {"input_path": "in.csv", "null_strings": ["-", ""], "explicit_drop_columns": ["old", "absent"], "list_column": "list", "impute_columns": ["theme"], "impute_groups": ["kind", "absent"], "output_path": "ignored", "output_format": "parquet"}
    out = run(spark, tmp_path, "clean_attributes", settings, "--set", f"output_path={tmp_path}/out")
    assert (out["rows"], out["columns"], out["dropped_columns"]) == (4, 6, ["empty", "old"])
    assert out["flags"] == {"p": "list_p", "q r": "list_q_r"} and out["remaining_nulls"] == {"theme": 1} and out["output"] == f"{tmp_path}/out"
    got = sorted((r["id"], r["theme"], r["list_p"], r["list_q_r"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, "x", True, True), (2, "x", False, False), (3, "x", True, False), (4, None, False, False)]


def test_aggregate_reports_excluded_rows(spark, tmp_path):
    rows = [("g", 1, 10.0, 1.0), ("g", 3, 20.0, 2.0), ("g", 9, 99.0, 9.0), ("h", 1, 5.0, 4.0)]
    spark.createDataFrame(rows, "game string, slots int, idx double, win double").write.parquet(f"{tmp_path}/in")
    settings = {"input_path": f"{tmp_path}/in", "input_format": "parquet", "group_columns": ["game"], "weight_column": "slots", "weighted_columns": ["idx"], "sum_columns": ["win"], "exclude": "idx > 50", "order_column": "slots", "output_path": f"{tmp_path}/out", "output_format": "parquet", "report_dir": f"{tmp_path}/report"}
    out = run(spark, tmp_path, "aggregate", settings | {"manifest_path": str(tmp_path / "m.json")})
    assert out["rows"] == 2 and json.loads((tmp_path / "m.json").read_text())["group_columns"] == ["game"]
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("game", "idx_mean", "win_sum").collect())) == [("g", 17.5, 3.0), ("h", 5.0, 4.0)]
    assert [tuple(r) for r in spark.read.csv(out["report"], header=True, inferSchema=True).collect()] == [("g", 1)]


def test_join_counts_matches(spark, tmp_path):
    def source(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
        return {"input_path": f"{tmp_path}/{name}", "input_format": "parquet"}

    inputs = {
        "performance": source("p", [("g", "c", 1), ("g", "c", 2), ("h", "c", 3), ("i", None, 4)], "game string, cabinet string, v int"),
        "mapping": source("m", [("g", "c", "Big Win"), ("g", "c", "Big Win"), ("h", "c", "other")], "game string, cabinet string, theme string"),
        "attributes": source("a", [(" big  win", 7)], "theme string, key int"),
        "sales": source("s", [(7, 2.0), (7, 3.0)], "key int, amount double"),
    }
    settings = {"inputs": inputs, "game_column": "game", "cabinet_column": "cabinet", "theme_column": "theme", "theme_key": "key", "sales_column": "amount", "output_path": f"{tmp_path}/out", "output_format": "parquet"}
    out = run(spark, tmp_path, "join", settings)
    assert {k: out[k] for k in ("rows", "input_rows", "retention", "with_theme", "with_attributes", "with_sales")} == {"rows": 4, "input_rows": 4, "retention": 1.0, "with_theme": 3, "with_attributes": 2, "with_sales": 2}


def test_raw_tables(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Game,Cabinet,Supplier,Kind\nA,c1,x,k\nA,c1,x,k\nA,c1,y,\nA,c2,,k\nB,c9,z,\n")
    settings = {"input_path": "in.csv", "cleaning": {"string_cols": ["game", "cabinet"]}, "supplier": {"column": "supplier", "cabinet_column": "cabinet", "game_column": "game"}, "cabinet_supplier_map": {"C9": "mapped"}, "supplier_consistency_validation": True, "majority_supplier_per_game": True, "impute": {"kind": ["game"]}, "output_path": f"{tmp_path}/out", "output_format": "parquet", "report_dir": f"{tmp_path}/report"}
    out = run(spark, tmp_path, "clean_raw", settings)
    assert out["rows"] == 5 and out["filled"] == {"kind": [{"keys": ["game"], "filled": 1}]}
    got = sorted((r["game"], r["cabinet"], r["supplier"], r["kind"] or "") for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("a", "c1", "x", "k"), ("a", "c1", "x", "k"), ("a", "c1", "x", "k"), ("a", "c2", "x", "k"), ("b", "c9", "mapped", "")]
    assert spark.read.csv(out["report"], header=True).count() == 2
    tables = run(spark, tmp_path, "clean_tables", {"tables": {"one": {"input_path": str(tmp_path / "in.csv"), "filters": {"Game": "A"}, "output_path": f"{tmp_path}/one", "output_format": "parquet"}, "two": {"input_path": str(tmp_path / "in.csv"), "columns": {"standardize": False}}}})
    assert spark.read.parquet(f"{tmp_path}/one").count() == 4 and tables["two"].columns == ["Game", "Cabinet", "Supplier", "Kind"]


def test_rank_of_settings(spark, tmp_path):
    path = config_file(tmp_path, {"input_path": "in.csv", "output_path": "/out", "write_mode": "append", "report_dir": "r"})
    env = {"BRINDLE_WRITE_MODE": "ignore", "BRINDLE_OUTPUT_PATH": "/env", "BRINDLE_REPORT_DIR": " "}
    out = jobs.job_config(path, {"output_path": "/given"}, {"output_path": "/params", "write_mode": ""}, env)
    assert out == {"input_path": str(tmp_path / "in.csv"), "output_path": "/given", "write_mode": "ignore", "report_dir": str(tmp_path / "r")}
    with pytest.raises(SystemExit):
        jobs.main(["clean", "--config", path, "--set", "nonsense=1"], spark)
    with pytest.raises(SystemExit):
        jobs.main(["join", "--config", path, "--full-refresh"], spark)


def test_cluster_job_writes_its_exports(spark, tmp_path):
    drop(spark, "j_attr", "j_rel")
    attributes = [(i, f"Game {i}", "abc"[i % 3], f"type {i % 4}", "['Bingo']" if i % 2 else None, "yes" if i % 5 else "no", f"20{10 + i % 12}-0{1 + i % 9}-01") for i in range(40)]
    table(spark, "j_attr", attributes, "theme_sk int, theme_name_friendly string, product_family string, game_type string, game_matrix string, is_wap string, na_release_date string")
    table(spark, "j_rel", [(f" game {i}", f"Old {i % 7}", "raw_exact" if i % 4 else "no_match", "0.9", "2009-05-01") for i in range(40)], "theme_name_friendly string, perf_game_name string, match_method string, match_score string, game_release_date string")
    settings = {
        "inputs": {"attributes": {"input_table": "j_attr"}, "relation": {"input_table": "j_rel"}}, "profiles": {"order": ["theme_sk"]}, "output_dir": str(tmp_path / "out"), "manifest_path": str(tmp_path / "m.json"),
        "clustering": {"categories": {"product_family": 1.5, "game_type": 1.0}, "booleans": {"is_wap": 0.5}, "selected_k": 4, "limit": 3, "floor": 0.02, "share_of_top": 0.5},
    }
    out = run(spark, tmp_path, "cluster", settings)
    said = json.loads((tmp_path / "m.json").read_text())
    assert said["profile_rows"] == 30 and said["holdout_profiles"] == 3 and said["historical_profiles"] == 27 and said["selected_clusters_setting"] == 4
    assert said["mapping_rows"] == sum(1 for _ in spark.read.csv(said["outputs"]["mapping"], header=True).collect()) <= 9
    names = {"profiles", "feature_matrix", "mapping", "grouped_mapping", "cluster_summary", "elbow_scores", "holdout_features"}
    assert set(said["outputs"]) == names and spark.read.csv(said["outputs"]["feature_matrix"], header=True).count() == 30
    assert {r["important_features"] is not None and r["cluster_description"] is not None for r in out["cluster_summary"].collect()} == {True}
    assert all(r["best_historical_game_name"] == f"old {r['theme_sk'] % 7}" and r["attr_matrix_token_bingo"] == r["theme_sk"] % 2 for r in out["profiles"].collect())
    settings["clustering"]["selected_k"] = 17
    with pytest.raises(ValueError, match="k = 17"):
        run(spark, tmp_path, "cluster", settings, "--no-write")
    drop(spark, "j_attr", "j_rel")
