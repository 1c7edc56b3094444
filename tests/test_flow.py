"""The whole way to like items, labels, and overwrites that are cut short."""

import datetime

import pytest
from pyspark.sql import functions as F

from brindle.functions import names
from brindle.operators import cluster, flow, incremental, likeitems
from brindle.operators import impute


def test_labels_and_file_names():
    assert names.label("cat__game_type___missing__") == "game type missing"
    assert names.label("token__gold") == "gold" and names.label("bool__is_wap") == "is wap" and names.label("cat__x_cat__y") == "x cat  y" and len(names.label("x" * 90)) == 68
    assert names.file_name(" A/B: c.png ") == "a_b_c_png" and names.file_name("___") == "item" and len(names.file_name("y" * 99)) == 80


def test_a_group_counts_as_the_row_then_has_it(spark):
    rows = [(1, "b1", None, None), (2, "b1", "t1", "s9"), (3, "b1", "t1", None), (4, "b2", "t1", "s9"), (5, "b3", None, None)]
    df = spark.createDataFrame([(k, b, t, s if k != 2 else None) for k, b, t, s in rows], "k int, b string, t string, s string")
    late = {r["k"]: r["s"] for r in impute.impute_by_groups(df, ["s", "t"], ["b", "t"]).collect()}
    soon = {r["k"]: r["s"] for r in impute.impute_by_groups(df, ["t", "s"], ["b", "t"]).collect()}
    assert late[1] is None and soon[1] == "s9" and late[5] is None and soon[5] is None and late[3] == soon[3] == "s9"


def test_age_is_at_least_zero(spark):
    df = spark.createDataFrame([(datetime.date(2024, 5, 1),), (None,), (datetime.date(2023, 5, 1),)], "d date")
    got = likeitems.with_age(df, "d", datetime.date(2024, 1, 1)).orderBy(F.asc_nulls_last("d")).collect()
    assert [r["release_age_months"] for r in got] == [8, 0, None] and got[2]["release_age_bucket"] == "unknown_age"


def test_an_overwrite_cut_short_loses_nothing(spark, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS swap_me")
    spark.range(3).write.saveAsTable("swap_me")
    real = incremental.write_table

    def fails(df, name, *rest):
        real(df.limit(1), name, *rest)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(incremental, "write_table", fails)
    with pytest.raises(RuntimeError):
        incremental.stage_overwrite(spark.table("swap_me").union(spark.range(3)), "swap_me")
    assert spark.table("swap_me").count() == 3
    monkeypatch.setattr(incremental, "write_table", real)
    spark.sql("ALTER TABLE swap_me RENAME TO swap_me__before")  # as after the first of the two renames
    assert incremental.restore_overwrite(spark, "swap_me") and spark.table("swap_me").count() == 3
    incremental.stage_overwrite(spark.table("swap_me").union(spark.range(3)), "swap_me")
    assert spark.table("swap_me").count() == 6 and not incremental.restore_overwrite(spark, "swap_me")
    spark.sql("DROP TABLE swap_me")


def test_the_whole_way(spark):
    rows = [(f"p{i}", datetime.date(2020, 1, 1) + datetime.timedelta(days=i), "abc"[i % 3], i % 2 == 0, float(i % 7), f"gold dragon {'wolf' if i % 3 else 'pirate'}") for i in range(40)]
    df = spark.createDataFrame(rows, "pid string, d date, game_type string, is_wap boolean, bet double, theme_name string")
    out = flow.find_like_items(df, "pid", "d", {"game_type": 1.5}, {"is_wap": 1.0}, {"bet": 0.5}, ("theme_name",), k=4)
    profiles = {r["profile_id"]: r for r in out["profiles"].collect()}
    assert {p for p, r in profiles.items() if r["role"] == likeitems.HOLDOUT} == {"p36", "p37", "p38", "p39"}
    mapping = out["mapping"].collect()
    assert len(out["mapping"].columns) == 31 and {r["target_profile_id"] for r in mapping} == {"p36", "p37", "p38", "p39"}
    assert all(r["target_game_type"] == profiles[r["target_profile_id"]]["game_type"] and r["like_release_date"] == profiles[r["like_profile_id"]]["d"] for r in mapping)
    assert all(profiles[r["like_profile_id"]]["role"] == likeitems.HISTORICAL for r in mapping)
    grouped = out["grouped"].collect()
    assert sum(r["n_like"] for r in grouped) == len(mapping)
    assert [r["best_similarity"] for r in grouped] == sorted((r["best_similarity"] for r in grouped), reverse=True)
    shown = out["summary"].collect()
    assert sum(r["profile_count"] for r in shown) == 40 and sum(r["holdout_count"] for r in shown) == 4
    assert all(r["top_distinguishing_features"] and "__" not in r["top_distinguishing_features"] for r in shown) and "top_game_type" in out["summary"].columns
    assert {r["requested_k"] for r in out["elbow"].collect()} == set(range(2, 17))


def test_weighted_clusters_ignore_what_has_no_weight(spark):
    rows = [(i, f, v) for i, x in enumerate((0.0, 0.1, 5.0, 5.1)) for f, v in (("x", x), ("noise", float(i % 2 * 100)))]
    long = spark.createDataFrame(rows, "id long, feature string, value double")
    got = {r["id"]: r["cluster"] for r in cluster.weighted_clusters(long, {"x": 1.0, "noise": 0.0, "absent": 2.0}, 2).collect()}
    assert got[0] == got[1] != got[2] == got[3]
