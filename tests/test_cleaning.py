"""Hand-made dirty rows, a case a trap."""

import datetime

import pytest
from pyspark.sql import functions as F

from brindle.functions import arrays, names, scalars
from brindle.operators import aggregate, clean, expand, impute


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr.alias("x")).orderBy("i").select("x").collect()]


def test_numbers(spark):
    got = one(spark, ["1,234.5", " 12% ", "(5)", "$5", "NaN", None], scalars.parse_number("v"))
    assert got[:4] == [1234.5, 12.0, None, None] and got[4] != got[4] and got[5] is None
    assert one(spark, ["$1,5"], scalars.parse_number("v", currency=True)) == [15.0]


def test_text(spark):
    values = [" ABC ", "123", "1.5", "-5", "1,234", "Unknown", None]
    assert one(spark, values, scalars.clean_text("v", ("unknown",))) == ["abc", None, None, "-5", "1,234", None, None]
    assert one(spark, values, scalars.clean_text("v", ("unknown",), recheck=False))[5] == "unknown"


def test_dates(spark):
    d = datetime.date
    assert one(spark, ["2024-01", "01/15/2024", None], scalars.parse_date("v")) == [d(2024, 1, 1), None, None]
    assert one(spark, ["202401", "01/15/2024"], scalars.parse_date("v", "yyyyMM")) == [d(2024, 1, 1), None]


def test_rules(spark):
    own = scalars.ownership("v", ("owned",), ("leased", "not owned"), ("leas", "cap"), ("own",))
    assert one(spark, ["Not Owned", "leased-own", "Unknown", "capital", None], own) == ["leased", "leased", "owned", "leased", None]
    assert one(spark, [None, " KEY ", "Else"], scalars.lookup("v", {"key": "mapped"})) == [None, "mapped", "else"]
    assert one(spark, ["Foo?", "no match", None, "Bar"], scalars.correction("v", F.lit("X"))) == ["no_match", "no_match", "x", "bar"]


def test_fill_keeps_nan_unless_asked(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (None, 2.0)], "a double, b double")
    got = [r["a"] for r in clean.fill_from(df, {"a": ["b"]}).collect()]
    assert got[0] != got[0] and got[1] == 2.0
    assert [r["a"] for r in clean.fill_from(df, {"a": ["b"]}, nan_is_null=True).collect()] == [1.0, 2.0]


def test_lists(spark):
    values = ["['A', 'B']", '["P\'s"]', "[]", None, '["a", null]']
    assert one(spark, values, arrays.parse_list("v")) == [["A", "B"], ["P's"], [], [], ["a", None]]
    with pytest.raises(Exception, match="not a list"):
        one(spark, ["oops"], arrays.parse_list("v"))
    assert one(spark, values, arrays.has_value(arrays.parse_list("v"), "B")) == [True, False, False, False, False]
    assert one(spark, ["a;A; b"], arrays.join_distinct(arrays.lenient_list("v"))) == ["a | b"]


def test_names(spark):
    assert names.flag_names("p", ["A&B", "a b", "!!"]) == {"A&B": "p_a_b", "a b": "p_a_b_2", "!!": "p_blank"}
    assert names.standardize_name(" A&B c-d/e ") == "ab_c_d_e" and names.snake_name("A&B") == "a_b"
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert names.rename(df, {"a": "b", "b": "a"}).columns == ["b", "a"]
    with pytest.raises(ValueError, match="duplicate"):
        names.rename(spark.createDataFrame([(1, 2)], ["X y", "x_y"]))
    with pytest.raises(ValueError, match="missing"):
        clean.lower_only(df, ["zzz"])
    with pytest.raises(ValueError, match="zzz"):
        clean.apply_filters(df, {"zzz": 1})


def test_months_and_age(spark):
    d = datetime.date
    df = spark.createDataFrame([(d(2023, 12, 31), d(2024, 3, 1))], "a date, b date")
    assert df.select(scalars.calendar_months(F.col("a"), F.col("b"))).first()[0] == 3
    assert one(spark, [None, 5, 6, 84], scalars.age_bucket("v"), "int") == ["unknown_age", "0_5_months", "6_11_months", "84_plus_months"]


def test_mode_takes_the_lowest_in_natural_order(spark):
    df = spark.createDataFrame([("g", v) for v in (9, 9, 10, 10)] + [(None, 3), ("h", None)], "g string, v int")
    assert [tuple(r) for r in aggregate.modes(df, ["g"], "v").collect()] == [("g", 9)]


def test_imputation_sources_differ(spark):
    rows = [("x", "p", 1), ("x", "p", 1), ("x", "q", 2), ("x", "q", None), ("x", "r", None), (None, "p", None), (None, "z", 7)]
    df = spark.createDataFrame(rows, "a string, b string, v int")
    by_groups = impute.impute_by_groups(df, ["v"], ["b", "a"]).collect()
    filled, counts = impute.impute_by_hierarchy(df, "v", ["a", "b"])
    assert sorted(map(str, by_groups)) != sorted(map(str, filled.collect()))
    assert [c["filled"] for c in counts] == [1, 2]
    for out in (by_groups, filled.collect()):
        kept = [r for r in rows if r[2] is not None]
        assert all(out.count(tuple(r)) >= kept.count(r) for r in kept)


def test_missing_summary_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b double")
    assert [(r["missing_count"], r["missing_percent"]) for r in aggregate.missing_summary(df).collect()] == [(0, 0.0), (0, 0.0)]
    assert clean.drop_all_null(df).columns == ["a", "b"] and aggregate.null_percentages(df).first()["a"] is None


def test_flags_never_null_and_rows_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, c string")
    wide = expand.one_hot_wide(df, "c").collect()
    assert [r["cat__c_a"] + r["cat__c_b"] for r in sorted(wide)] == [1, 1, 0]
    with pytest.raises(ValueError):
        expand.MOST_COLUMNS, old = 1, expand.MOST_COLUMNS
        try:
            expand.one_hot_wide(df, "c")
        finally:
            expand.MOST_COLUMNS = old


def test_dense_ids_in_order(spark):
    df = spark.range(500).selectExpr("(id * 37) % 500 AS v")
    got = {r["v"]: r["profile_id"] for r in clean.dense_ids(df, [F.desc("v")]).collect()}
    assert got == {v: 499 - v for v in range(500)}
