"""Merges that rewrite the files they touch: as the plain upsert, in proportion, and whole wherever a run ends."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from brindle.operators import clean, incremental, joins, versioned

T = datetime.datetime


class Ended(Exception):
    pass


@pytest.fixture
def name(spark):
    versioned.drop(spark, "v_t")
    yield "v_t"
    spark.sql("DROP TABLE IF EXISTS v_t__before")
    if spark.catalog.tableExists("v_t") and not versioned.is_versioned(spark, "v_t"):
        spark.sql("DROP TABLE v_t")
    versioned.drop(spark, "v_t"), versioned.drop(spark, "v_t__staged"), spark.sql("DROP TABLE IF EXISTS v_log")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def bytes_of(spark, name, names):
    listed = versioned._listed(spark, versioned._folder(spark, versioned.current(spark, name)[0]))
    return sum(os.path.getsize(listed[n].removeprefix("file:")) for n in names)


def test_merges_as_the_upsert_does(spark, name):
    target = spark.createDataFrame([(None, "g", "old", 1), (2, "g", "old", 2), (3, None, "old", 3), (4, "it's", "old", 4)], "k int, g string, v string, `w x` int")
    source = spark.createDataFrame([(None, "g", None, 9), (3, None, "new", None), (5, "g", "ins", 5)], target.schema)
    versioned.replace(target, name, ["k", "g"])
    assert rows_of(spark.table(name)) == rows_of(target)
    for updates in (["v", "w x"], ["v"]):
        want = rows_of(joins.upsert(spark.table(name), source, ["k", "g"], updates))
        versioned.merge(source, name, ["k", "g"], updates)
        assert rows_of(spark.table(name)) == want
    versioned.merge(source.limit(0), name, ["k", "g"], ["v"])
    assert rows_of(spark.table(name)) == want


def test_may_read_what_it_replaces(spark, name):
    versioned.replace(spark.range(1000).select("id", F.lit("a").alias("v")), name, ["id"])
    versioned.replace(spark.table(name).where("id % 2 = 0").withColumn("w", F.lit(1)), name, ["id"])
    assert spark.table(name).columns == ["id", "v", "w"] and spark.table(name).count() == 500
    assert versioned.sweep(spark, name) == 1  # the table of the last generation
    assert spark.table(name).count() == 500


def test_bytes_in_proportion(spark, name):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        versioned.replace(spark.range(100_000).select("id", F.md5(F.col("id").cast("string")).alias("v")), name, ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    _, before = versioned.current(spark, name)
    whole = bytes_of(spark, name, before)
    done = versioned.merge(spark.range(50_200, 50_700).select("id", F.lit("new").alias("v")), name, ["id"], ["v"])
    _, after = versioned.current(spark, name)
    assert len(before) == 100 and done["rewritten"] <= 2 and len(set(before) & set(after)) >= 98
    assert bytes_of(spark, name, set(after) - set(before)) <= 0.025 * whole
    assert spark.table(name).count() == 100_000 and spark.table(name).where("v = 'new'").count() == 500
    assert versioned.sweep(spark, name) == done["rewritten"]  # the files of the last version
    assert spark.table(name).count() == 100_000


@pytest.mark.parametrize("step", ["_write_files", "_commit", "sweep"])
@pytest.mark.parametrize("done", [False, True])
def test_ended_at_any_step(spark, name, monkeypatch, step, done):
    """Through the incremental upsert: a run that ends before or after each step leaves a whole version, and the next run makes it good."""
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string, ts timestamp")
    run = lambda rows: incremental.incremental_upsert(frame(rows), name, "k", "ts", "v_log")
    first = [(i, "old", T(2024, 1, 1)) for i in range(100)]
    batch = [(i, "new", T(2024, 2, 1)) for i in range(95, 105)]
    assert run(first)["operation"] == "create"
    real = getattr(versioned, step)

    def fails(*args, **more):
        if done:
            real(*args, **more)
        raise Ended

    monkeypatch.setattr(versioned, step, fails)
    with pytest.raises(Ended):
        run(batch)
    now = rows_of(spark.table(name).select("k", "v"))
    old, new = sorted(((i, "old") for i in range(100)), key=str), sorted(((i, "new" if i >= 95 else "old") for i in range(105)), key=str)
    assert now == (new if step == "_commit" and done else old)
    monkeypatch.setattr(versioned, step, real)
    assert run(batch)["operation"] == "merge" and rows_of(spark.table(name).select("k", "v")) == new
    assert run(batch)["operation"] == "skip"


@pytest.mark.parametrize("ends", ["rename", "view", "drop", None])
def test_a_plain_table_becomes_versioned(spark, name, monkeypatch, ends):
    """An older, plain target: a run that ends between the renames loses nothing either."""
    run = lambda: incremental.incremental_upsert(spark.createDataFrame([(i, "new", T(2024, 2, 1)) for i in range(95, 105)], "k int, v string, ts timestamp"), name, "k", "ts", "v_log")
    spark.createDataFrame([(i, "old", T(2024, 1, 1)) for i in range(100)], "k int, v string, ts timestamp").write.saveAsTable(name)
    if ends:
        sql, adopt = type(spark).sql, versioned.adopt

        def cut(self, text, *more, **kw):
            if ends == "rename" and "RENAME TO" in text and "__before" in text or ends == "drop" and text.startswith("DROP TABLE IF EXISTS `v_t__before`"):
                raise Ended
            return sql(self, text, *more, **kw)

        monkeypatch.setattr(type(spark), "sql", cut)
        if ends == "view":
            monkeypatch.setattr(versioned, "adopt", lambda *a: (_ for _ in ()).throw(Ended()))
        with pytest.raises(Ended):
            run()
        monkeypatch.setattr(type(spark), "sql", sql)
        monkeypatch.setattr(versioned, "adopt", adopt)
        assert incremental.target_exists(spark, name)
        assert spark.table(name).count() == (105 if ends == "drop" else 100)
    assert run()["operation"] == "merge" and spark.table(name).count() == 105 and versioned.is_versioned(spark, name)
    assert spark.table(name).where("v = 'new'").count() == 10 and not spark.catalog.tableExists(f"{name}__before")


@pytest.mark.parametrize("parts", [2, 8, 200])
def test_dense_ids_have_no_gap(spark, parts):
    """A million rows, with ties that span a tenth of them: ids from 0 without a gap, in order."""
    n = 1_000_000
    df = spark.range(n).select((F.xxhash64("id") % 1000).alias("a"), F.when(F.col("id") % 10 != 0, F.col("id")).alias("b"))
    out = clean.dense_ids(df, [F.col("a").desc(), F.col("b").asc_nulls_last()], "i", parts)
    row = out.agg(F.count(F.lit(1)), F.count_distinct("i"), F.min("i"), F.max("i")).first()
    assert tuple(row) == (n, n, 0, n - 1)
    b = F.coalesce("b", F.lit(n))
    pairs = out.select("a", b.alias("b"), "i").alias("x").join(out.select("a", b.alias("b"), (F.col("i") - 1).alias("i")).alias("y"), "i")
    assert pairs.where("x.a < y.a OR x.a = y.a AND x.b > y.b").count() == 0


def test_dense_ids_of_nothing(spark):
    assert clean.dense_ids(spark.range(0), [F.col("id")]).count() == 0
