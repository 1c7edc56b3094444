"""Every registered query over the smallest tables against its SQL."""

import duckdb
import pytest

from brindle.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return None if v is None or v != v else round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = [r.asDict() for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    if name in registry.oracle_sql():
        want = duck.execute(registry.oracle_sql()[name])
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(df.columns)
        rows = [dict(zip(names, r)) for r in want.fetchall()]
        key = lambda r: str([plain(r[c]) for c in sorted(names)])
        assert sorted(map(key, got)) == sorted(map(key, rows))


def test_entry_imports_without_training_data_modules(spark):
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
