"""Parquet tables that change by rewriting the files that a merge touches, and nothing else.

The rows of a table `t` are in the files of a table `t__files_<generation>`; `t` itself is a view of the files of its version:

    CREATE OR REPLACE VIEW t AS SELECT ... FROM t__files_x WHERE _metadata.file_name IN (...)

Files are never changed. A merge finds the files that hold a key of the source, writes their rows, merged, to new files, and then
replaces the view: one change in the catalog, which is the whole commit. Before it, new files are in no version; after it, the
old ones are in none. So wherever a run ends, `t` is its old or its new version. The last version's files stay until
the next merge starts, for those who are reading it. Spark prunes files by name when it plans the scan.

A version is a name per file in the view's text; so files should be large (some 10,000 names are a text of 600 kB). One writer at a time.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.joins import all_of, upsert
from brindle.sources.writers import quoted

VIEW = re.compile(r"__files_[0-9a-f]{12}\b.*WHERE _metadata\.file_name IN", re.S)


def _view_text(spark: SparkSession, table: str) -> str | None:
    """The text of the view; null for what isn't a view."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()}
    return rows.get("View Text") if rows.get("Type") == "VIEW" else None


def is_versioned(spark: SparkSession, table: str) -> bool:
    return bool(spark.catalog.tableExists(table) and VIEW.search(_view_text(spark, table) or ""))


def current(spark: SparkSession, table: str) -> tuple[str, list[str]]:
    """The table of files of a versioned table, and the names of the files of its version."""
    text = _view_text(spark, table)
    generation = re.search(r"__files_[0-9a-f]{12}", text)[0]
    return table + generation, [x for x in re.findall(r"'([^']*)'", text[text.index("file_name IN") :]) if x]


def _folder(spark: SparkSession, files_table: str) -> str:
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(files_table)}").collect()}
    return rows["Location"]


def _listed(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path of every Parquet file below a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    if fs.exists(path):
        files = fs.listFiles(path, True)
        while files.hasNext():
            p = files.next().getPath()
            if p.getName().endswith(".parquet") and "_temporary" not in p.toString():
                out[p.getName()] = p.toString()
    return out


def _write_files(df: DataFrame, files_table: str) -> list[str]:
    """Adds files that no version has yet; returns their names."""
    spark, folder = df.sparkSession, f"{_folder(df.sparkSession, files_table)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return sorted(_listed(spark, folder))


def _commit(spark: SparkSession, table: str, files_table: str, columns: list[str], names: list[str]) -> None:
    chosen = ", ".join(f"'{n}'" for n in names) or "''"
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(table)} AS SELECT {', '.join(quoted(c) if '.' not in c else f'`{c}`' for c in columns)} FROM {quoted(files_table)} WHERE _metadata.file_name IN ({chosen})")


def clustered(df: DataFrame, keys: list[str], files: int | None = None) -> DataFrame:
    """Rows of near keys in the same file, so that later merges of near keys touch few files."""
    order = [F.col(f"`{k}`") for k in keys]
    return (df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)).sortWithinPartitions(*order)


def replace(df: DataFrame, table: str, keys: list[str]) -> None:
    """All rows of the table, which is created if need be, become those of `df`; `df` may read the table. The files of the last
    generation go when the next merge or replacement starts."""
    spark = df.sparkSession
    sweep(spark, table)
    files_table = f"{table}__files_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE {quoted(files_table)} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true')")
    names = _write_files(clustered(df, keys), files_table)
    spark.catalog.refreshTable(files_table)
    _commit(spark, table, files_table, df.columns, names)


def adopt(spark: SparkSession, staged: str, table: str) -> None:
    """Gives a versioned table another name, which is free: its files stay where they are."""
    files_table, names = current(spark, staged)
    columns = spark.table(staged).columns
    mine = table + files_table[len(staged) :]
    spark.sql(f"ALTER TABLE {quoted(files_table)} RENAME TO {quoted(mine)}")
    _commit(spark, table, mine, columns, names)
    spark.sql(f"DROP VIEW {quoted(staged)}")


def touched_files(spark: SparkSession, table: str, source: DataFrame, keys: list[str]) -> tuple[str, list[str], list[str]]:
    """The table of files, the names of its version, and those among them that hold a key of the source. Reads keys only, and of these
    the row groups that the source's first key reaches."""
    files_table, names = current(spark, table)
    rows = spark.table(files_table).where(F.col("_metadata.file_name").isin(names))
    first = F.col(f"`{keys[0]}`")
    low, high, nulls = source.agg(F.min(first), F.max(first), F.count_if(first.isNull())).first()
    reach = first.between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    rows = rows.where(reach | first.isNull() if nulls else reach)
    wanted = source.select(*[F.col(f"`{k}`").alias(f"__s{i}") for i, k in enumerate(keys)])
    same = all_of([F.col(f"`{k}`").eqNullSafe(F.col(f"__s{i}")) for i, k in enumerate(keys)])
    named = rows.select(*[F.col(f"`{k}`") for k in keys], F.col("_metadata.file_name").alias("__file"))
    found = named.join(wanted, same, "left_semi").select("__file").distinct().collect()  # a row per file at most
    return files_table, names, sorted(r[0] for r in found)


def merge(source: DataFrame, table: str, keys: list[str], updates: list[str]) -> dict:
    """The upsert of the source (a row per key) into a versioned table. Returns how many files the version had, were rewritten and written."""
    spark = source.sparkSession
    sweep(spark, table)
    files_table, names, touched = touched_files(spark, table, source, keys)
    columns = spark.table(table).columns
    old = spark.table(files_table).where(F.col("_metadata.file_name").isin(touched)).select(*[f"`{c}`" for c in columns])
    merged = upsert(old, source, keys, updates)
    new = _write_files(clustered(merged, keys, max(1, len(touched))), files_table)
    spark.catalog.refreshTable(files_table)
    _commit(spark, table, files_table, columns, sorted(set(names) - set(touched)) + new)
    return {"files": len(names), "rewritten": len(touched), "written": len(new)}


def sweep(spark: SparkSession, table: str) -> int:
    """Removes files of no version, which earlier merges or runs that ended too soon have left, and tables of earlier generations; returns
    how many."""
    prefix, database = table.split(".")[-1] + "__files_", ".".join(table.split(".")[:-1])
    live = current(spark, table) if is_versioned(spark, table) else (None, [])
    there = spark.sql(f"SHOW TABLES {'IN ' + quoted(database) if database else ''} LIKE '{prefix.lower()}*'").collect()
    gone = 0
    for name in (r["tableName"] for r in there):
        full = f"{database}.{name}" if database else name
        if live[0] is None or full.lower() != live[0].lower():
            spark.sql(f"DROP TABLE IF EXISTS {quoted(full)}")
            gone += 1
    if live[0] is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name, where in _listed(spark, _folder(spark, live[0])).items():
            if name not in set(live[1]):
                path(where).getFileSystem(conf).delete(path(where), False)
                gone += 1
        spark.catalog.refreshTable(live[0])
    return gone


def drop(spark: SparkSession, table: str) -> None:
    """Removes the view first, then all its files."""
    if is_versioned(spark, table):
        spark.sql(f"DROP VIEW {quoted(table)}")
    sweep(spark, table)
