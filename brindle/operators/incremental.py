"""Batch high-water marks and incremental upserts with create, full_refresh, skip and merge outcomes."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from brindle.functions.names import resolve
from brindle.operators import versioned
from brindle.operators.joins import all_of, merge_columns, upsert
from brindle.sources.readers import table_exists
from brindle.sources.writers import create_log_table, quoted, write_table

LOG_SCHEMA = StructType([
    StructField("job_name", StringType(), False), StructField("watermark_column", StringType(), False), StructField("watermark_value", TimestampType()),
    StructField("source_table", StringType()), StructField("target_table", StringType()), StructField("rows_processed", LongType()),
    StructField("operation", StringType()), StructField("updated_at", TimestampType(), False),
])


def max_mark(df: DataFrame, column: str):
    return df.agg(F.max(F.col(resolve(df, column)).cast("timestamp"))).first()[0]


def after_mark(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly later than the mark: equal, older and null stamps go. Without a mark, all rows."""
    return df if mark is None else df.where(F.col(resolve(df, column)).cast("timestamp") > F.lit(mark).cast("timestamp"))


def dedup_latest(df: DataFrame, keys: list[str], watermark: str) -> DataFrame:
    """The latest row per key, null stamps last; of equal stamps the row of the largest values, column by column, so reruns agree (maps
    have no order; rows that differ in these alone are told apart by a hash).

    Two steps, so that no row is held twice: the latest stamp of each key by a hash aggregation, which sends a key's stamp per map task;
    then the rows of that stamp alone are ranked. A key whose rows are all alike in their stamp is ranked in one task.
    """
    at = F.col(watermark).cast("timestamp")
    latest = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max(at).alias("__at"))
    same = all_of([F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]) & at.eqNullSafe(F.col("__at"))
    rows = df.join(latest, same).drop("__at", *[f"__k{i}" for i in range(len(keys))])
    plain = [F.col(c).desc_nulls_last() for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    order = [*plain, F.hash(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]))).desc()]
    return rows.withColumn("__row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__row = 1").drop("__row")


def read_mark(spark: SparkSession, log_table: str, job: str, column: str):
    """The last logged mark of a job and column; null without a log."""
    if not table_exists(spark, log_table):
        return None
    rows = spark.table(log_table).where((F.col("job_name") == job) & (F.col("watermark_column") == column))
    return rows.agg(F.max_by("watermark_value", F.struct("updated_at", "watermark_value"))).first()[0]


def append_mark(spark: SparkSession, log_table: str, job: str, column: str, mark, source: str | None, target: str, rows: int, operation: str, fmt: str = "parquet") -> bool:
    """One row for the log; nothing for a null mark."""
    if mark is None:
        return False
    create_log_table(spark, log_table, "job_name STRING, watermark_column STRING, watermark_value TIMESTAMP, source_table STRING, target_table STRING, rows_processed BIGINT, operation STRING, updated_at TIMESTAMP", fmt)
    row = (job, column, mark, source, target, rows, operation, datetime.datetime.now(datetime.timezone.utc))
    spark.createDataFrame([row], LOG_SCHEMA).write.mode("append").format(fmt).saveAsTable(log_table)
    return True


def stage_overwrite(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Overwrite a plain table that the plan reads: the new version is written beside it in full, then the two swap names.

    Nothing is ever read while it is written. A run that ends between the renames leaves the old version as `__before`, which
    `restore_overwrite`, called first, puts back.
    """
    spark, staging, before = df.sparkSession, f"{table}__staging", f"{table}__before"
    restore_overwrite(spark, table)
    write_table(df, staging, "overwrite", fmt)
    if table_exists(spark, table):
        spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(before)}")
    spark.sql(f"ALTER TABLE {quoted(staging)} RENAME TO {quoted(table)}")
    spark.sql(f"DROP TABLE IF EXISTS {quoted(before)}")


def restore_overwrite(spark: SparkSession, table: str) -> bool:
    """Puts back the version that an interrupted overwrite had set aside, if the table has no newer one. To be called before anyone
    asks whether the table is there."""
    before = f"{table}__before"
    if not table_exists(spark, before):
        return False
    if table_exists(spark, table):
        spark.sql(f"DROP TABLE {quoted(before)}")
        return False
    spark.sql(f"ALTER TABLE {quoted(before)} RENAME TO {quoted(table)}")
    return True


def target_exists(spark: SparkSession, table: str) -> bool:
    """Whether the target is there, once an interrupted swap has been put back."""
    restore_overwrite(spark, table)
    return table_exists(spark, table)


def overwrite(df: DataFrame, table: str, keys: list[str], fmt: str = "parquet") -> None:
    """All rows of the target become those of `df`, which may read it. Parquet targets are versioned tables; a plain one becomes
    versioned here: it is set aside, under the name that `restore_overwrite` knows, for the moment in which the view takes its name."""
    spark = df.sparkSession
    there = target_exists(spark, table)
    if fmt != "parquet":
        stage_overwrite(df, table, fmt) if there else write_table(df, table, "overwrite", fmt)
    elif not there or versioned.is_versioned(spark, table):
        versioned.replace(df, table, keys)
    else:
        before = f"{table}__before"
        staged = f"{table}__staged"
        versioned.drop(spark, staged)
        versioned.replace(df, staged, keys)
        spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(before)}")
        versioned.adopt(spark, staged, table)
        spark.sql(f"DROP TABLE IF EXISTS {quoted(before)}")


def merge_into(source: DataFrame, table: str, keys: list[str], updates: list[str], fmt: str) -> None:
    """MERGE where the provider has it (Delta); a merge that rewrites the touched files of a Parquet table; the staged upsert elsewhere."""
    spark = source.sparkSession
    if fmt == "parquet" and versioned.is_versioned(spark, table):
        versioned.merge(source, table, keys, updates)
        return
    if fmt == "parquet":
        overwrite(upsert(spark.table(table), source, keys, updates), table, keys)
        return
    if fmt != "delta":
        stage_overwrite(upsert(spark.table(table), source, keys, updates), table, fmt)
        return
    source.createOrReplaceTempView("__merge_source")
    try:
        on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
        sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in updates)
        names, values = ", ".join(f"`{c}`" for c in source.columns), ", ".join(f"s.`{c}`" for c in source.columns)
        spark.sql(f"MERGE INTO {quoted(table)} t USING __merge_source s ON {on}" + (f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else "") + f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
    finally:
        spark.catalog.dropTempView("__merge_source")


def incremental_upsert(source: DataFrame, target: str, key_columns, watermark: str, log_table: str, clean=None, update_columns=None, job: str | None = None, full_refresh: bool = False, source_name: str | None = None, fmt: str = "parquet") -> dict:
    """Read the mark, keep later rows, clean, keep the latest per key, write, then log. Returns operation, rows, mark.

    create: no target yet; full_refresh: asked for; skip: no later rows (nothing is logged); merge otherwise. The mark
    is the largest stamp of the kept source rows, found with their count in one pass; rows that come in later than it wait for the next
    run. It is logged after the data, so a crash between repeats the batch,
    and the merge is idempotent.
    """
    spark, job = source.sparkSession, job or target
    there = target_exists(spark, target)
    mark = read_mark(spark, log_table, job, watermark) if there and not full_refresh else None
    later = after_mark(source, watermark, mark)
    stamp = F.col(resolve(source, watermark)).cast("timestamp")
    new, rows = later.agg(F.max(stamp), F.count(F.lit(1))).first()
    if new is not None:
        later = later.where(stamp.isNull() | (stamp <= F.lit(new)))
    cleaned = clean(later) if clean else later
    keys, updates = merge_columns(cleaned, key_columns, update_columns)
    latest = dedup_latest(cleaned, keys, resolve(cleaned, watermark))
    operation = "create" if not there else "full_refresh" if full_refresh else "merge"
    if operation == "merge" and not rows:
        return {"operation": "skip", "rows": 0, "mark": mark}
    if operation == "merge":
        merge_into(latest, target, keys, updates, fmt)
    else:
        overwrite(latest, target, keys, fmt)
    append_mark(spark, log_table, job, watermark, new, source_name, target, rows, operation, fmt)
    return {"operation": operation, "rows": rows, "mark": new}
