"""Sinks: tables and files by configuration, reports, single files that appear whole, manifests."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, SparkSession

IDENTIFIER = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


def quoted(name: str) -> str:
    """A dotted table name with every part quoted."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def check_format(fmt: str) -> str:
    if not IDENTIFIER.fullmatch(fmt):
        raise ValueError(f"bad format name {fmt!r}")
    return fmt


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """A full refresh; `merge` overwrites, and Delta tables take a new schema."""
    writer = df.write.mode("overwrite" if mode == "merge" else mode).format(check_format(fmt))
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(name)


def write_by_config(df: DataFrame, config: dict) -> str:
    """To `output_table`, or to `output_path` in `output_format`; returns where."""
    fmt, mode = check_format(str(config.get("output_format") or "parquet").lower()), config.get("output_mode") or "overwrite"
    target = config.get("output_target") or ("table" if config.get("output_table") else "path")
    if target == "table":
        if not config.get("output_table"):
            raise ValueError("output_table is needed")
        write_table(df, config["output_table"], mode, fmt)
        return config["output_table"]
    if not config.get("output_path"):
        raise ValueError("output_path is needed")
    options = {"header": "true"} if fmt == "csv" else {"overwriteSchema": "true"}
    df.write.mode(mode).format(fmt).options(**options).save(config["output_path"])
    return config["output_path"]


def write_report(df: DataFrame | None, report_dir: str | None, name: str = "excluded_items_summary") -> str | None:
    """CSV under the report folder; nothing without a folder or a frame."""
    if df is None or not report_dir:
        return None
    df.write.mode("overwrite").option("header", "true").csv(f"{report_dir}/{name}")
    return f"{report_dir}/{name}"


def write_single_csv(df: DataFrame, path: str, most_rows: int = 1_000_000) -> int:
    """One local CSV file that appears whole or not at all; for reports, so more than `most_rows` rows are an error."""
    rows = df.limit(most_rows + 1).toPandas()
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows; write a folder of files instead")
    rows.to_csv(f"{path}.tmp", index=False)
    os.replace(f"{path}.tmp", path)
    return len(rows)


def write_manifest(path: str, facts: DataFrame | dict, /, **more) -> dict:
    """One row of facts (counts, paths) as JSON."""
    out = (facts if isinstance(facts, dict) else (facts.first() or {}).asDict()) | more
    with open(f"{path}.tmp", "w") as f:
        json.dump(out, f, indent=2, default=str)
    os.replace(f"{path}.tmp", path)
    return out


def create_log_table(spark: SparkSession, name: str, columns: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING {check_format(fmt)}")
