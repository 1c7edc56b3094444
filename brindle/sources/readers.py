"""Sources: catalog tables, files by configuration, lenient CSV, local relations."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("csv", "parquet", "delta", "orc", "json")
CSV_OPTIONS = {"header": "true", "inferSchema": "true", "quote": '"', "escape": '"'}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """By the catalog, and by a probe that reads nothing where the catalog can't tell."""
    try:
        return spark.catalog.tableExists(name)
    except Exception:
        try:
            spark.table(name).limit(0).collect()
            return True
        except Exception:
            return False


def read_csv(spark: SparkSession, path: str, null_value: str | None = "null", **options: str) -> DataFrame:
    return spark.read.options(**(CSV_OPTIONS | ({"nullValue": null_value} if null_value else {}) | options)).csv(path)


def read_by_config(spark: SparkSession, config: dict) -> DataFrame:
    """`input_table`, or `input_path` in `input_format` (csv by default); unknown formats are errors."""
    if config.get("input_table"):
        return read_table(spark, config["input_table"])
    fmt = str(config.get("input_format") or "csv").lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown input format {fmt!r}; one of {', '.join(FORMATS)}")
    if not config.get("input_path"):
        raise ValueError("input_table or input_path is needed")
    return read_csv(spark, config["input_path"], None) if fmt == "csv" else spark.read.format(fmt).load(config["input_path"])


def read_csv_tokens(spark: SparkSession, path: str, tokens: list[str], columns: list[str] | None = None) -> DataFrame:
    """All columns as text with missing tokens as null; `columns` are the only ones that the scan parses."""
    df = spark.read.options(header="true", inferSchema="false", quote='"', escape='"').csv(path)
    df = df.select(*[c for c in df.columns if columns is None or c in columns])
    return df.select(*[F.when(~F.trim(F.col(f"`{c}`")).isin(tokens), F.col(f"`{c}`")).alias(c) for c in df.columns]) if tokens else df


def read_utf16(spark: SparkSession, path: str, sep: str = "\t", whole_files: bool = False) -> DataFrame:
    """Delimited UTF-16 text with a header, all columns as text; byte order by the first file's mark, else little endian.

    Files are split among tasks at the two bytes of a line end. Two scans first look for what can't be split so: lines
    of an odd number of bytes (where a line end's bytes are those of two other letters), or with quotes that another line closes. Then,
    or with `whole_files`, each file is read as a whole by one task.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = hadoop.Path(path)
    fs = pattern.getFileSystem(conf)
    found = [s for top in (fs.globStatus(pattern) or []) for s in (fs.listStatus(top.getPath()) if top.isDirectory() else [top]) if not s.getPath().getName().startswith(("_", "."))]
    first = next((s.getPath() for s in sorted(found, key=lambda s: s.getPath().toString()) if s.getLen() >= 2), None)
    if first is None:
        return spark.read.options(header="true", sep=sep, encoding="UTF-16", multiLine="true").csv(path)
    opened = fs.open(first)
    try:
        mark = opened.readUnsignedShort()
    finally:
        opened.close()
    charset = "UTF-16BE" if mark == 0xFEFF else "UTF-16LE"
    raw = spark.read.options(encoding=charset, lineSep="\n").text(path).select(F.col("value").cast("binary").alias("raw"))
    line = F.rtrim(F.regexp_replace(F.decode("raw", charset), "^\ufeff", ""), F.lit("\r"))
    whole_files = whole_files or raw.agg(F.max(F.octet_length("raw") % 2)).first()[0] == 1
    if not whole_files:  # now every line starts at a letter, so it can be decoded
        whole_files = raw.agg(F.max(F.length(F.regexp_replace(line, '[^"]', "")) % 2)).first()[0] == 1
    if whole_files:
        return spark.read.options(header="true", sep=sep, encoding="UTF-16", multiLine="true").csv(path)
    lines = raw.select(line.alias("line")).where(F.length("line") > 0)
    head = spark.read.options(encoding=charset, lineSep="\n").text(first.toString()).select(F.rtrim(F.regexp_replace(F.decode(F.col("value").cast("binary"), charset), "^\ufeff", ""), F.lit("\r"))).first()[0]
    names = next(csv.reader([head], delimiter=sep))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return lines.where(F.col("line") != head).select(F.from_csv("line", F.lit(schema), {"sep": sep}).alias("r")).select("r.*")


def local_relation(spark: SparkSession, rows: list, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)
