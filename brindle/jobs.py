"""Whole jobs from a configuration file: read, clean, combine, write and report, in the order that the operators need.

    python -m brindle.jobs JOB --config FILE [--set KEY=VALUE ...] [--no-write] [--full-refresh]

Jobs are `clean`, `clean_raw`, `clean_tables`, `clean_attributes`, `aggregate`, `join` and `cluster`. Settings of the top level may be set on the command
line, by parameters of the session, by the environment (BRINDLE_<KEY>) or in the file, in that rank. What is counted for a report is
observed while the output is written, so that a job reads its input once more only where its docstring says so.
"""

from __future__ import annotations

import argparse
import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brindle.config import load_config, load_env, merge_overrides, parameters, project_root, resolve_path
from brindle.functions import scalars
from brindle.functions.arrays import parse_list
from brindle.functions.names import as_list, flag_names, rename, resolve
from brindle.operators import clean as cleaning
from brindle.operators.aggregate import group_counts, missing_summary, modes
from brindle.operators.expand import distinct_items, flags
from brindle.operators.flow import EXCLUDED_METHODS, find_like_items, holdout_features, profiles, wide_features
from brindle.operators.impute import impute_by_groups, impute_by_hierarchy
from brindle.operators.incremental import after_mark, incremental_upsert, max_mark, overwrite, read_mark, target_exists
from brindle.operators.joins import joined_data
from brindle.operators.likeitems import HOLDOUT, roles
from brindle.operators.persist import fixed
from brindle.operators.suppliers import aggregate_performance, apply_canonical, canonical_suppliers, cross_supplier_report
from brindle.operators.versioned import is_versioned
from brindle.sources.readers import read_by_config, read_csv
from brindle.sources.writers import write_by_config, write_manifest, write_report, write_table

#: Settings that the command line, parameters and environment may change.
OVERRIDES = ("input_path", "input_table", "input_format", "output_path", "output_table", "output_format", "write_target", "write_mode", "report_dir", "manifest_path")


def job_config(path: str | Path, given: dict | None = None, params: dict | None = None, env: dict | None = None) -> dict:
    """The file's settings under those of the environment, the parameters and the command line. Paths of the file itself are
    taken from the folder that holds its `config` folder."""
    env = os.environ if env is None else env
    out = load_config(path)
    for key in OVERRIDES:
        if key.endswith(("_path", "_dir")) and out.get(key) and "://" not in str(out[key]):
            out[key] = str(resolve_path(project_root(path), out[key]))
    known = {k: env.get(f"BRINDLE_{k.upper()}") for k in OVERRIDES}
    return merge_overrides(out, given or {}, params or {}, known)


def texts(values) -> list[str]:
    return [str(v) for v in values or [] if v is not None]


def clean_rows(df: DataFrame, config: dict) -> DataFrame:
    """Standard names, missing tokens, numbers, text, dates, typos, fallback columns, suppliers and ownership, as far as configured.

    One chain of projections without a job. A supplier or ownership column that is configured and missing is an error; other
    columns that are missing are left out.
    """
    columns, rules = config.get("columns") or {}, config.get("cleaning") or {}
    df = rename(df, columns.get("rename_map"), columns.get("standardize", True), columns.get("lower_case", True))
    dates, pattern = as_list(rules.get("date_cols")), rules.get("date_format")
    df = cleaning.clean_columns(
        df, as_list(rules.get("numeric_cols")), as_list(rules.get("string_cols")), dates, {c: pattern for c in dates} if pattern else None,
        rules.get("typo_maps"), texts(rules.get("missing_tokens")) or cleaning.DEFAULT_TOKENS, rules.get("lower_case", True),
    )
    df = cleaning.fill_from(df, {c: as_list(v) for c, v in (config.get("complementary_columns") or {}).items()}, bool(config.get("drop_complementary_fallbacks")))
    supplier = config.get("supplier") or {}
    if supplier.get("column"):
        c = resolve(df, supplier["column"])
        df = df.withColumn(c, scalars.lookup(c, supplier.get("map") or {}, supplier.get("lower_case", True)))
    owner = config.get("ownership_mapping") or {}
    if owner:
        c = resolve(df, owner["input_col"])
        lists = [tuple(v.lower() for v in texts(owner.get(k))) for k in ("owned_exact", "leased_exact", "leased_contains", "owned_contains")]
        df = df.withColumn(owner.get("output_col") or c, scalars.ownership(c, *lists))
    return df


def observed(df: DataFrame, **more) -> tuple[DataFrame, Observation]:
    """The rows, whose count (`rows`) and other aggregates are known once they have been written."""
    found = Observation()
    return df.observe(found, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in more.items()]), found


def write_output(df: DataFrame, config: dict) -> str:
    return write_by_config(df, config | {"output_target": config.get("write_target") or config.get("output_target"), "output_mode": config.get("write_mode") or config.get("output_mode")})


def finish(config: dict, facts: dict) -> dict:
    """The facts, also as a JSON file if `manifest_path` is set."""
    if config.get("manifest_path"):
        write_manifest(config["manifest_path"], facts)
    return facts


def run_clean(spark: SparkSession, config: dict, write: bool = True, full_refresh: bool = False) -> dict:
    """A source table, filtered and cleaned, into its target: by an incremental upsert if `incremental.enabled`, else as a full refresh.

    Returns operation (create, full_refresh, merge, skip or no_write), rows, table, marks, keys, and as frames that are only run when used:
    cleaned, missing (a row per column) and ownership (rows per value). Without a write, rows and the new mark cost a pass.
    """
    source, output, inc = config.get("source") or {}, config.get("output") or {}, config.get("incremental") or {}
    if not source.get("table"):
        raise ValueError("source.table is needed")
    target = output.get("table")
    if write and not target:
        raise ValueError("output.table is needed")
    fmt, job = str(output.get("format") or "parquet").lower(), inc.get("job_name") or target
    df = cleaning.apply_filters(spark.table(source["table"]), source.get("filters") or {})
    out = {"operation": "no_write", "table": target if write else None, "previous_mark": None, "new_mark": None, "keys": as_list(inc.get("key_columns"))}
    if inc.get("enabled"):
        mark, log = inc.get("watermark_column"), inc.get("watermark_table")
        if not (mark and log):
            raise ValueError("incremental.watermark_column and incremental.watermark_table are needed")
        if target and not full_refresh and target_exists(spark, target):
            out["previous_mark"] = read_mark(spark, log, job, mark)
        later = after_mark(df, mark, out["previous_mark"])
        if write:
            done = incremental_upsert(df, target, inc.get("key_columns"), mark, log, lambda d: clean_rows(d, config), inc.get("update_columns"), job, full_refresh, source["table"], fmt)
            out |= {"operation": done["operation"], "rows": done["rows"], "new_mark": done["mark"]}
        else:
            out |= {"rows": later.count(), "new_mark": max_mark(later, mark)}
        cleaned = clean_rows(later, config)
    else:
        cleaned = clean_rows(df, config)
        if write:
            rows, found = observed(cleaned)
            if is_versioned(spark, target):
                overwrite(rows, target, rows.columns[:1], fmt)
            else:
                write_table(rows, target, output.get("mode") or "overwrite", fmt)
            out |= {"operation": "full_refresh", "rows": found.get["rows"]}
        else:
            out["rows"] = cleaned.count()
    report = config.get("diagnostics") or {}
    owner = report.get("ownership_counts_column")
    out["cleaned"] = cleaned
    out["missing"] = missing_summary(cleaned) if report.get("missing_summary", True) else None
    out["ownership"] = group_counts(cleaned, owner) if owner in cleaned.columns else None
    finish(config, {k: v for k, v in out.items() if not isinstance(v, DataFrame)})
    return out


def run_clean_raw(spark: SparkSession, config: dict, write: bool = True) -> dict:
    """The primary raw table: early filters, cleaning, the supplier of listed cabinets (`cabinet_supplier_map`), one supplier per cabinet
    (`supplier_consistency_validation`), the majority supplier of a game for rows without one (`majority_supplier_per_game`), then
    imputation by hierarchies, the output, the report of cabinets with several suppliers and the run log.

    Known from documentation only. Assumed: a listed cabinet's supplier replaces the row's own; tied cabinets keep theirs; a game's
    majority fills nulls alone, the lowest of equals. Hierarchies cost one more scan each.
    """
    df = clean_rows(cleaning.apply_filters(read_by_config(spark, config), config.get("filters") or {}), config)
    names = config.get("supplier") or {}
    supplier, cabinet, game = names.get("column"), names.get("cabinet_column"), names.get("game_column")
    if config.get("cabinet_supplier_map"):
        known = {str(k): str(v) for k, v in config["cabinet_supplier_map"].items()}
        listed = F.lower(F.trim(F.col(cabinet))).isin([k.strip().lower() for k in known])
        df = df.withColumn(supplier, F.when(listed, scalars.lookup(cabinet, known)).otherwise(F.col(supplier)))
    report = None
    if config.get("supplier_consistency_validation"):
        report = cross_supplier_report(df, cabinet, supplier)
        df = apply_canonical(df, canonical_suppliers(df, cabinet, supplier), cabinet, supplier).drop("canonical_supplier_status")
    if config.get("majority_supplier_per_game"):
        major = modes(df, [game], supplier).select(F.col(game).alias("__game"), F.col(supplier).alias("__major"))
        df = df.join(major, F.col(game) == F.col("__game"), "left").withColumn(supplier, F.coalesce(supplier, "__major")).drop("__game", "__major")
    filled = {}
    for c, hierarchy in (config.get("impute") or {}).items():
        df, filled[c] = impute_by_hierarchy(df, c, as_list(hierarchy))
    out = {"filled": filled, "columns": len(df.columns), "output": None, "cleaned": df, "cross_suppliers": report}
    if write:
        rows, found = observed(df)
        out |= {"output": write_output(rows, config)}
        out |= {"rows": found.get["rows"], "report": write_report(report, config.get("report_dir"), "cross_supplier_cabinets")}
    finish(config, {k: v for k, v in out.items() if not isinstance(v, DataFrame)})
    return out


def run_clean_tables(spark: SparkSession, config: dict, write: bool = True) -> dict[str, DataFrame]:
    """Secondary tables: each entry of `tables` is read, filtered, cleaned by its own rules and, if it names an output, written."""
    out = {}
    for name, one in (config.get("tables") or {}).items():
        out[name] = clean_rows(cleaning.apply_filters(read_by_config(spark, one), one.get("filters") or {}), one)
        if write and (one.get("output_path") or one.get("output_table")):
            write_output(out[name], one)
    return out


def run_clean_attributes(spark: SparkSession, config: dict, write: bool = True) -> dict:
    """Attributes: missing tokens, dropped columns (named ones and those without a value), flags from the list column, imputation by
    groups, the output. The columns depend on the data, so columns without a value and the list's values each cost a pass.

    Returns rows, columns, dropped_columns, flags (value to column), remaining_nulls, output and the frame, cleaned.
    """
    csv = not config.get("input_table") and str(config.get("input_format") or "csv").lower() == "csv"
    raw = read_csv(spark, config["input_path"]) if csv and config.get("input_path") else read_by_config(spark, config)
    df = cleaning.null_tokens(raw, texts(config.get("null_strings")) or cleaning.DEFAULT_TOKENS, trimmed=True)
    df = cleaning.drop_present(cleaning.drop_all_null(df), as_list(config.get("explicit_drop_columns")))
    gone, c, made = sorted(set(raw.columns) - set(df.columns)), config.get("list_column"), {}
    if c in df.columns:
        values = distinct_items(df, parse_list(c))
        made, df = flag_names(c, values), flags(df, parse_list(c), c, values)
    values, groups = ([x for x in as_list(config.get(k)) if x in df.columns] for k in ("impute_columns", "impute_groups"))
    if values and groups:
        df = impute_by_groups(df, values, groups)
    out = {"columns": len(df.columns), "dropped_columns": gone, "flags": made, "output": None, "cleaned": df}
    if write:
        rows, found = observed(df, **{f"null_{i}": F.count_if(F.col(v).isNull()) for i, v in enumerate(values)})
        out["output"] = write_output(rows, config)
        out |= {"rows": found.get["rows"], "remaining_nulls": {v: found.get[f"null_{i}"] for i, v in enumerate(values)}}
    finish(config, {k: v for k, v in out.items() if not isinstance(v, DataFrame)})
    return out


def run_aggregate(spark: SparkSession, config: dict, write: bool = True) -> dict:
    """Performance per `group_columns`: means weighted by `weight_column`, sums, first stable descriptors, distinct counts; excluded rows per
    group as a report. Which rows are excluded is an SQL condition, `exclude`, as the rule is documented nowhere.
    """
    df, group = read_by_config(spark, config), as_list(config.get("group_columns"))
    excluded = F.expr(config["exclude"]) if config.get("exclude") else None
    order = F.col(config.get("order_column") or group[0])
    kept, left_out = aggregate_performance(df, group, config["weight_column"], *[as_list(config.get(k)) for k in ("weighted_columns", "sum_columns", "first_columns", "distinct_columns")], order, excluded)
    out = {"columns": len(kept.columns), "group_columns": group, "output": None, "aggregated": kept, "excluded": left_out}
    if write:
        rows, found = observed(kept)
        out["output"] = write_output(rows, config)
        out |= {"rows": found.get["rows"], "report": write_report(left_out if excluded is not None else None, config.get("report_dir"))}
    finish(config, {k: v for k, v in out.items() if not isinstance(v, DataFrame)})
    return out


def run_join(spark: SparkSession, config: dict, write: bool = True) -> dict:
    """Performance with mapping, attributes and sales, each read by its own entry of `inputs`. The manifest holds input and output
    rows, their ratio (retention) and how many rows found a theme, attributes and sales. Input rows cost a count of the performance table."""
    inputs = {k: read_by_config(spark, config["inputs"][k]) for k in ("performance", "mapping", "attributes", "sales")}
    names = [config[k] for k in ("game_column", "cabinet_column", "theme_column", "theme_key", "sales_column")]
    joined = joined_data(*inputs.values(), *names)
    out = {"columns": len(joined.columns), "output": None, "joined": joined}
    if write:
        found_in = {"with_theme": names[2], "with_attributes": names[3], "with_sales": f"{names[4]}_total"}
        rows, found = observed(joined, **{k: F.count_if(F.col(c).isNotNull()) for k, c in found_in.items()})
        out["output"] = write_output(rows, config)
        before = inputs["performance"].count()
        out |= found.get | {"input_rows": before, "retention": round(found.get["rows"] / before, 6) if before else None}
    finish(config, {k: v for k, v in out.items() if not isinstance(v, DataFrame)})
    return out


def run_cluster(spark: SparkSession, config: dict, write: bool = True) -> dict:
    """Like items, from attributes and relation map (`inputs.attributes`, `inputs.relation`, each read by its own entry) to the exports: profiles,
    feature_matrix, mapping, grouped_mapping, cluster_summary, elbow_scores and holdout_features (the table that a chart of each holdout item would
    show), folders of CSV files below `output_dir`, and the manifest.

    `profiles` holds what flow.profiles takes (`order` is needed), `clustering` what flow.find_like_items takes. With `history_months`, younger
    historical items are left out first. `selected_k` out of range is an error.
    """
    inputs = {k: read_by_config(spark, config["inputs"][k]) for k in ("attributes", "relation")}
    about, how = dict(config.get("profiles") or {}), dict(config.get("clustering") or {})
    about = {k: tuple(v) if isinstance(v, list) and k != "order" else v for k, v in about.items()}
    items = fixed(profiles(inputs["attributes"], inputs["relation"], **about))
    months = config.get("history_months")
    if months is not None:
        placed = roles(items, "profile_id", "profile_release_date", float(how.get("fraction", 0.10)))
        items = fixed(placed.where((F.col("role") == HOLDOUT) | (F.col("release_age_months") >= int(months))).drop("role"))
    k = int(how.pop("selected_k", 8))
    out = find_like_items(items, "profile_id", "profile_release_date", **{a: tuple(v) if a == "texts" else v for a, v in how.items()}, k=k)
    mapping = fixed(out["mapping"])
    frames = {
        "profiles": out["profiles"], "feature_matrix": wide_features(out["features"], out["profiles"]), "mapping": mapping, "grouped_mapping": out["grouped"],
        "cluster_summary": out["summary"], "elbow_scores": out["elbow"], "holdout_features": holdout_features(out["profiles"], out["features"], out["metadata"]),
    }
    held = F.count_if(F.col("role") == HOLDOUT)
    counts = out["profiles"].agg(F.count(F.lit(1)).alias("profile_rows"), held.alias("holdout_profiles"), (F.count(F.lit(1)) - held).alias("historical_profiles"), F.countDistinct("cluster_id").alias("selected_clusters")).first().asDict()
    sources = {r[0]: r[1] for r in out["metadata"].groupBy("source_column").agg(F.count(F.lit(1))).collect()}  # a row per column
    best = out["elbow"].orderBy(F.desc("elbow_distance_to_line"), "requested_k").first()
    facts = counts | {
        "inputs": {k: config["inputs"][k].get("input_path") or config["inputs"][k].get("input_table") for k in inputs}, "feature_columns": sum(sources.values()), "feature_source_counts": sources,
        "mapped_holdout_profiles": mapping.select("target_profile_id").distinct().count(), "mapping_rows": mapping.count(), "auto_elbow_k": best["actual_k"] if best else None, "selected_clusters_setting": k,
        "excluded_match_methods": sorted(about.get("excluded", EXCLUDED_METHODS)), "distance_metric": "cosine", "linkage_method": "complete", "outputs": {},
    }
    if write:
        for name, frame in frames.items():
            plain = frame.select(*[F.to_json(c).alias(c) if "<" in kind else F.col(c) for c, kind in frame.dtypes])
            path = f"{config['output_dir']}/{name}"
            plain.write.mode("overwrite").option("header", "true").csv(path)
            facts["outputs"][name] = path
    finish(config, facts)
    return facts | frames


JOBS = {"cluster": run_cluster, "clean": run_clean, "clean_raw": run_clean_raw, "clean_tables": run_clean_tables, "clean_attributes": run_clean_attributes, "aggregate": run_aggregate, "join": run_join}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Runs one job and prints its facts as JSON."""
    parser = argparse.ArgumentParser(prog="brindle.jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--config", required=True)
    parser.add_argument("--env-file", default=".env")
    parser.add_argument("--set", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--no-write", action="store_true")
    parser.add_argument("--full-refresh", action="store_true")
    args = parser.parse_args(argv)
    given = dict(pair.partition("=")[::2] for pair in args.set)
    if unknown := sorted(set(given) - set(OVERRIDES)):
        parser.error(f"unknown settings {unknown}; one of {', '.join(OVERRIDES)}")
    if args.full_refresh and args.job != "clean":
        parser.error("--full-refresh is for clean")
    load_env(args.env_file)
    if spark is None:
        from brindle.session import session

        spark = session()
    config = job_config(args.config, given, parameters(spark, list(OVERRIDES)))
    out = JOBS[args.job](spark, config, not args.no_write, **({"full_refresh": True} if args.full_refresh else {}))
    print(json.dumps({k: v for k, v in out.items() if not isinstance(v, DataFrame)}, indent=2, default=str))
    return out


if __name__ == "__main__":
    main()
