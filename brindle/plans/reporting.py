"""Queries of aggregations, rankings and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import aggregate, clean, likeitems, quantiles, suppliers
from brindle.plans.registry import query, select, table

HOLES = dict(k="c_custkey", name="CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN '  ' ELSE c_name END", bal="CASE WHEN c_custkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END")


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) FILTER (WHERE {m}) AS missing_count, round(count(*) FILTER (WHERE {m}) * 100.0::DOUBLE / count(*), 2) AS missing_percent, count(*) FILTER (WHERE NOT ({m})) AS non_missing_count FROM {select('customer', **HOLES)}"
    for c, t, m in (("k", "bigint", "k IS NULL"), ("name", "string", "name IS NULL OR trim(name) = ''"), ("bal", "double", "bal IS NULL OR isnan(bal)"))
))
def missing_summary(spark, sf):
    return aggregate.missing_summary(table(spark, sf, "customer", **HOLES))


@query(f"SELECT round(count(*) FILTER (WHERE k IS NULL) * 100.0::DOUBLE / count(*), 4) AS k, round(count(*) FILTER (WHERE name IS NULL) * 100.0::DOUBLE / count(*), 4) AS name, round(count(*) FILTER (WHERE bal IS NULL) * 100.0::DOUBLE / count(*), 4) AS bal FROM {select('customer', **HOLES)}")
def null_percentages(spark, sf):
    return aggregate.null_percentages(table(spark, sf, "customer", **HOLES))


@query("SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def group_counts(spark, sf):
    return aggregate.group_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("SELECT p_type, count(*) AS count FROM part GROUP BY 1 ORDER BY count DESC, p_type LIMIT 10")
def top_values(spark, sf):
    return aggregate.group_counts(table(spark, sf, "part"), "p_type", 10)


@query("SELECT round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0::DOUBLE / count(*), 4) AS no_match_percent FROM orders")
def match_rate(spark, sf):
    return aggregate.match_rate(table(spark, sf, "orders"), "o_orderstatus", "F")


@query("SELECT 'count' AS summary, count(c_custkey)::VARCHAR AS c_custkey FROM customer UNION ALL SELECT 'min', min(c_custkey)::VARCHAR FROM customer UNION ALL SELECT 'max', max(c_custkey)::VARCHAR FROM customer")
def describe(spark, sf):
    return aggregate.describe(table(spark, sf, "customer").select("c_custkey")).where("summary IN ('count', 'min', 'max')")


@query("SELECT p_brand, p_size FROM (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_size) AS r FROM part GROUP BY 1, 2) WHERE r = 1")
def mode_by_group(spark, sf):
    return aggregate.modes(table(spark, sf, "part"), ["p_brand"], "p_size")


FIRSTS = dict(g="CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_custkey END", o="o_orderkey", a="CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END", b="CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END")


@query(f"SELECT g::VARCHAR AS g, arg_min(a, (o, a)) FILTER (WHERE a IS NOT NULL) AS a, arg_min(b, (o, b)) FILTER (WHERE b IS NOT NULL) AS b FROM {select('orders', **FIRSTS)} GROUP BY g")
def first_non_null(spark, sf):
    return aggregate.first_values(table(spark, sf, "orders", **FIRSTS), ["g"], ["a", "b"], F.col("o")).withColumn("g", F.col("g").cast("string"))


RELATION = dict(
    k="' Supplier  ' || CAST(l_suppkey AS STRING)", name="CASE WHEN l_partkey % 9 = 0 THEN ' ' ELSE 'N' || CAST(l_partkey AS STRING) END",
    method="CASE l_linenumber % 6 WHEN 0 THEN 'Raw_Exact' WHEN 1 THEN 'basic' WHEN 2 THEN 'aggressive ' WHEN 3 THEN 'no_match' WHEN 4 THEN 'very_likely' END",
    score="CASE WHEN l_partkey % 4 <> 0 THEN l_quantity END", d="CASE WHEN l_orderkey % 3 <> 0 THEN l_shipdate END",
)


@query(f"""WITH d AS (SELECT 'supplier ' || trim(replace(k, 'Supplier', '')) AS k, nullif(lower(trim(name)), '') AS name, lower(trim(method)) AS method, score, d::DATE AS d FROM {select("lineitem", **RELATION)}),
  o AS (SELECT *, CASE method WHEN 'raw_exact' THEN 1 WHEN 'basic' THEN 2 WHEN 'aggressive' THEN 3 WHEN 'very_likely' THEN 4 ELSE 99 END AS r, coalesce(-score, 1e300) AS s FROM d WHERE name IS NOT NULL AND (method IS NULL OR method <> 'no_match')),
  n AS (SELECT k, string_agg(name, ' | ' ORDER BY i) AS names FROM (SELECT k, name, row_number() OVER (PARTITION BY k ORDER BY min((r, s, name))) AS i FROM o GROUP BY 1, 2) WHERE i <= 8 GROUP BY 1),
  m AS (SELECT k, string_agg(method, ' | ' ORDER BY i) AS methods FROM (SELECT k, method, row_number() OVER (PARTITION BY k ORDER BY min((r, s, name))) AS i FROM o WHERE method IS NOT NULL GROUP BY 1, 2) WHERE i <= 3 GROUP BY 1)
  SELECT k, arg_min(name, (r, s, name)) AS best_name, arg_min(method, (r, s, name, method)) FILTER (WHERE method IS NOT NULL) AS best_method, arg_min(score, (r, s, name, score)) FILTER (WHERE score IS NOT NULL) AS best_score, (arg_min(d, (r, s, name, d)) FILTER (WHERE d IS NOT NULL))::VARCHAR AS best_date,
    any_value(names) AS names, any_value(methods) AS methods, count(DISTINCT name) AS n_names, count(*) AS n_rows, min(r)::INTEGER AS best_priority FROM o JOIN n USING (k) LEFT JOIN m USING (k) GROUP BY k""")
def relation_profile(spark, sf):
    methods = {"raw_exact": 1, "basic": 2, "aggressive": 3, "very_likely": 4}
    out = aggregate.relation_profile(table(spark, sf, "lineitem", **RELATION), "k", "name", "method", "score", methods, ["no_match"], date="d", most_methods=3)
    return out.withColumns({"names": F.array_join("names", " | "), "methods": F.array_join("methods", " | "), "best_date": F.col("best_date").cast("string")})


@query("""WITH v AS (SELECT l_returnflag AS g, CASE WHEN l_linenumber % 5 <> 0 THEN l_extendedprice END AS v FROM lineitem)
  SELECT g, count(v) AS n, round(quantile_cont(v, 0.0), 4) AS q0, round(quantile_cont(v, 0.01), 4) AS q1, round(quantile_cont(v, 0.5), 4) AS q2, round(quantile_cont(v, 0.937), 4) AS q3, round(quantile_cont(v, 1.0), 4) AS q4 FROM v GROUP BY 1""")
def grouped_quantiles(spark, sf):
    """Exact quantiles of each group by refining the buckets of their ranks."""
    rows = table(spark, sf, "lineitem", g="l_returnflag", v="CASE WHEN l_linenumber % 5 <> 0 THEN l_extendedprice END")
    out = quantiles.exact_quantiles(rows, "v", [0.0, 0.01, 0.5, 0.937, 1.0], ["g"])
    return out.select("g", "n", *[F.round(F.get("quantiles", F.lit(i)), 4).alias(f"q{i}") for i in range(5)])


@query("""SELECT l_suppkey AS k, string_agg(v, ', ' ORDER BY i) AS firsts FROM (SELECT l_suppkey, v, row_number() OVER (PARTITION BY l_suppkey ORDER BY o, v) AS i FROM (SELECT l_suppkey, l_shipmode AS v, min(l_orderkey) AS o FROM (SELECT *, CASE WHEN l_partkey % 3 <> 0 THEN 'm' || (l_partkey % 50)::VARCHAR END AS l_shipmode FROM lineitem) WHERE l_shipmode IS NOT NULL GROUP BY 1, 2)) WHERE i <= 5 GROUP BY 1""")
def first_distinct_values(spark, sf):
    """Each group's first five distinct values, by a bounded aggregation."""
    rows = table(spark, sf, "lineitem", k="l_suppkey", o="l_orderkey", v="CASE WHEN l_partkey % 3 <> 0 THEN 'm' || CAST(l_partkey % 50 AS STRING) END")
    return quantiles.top_distinct(rows, ["k"], "v", F.col("o"), 5, "firsts").withColumn("firsts", F.array_join("firsts", ", "))


@query("""SELECT l_returnflag, l_linestatus, round(sum(CASE WHEN l_linenumber % 3 <> 0 THEN l_extendedprice * l_quantity END) / sum(CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END), 4) AS price_mean, round(sum(l_tax), 4) AS tax_sum,
  min(l_orderkey) AS first_order, count(DISTINCT l_suppkey) AS supplier_count FROM lineitem GROUP BY 1, 2""")
def weighted_aggregate(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({"price": F.expr("CASE WHEN l_linenumber % 3 <> 0 THEN l_extendedprice END"), "tax": F.col("l_tax"), "first_order": F.col("l_orderkey"), "supplier": F.col("l_suppkey")})
    out = aggregate.weighted_aggregate(df, ["l_returnflag", "l_linestatus"], "l_quantity", ["price"], ["tax"], ["first_order"], ["supplier"], F.col("l_orderkey"))
    return out.withColumns({"price_mean": F.round("price_mean", 4), "tax_sum": F.round("tax_sum", 4)})


@query("""SELECT p_brand, string_agg(p_type || ' (' || round(share * 100)::INTEGER || '%)', '; ' ORDER BY n DESC, p_type) AS p_type_shares FROM (
  SELECT p_brand, p_type, n, n / sum(n) OVER (PARTITION BY p_brand) AS share, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS k FROM (SELECT p_brand, p_type, count(*)::DOUBLE AS n FROM part WHERE p_type <> 'BRASS' GROUP BY 1, 2)) WHERE k <= 3 GROUP BY 1""")
def value_shares(spark, sf):
    return aggregate.value_shares(table(spark, sf, "part"), "p_brand", "p_type", 3, ("BRASS",))


@query("SELECT o_custkey, string_agg(o_orderpriority, ' | ' ORDER BY o_orderkey) AS o_orderpriority_list, count(*) AS o_orderpriority_count FROM orders GROUP BY 1")
def joined_values(spark, sf):
    return aggregate.joined_values(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


SCALE = dict(k="c_custkey", v="CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END")


@query(f"""WITH d AS (SELECT * FROM {select("customer", **SCALE)}), f AS (SELECT k, coalesce(v, (SELECT median(v) FROM d)) AS v FROM d), q AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM f)
  SELECT k, round((least(greatest(v, lo), hi) - lo) / (hi - lo), 6) AS s FROM f, q""")
def robust_scale(spark, sf):
    return aggregate.robust_scale(table(spark, sf, "customer", **SCALE), "v", "s").select("k", F.round("s", 6).alias("s"))


@query("""WITH h AS (SELECT *, row_number() OVER (ORDER BY d DESC NULLS LAST, k) AS r, count(*) OVER () AS n FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate END AS d FROM orders))
  SELECT k, CASE WHEN r <= greatest(1, ceil(n * 0.1)) THEN 'holdout_new_game' ELSE 'qualified_historical' END AS role FROM h""")
def holdout_roles(spark, sf):
    return likeitems.roles(table(spark, sf, "orders", k="o_orderkey", d="CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate END"), "k", "d").select("k", "role")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS k FROM events) WHERE k = 1")
def latest_row(spark, sf):
    return clean.first_per_key(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type")


@query("SELECT o_orderstatus AS cluster, count(*) AS size, sum((o_totalprice > 100000)::INTEGER)::BIGINT AS big_count, min(o_orderdate)::DATE::VARCHAR AS min_d, max(o_orderdate)::DATE::VARCHAR AS max_d, median(o_custkey)::DOUBLE AS median_age FROM orders GROUP BY 1")
def cluster_profile(spark, sf):
    df = table(spark, sf, "orders", cluster="o_orderstatus", big="o_totalprice > 100000", d="CAST(CAST(o_orderdate AS DATE) AS STRING)", age="o_custkey")
    return aggregate.cluster_profile(df, "cluster", "big", "d", "age")


SUPPLY = dict(cabinet="l_partkey", supplier="CASE WHEN l_linenumber % 2 = 0 THEN 'base' ELSE 's' || CAST(l_suppkey % 5 AS STRING) END")


@query(f"""WITH c AS (SELECT cabinet, supplier, count(*) AS n FROM {select("lineitem", **SUPPLY)} GROUP BY 1, 2), m AS (SELECT cabinet, max(n) AS most, count(*) AS k, arg_min(supplier, (-n, supplier)) AS s FROM c GROUP BY 1),
  t AS (SELECT c.cabinet, count(*) > 1 AS tied FROM c JOIN m ON c.cabinet = m.cabinet AND n = most GROUP BY 1)
  SELECT m.cabinet, CASE WHEN NOT tied THEN s END AS canonical_supplier, most AS supplier_rows, k AS observed_supplier_count, CASE WHEN tied THEN 'tied' ELSE 'resolved' END AS canonical_supplier_status, k > 1 AS cross_supplier_cabinet FROM m JOIN t USING (cabinet)""")
def canonical_suppliers(spark, sf):
    return suppliers.canonical_suppliers(table(spark, sf, "lineitem", **SUPPLY), "cabinet", "supplier")


@query(f"""WITH c AS (SELECT cabinet, supplier, count(*) AS n FROM {select("lineitem", **SUPPLY)} GROUP BY 1, 2), m AS (SELECT cabinet, max(n) AS most, arg_min(supplier, (-n, supplier)) AS s FROM c GROUP BY 1),
  t AS (SELECT c.cabinet, any_value(s) AS s FROM c JOIN m ON c.cabinet = m.cabinet AND n = most GROUP BY 1 HAVING count(*) = 1)
  SELECT coalesce(t.s, d.supplier) AS supplier, count(*) AS rows FROM {select("lineitem", **SUPPLY)} d LEFT JOIN t ON d.cabinet = t.cabinet GROUP BY 1""")
def apply_canonical_suppliers(spark, sf):
    df = table(spark, sf, "lineitem", **SUPPLY)
    fixed = suppliers.apply_canonical(df, suppliers.canonical_suppliers(df, "cabinet", "supplier"), "cabinet", "supplier")
    return fixed.groupBy("supplier").agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT cabinet, supplier, count(*) AS rows FROM {select('lineitem', **SUPPLY)} WHERE cabinet IN (SELECT cabinet FROM {select('lineitem', **SUPPLY)} GROUP BY 1 HAVING count(DISTINCT supplier) > 1) GROUP BY 1, 2")
def cross_supplier_report(spark, sf):
    return suppliers.cross_supplier_report(table(spark, sf, "lineitem", **SUPPLY), "cabinet", "supplier")


@query("SELECT lower(trim(n_name)) AS the_name, n_nationkey AS nation_key FROM nation")
def bronze_clean(spark, sf):
    return suppliers.bronze_clean(table(spark, sf, "nation", a="'  ' || upper(n_name) || ' '", b="n_nationkey").toDF("The-Name", " Nation  Key"))


@query("SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice * o_custkey) / sum(o_custkey), 4) AS price_mean, count(DISTINCT o_custkey) AS customer_count FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1, 2")
def aggregate_performance(spark, sf):
    df = table(spark, sf, "orders").withColumns({"price": F.col("o_totalprice"), "customer": F.col("o_custkey")})
    kept, _ = suppliers.aggregate_performance(df, ["o_orderstatus", "o_orderpriority"], "o_custkey", ["price"], [], [], ["customer"], F.col("o_orderkey"), F.col("o_orderkey") % 5 == 0)
    return kept.withColumn("price_mean", F.round("price_mean", 4))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS excluded_rows FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1, 2")
def excluded_performance(spark, sf):
    df = table(spark, sf, "orders")
    return suppliers.aggregate_performance(df, ["o_orderstatus", "o_orderpriority"], "o_custkey", [], ["o_totalprice"], [], [], F.col("o_orderkey"), F.col("o_orderkey") % 5 == 0)[1]
