"""Queries of joins, upserts, incremental loads and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions.scalars import correction
from brindle.operators import impute, incremental, joins
from brindle.plans.registry import query, select, table

MAP = dict(bp="upper(p_name)", c="CASE WHEN p_partkey % 11 = 0 THEN 'x?' ELSE CAST(p_partkey AS STRING) END", e="p_brand")


@query(f"""SELECT a.theme_name, a.p_brand, m.bp, m.correction, f.game_name, f.d AS min_l_shipdate FROM (SELECT lower(p_name) AS theme_name, p_brand FROM part) a
  JOIN (SELECT bp, CASE WHEN contains(c, '?') THEN 'no_match' ELSE c END AS correction FROM {select("part", **MAP)}) m ON a.theme_name = lower(m.bp)
  JOIN (SELECT l_partkey::VARCHAR AS game_name, min(l_shipdate)::DATE::VARCHAR AS d FROM lineitem GROUP BY 1) f ON m.correction = f.game_name""")
def gold_first_date_join(spark, sf):
    attributes = table(spark, sf, "part", theme_name="lower(p_name)", p_brand="p_brand")
    mapping = table(spark, sf, "part", **MAP).select("bp", correction("c", "e").alias("correction"))
    facts = table(spark, sf, "lineitem", game_name="CAST(l_partkey AS STRING)", l_shipdate="CAST(CAST(l_shipdate AS DATE) AS STRING)")
    return joins.gold_join(attributes, mapping, facts, "theme_name", "bp", "correction", "game_name", "l_shipdate")


LEFT = dict(k="CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END", s="o_orderstatus", v="o_orderkey")
NAMES = dict(k="CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey END", n="c_name")


@query(f"SELECT l.k::VARCHAR AS k, l.s, l.v, r.m FROM {select('orders', **LEFT)} l LEFT JOIN (SELECT k, max(n) AS m FROM {select('customer', **NAMES)} GROUP BY k) r ON l.k IS NOT DISTINCT FROM r.k")
def null_safe_left_join(spark, sf):
    right = table(spark, sf, "customer", **NAMES).groupBy("k").agg(F.max("n").alias("m"))
    return joins.null_safe_join(table(spark, sf, "orders", **LEFT), right, ["k"]).withColumn("k", F.col("k").cast("string"))


@query("SELECT o_custkey, o_orderkey, f.p FROM orders LEFT JOIN (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1) f USING (o_custkey)")
def keyed_first_lookup(spark, sf):
    o = table(spark, sf, "orders")
    return joins.left_lookup(o.select("o_custkey", "o_orderkey"), o.select("o_custkey", F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("k")), ["o_custkey"], [F.col("k")]).drop("k")


SIDE_A, SIDE_B = dict(k="CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END", a="c_name"), dict(k="s_suppkey * 2", b="s_name")


@query(f"""SELECT coalesce(l.k, r.k)::VARCHAR AS k, a, b, CASE WHEN r.b IS NULL THEN 'left_only' WHEN l.a IS NULL THEN 'right_only' ELSE 'both' END AS source FROM {select("customer", **SIDE_A)} l FULL JOIN {select("supplier", **SIDE_B)} r ON l.k = r.k""")
def provenance_join(spark, sf):
    return joins.provenance_join(table(spark, sf, "customer", **SIDE_A), table(spark, sf, "supplier", **SIDE_B), "k").withColumn("k", F.col("k").cast("string"))


@query(f"""SELECT source, count(*) AS keys, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percent FROM (
  SELECT CASE WHEN r.k IS NULL THEN 'left_only' WHEN l.k IS NULL THEN 'right_only' ELSE 'both' END AS source FROM (SELECT DISTINCT k FROM {select("customer", **SIDE_A)} WHERE k IS NOT NULL) l FULL JOIN (SELECT DISTINCT k FROM {select("supplier", **SIDE_B)} WHERE k IS NOT NULL) r ON l.k = r.k) GROUP BY source""")
def match_coverage(spark, sf):
    return joins.coverage(table(spark, sf, "customer", **SIDE_A), table(spark, sf, "supplier", **SIDE_B), "k")


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS ordered FROM customer")
def semi_and_anti(spark, sf):
    c, o = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return joins.matched(c, o, "c_custkey").withColumn("ordered", F.lit(True)).unionByName(joins.unmatched(c, o, "c_custkey").withColumn("ordered", F.lit(False)))


@query("""SELECT x, count(*) AS rows, count(*) FILTER (WHERE a = b) AS same, min(a) AS a, max(b) AS b FROM (SELECT lower(trim('  ' || p_brand)) AS x, p_name AS a FROM part) l JOIN (SELECT lower(p_brand) AS y, p_name AS b FROM part) r ON l.x = r.y GROUP BY 1""")
def join_on_normalized_text(spark, sf):
    l = table(spark, sf, "part", x="'  ' || upper(p_brand)", a="p_name")
    r = table(spark, sf, "part", y="p_brand", b="p_name")
    return joins.text_join_summary(l.withColumn("x", F.lower(F.trim("x"))), r, "x", "y", "a", "b")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::VARCHAR AS l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST) AS k
  FROM lineitem) WHERE k = 1""")
def dedup_latest(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    shown = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return incremental.dedup_latest(rows, ["l_orderkey", "l_linenumber"], "l_shipdate").withColumn("l_shipdate", shown)


@query("""SELECT user_id, event_id, d::VARCHAR AS d FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d DESC NULLS LAST, event_id DESC NULLS LAST) AS k
  FROM (SELECT user_id, event_id, CASE WHEN event_id % 7 <> 0 THEN DATE '2024-01-01' + (event_id % 5)::INT END AS d FROM events)) WHERE k = 1""")
def dedup_latest_of_ties(spark, sf):
    """Most rows of a key share their stamp, and some have none."""
    rows = table(spark, sf, "events", user_id="user_id", event_id="event_id", d="CASE WHEN event_id % 7 <> 0 THEN date_add(DATE'2024-01-01', CAST(event_id % 5 AS INT)) END")
    return incremental.dedup_latest(rows, ["user_id"], "d").withColumn("d", F.col("d").cast("string"))


@query("SELECT event_id, user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 2 = 0)")
def after_high_water_mark(spark, sf):
    e = table(spark, sf, "events")
    mark = incremental.max_mark(e.where("event_id % 2 = 0"), "TS")
    return incremental.after_mark(e, "ts", mark).select("event_id", "user_id")


TARGET = dict(k="CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey END", g="o_orderkey", s="o_orderstatus", p="o_totalprice")
SOURCE = dict(k="CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey END", g="CASE WHEN o_orderkey % 10 = 3 THEN o_orderkey + 100000000 ELSE o_orderkey END", s="CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'new' END", p="-o_totalprice")
_UPSERT = """SELECT coalesce(t.k, s.k)::VARCHAR AS k, coalesce(t.g, s.g) AS g, CASE WHEN s.g IS NOT NULL THEN s.s ELSE t.s END AS s, {p} AS p FROM {target} t FULL JOIN (SELECT * FROM {source} WHERE g % 3 = 0) s ON t.k IS NOT DISTINCT FROM s.k AND t.g IS NOT DISTINCT FROM s.g"""


@query(_UPSERT.format(p="CASE WHEN s.g IS NOT NULL THEN s.p ELSE t.p END", target=select("orders", **TARGET), source=select("orders", **SOURCE)))
def upsert(spark, sf):
    return joins.upsert(table(spark, sf, "orders", **TARGET), table(spark, sf, "orders", **SOURCE).where("g % 3 = 0"), ["K", "g"]).withColumn("k", F.col("k").cast("string"))


@query(_UPSERT.format(p="CASE WHEN t.g IS NOT NULL THEN t.p ELSE s.p END", target=select("orders", **TARGET), source=select("orders", **SOURCE)))
def upsert_some_columns(spark, sf):
    return joins.upsert(table(spark, sf, "orders", **TARGET), table(spark, sf, "orders", **SOURCE).where("g % 3 = 0"), ["k", "g"], "s").withColumn("k", F.col("k").cast("string"))


HOLES = dict(k="p_partkey", b="CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_brand END", t="CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_type END", s="CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'size ' || CAST(p_size AS STRING) END")
_MODE = "(SELECT {g}, {v} AS m FROM (SELECT {g}, {v}, row_number() OVER (PARTITION BY {g} ORDER BY count(*) DESC, {v}) AS r FROM d WHERE {v} IS NOT NULL AND {g} IS NOT NULL GROUP BY {g}, {v}) WHERE r = 1)"


@query(f"""WITH d AS (SELECT * FROM {select("part", **HOLES)}) SELECT d.k, d.b, coalesce(d.t, tb.m) AS t, coalesce(d.s, sb.m, st.m) AS s FROM d
  LEFT JOIN {_MODE.format(g="b", v="t")} tb ON d.b = tb.b LEFT JOIN {_MODE.format(g="b", v="s")} sb ON d.b = sb.b LEFT JOIN {_MODE.format(g="t", v="s")} st ON coalesce(d.t, tb.m) = st.t""")
def impute_by_groups(spark, sf):
    return impute.impute_by_groups(table(spark, sf, "part", **HOLES), ["t", "s"], ["b", "t"])


@query(f"""WITH d AS (SELECT * FROM {select("part", **HOLES)}) SELECT d.k, d.b, coalesce(d.t, tb.m) AS t, coalesce(d.s, sb.m, st.m) AS s FROM d
  LEFT JOIN {_MODE.format(g="b", v="t")} tb ON d.b = tb.b LEFT JOIN {_MODE.format(g="b", v="s")} sb ON d.b = sb.b LEFT JOIN {_MODE.format(g="t", v="s")} st ON d.t = st.t""")
def impute_before_its_group(spark, sf):
    """s comes first, so a row without t gets no s by t, though t is filled later."""
    return impute.impute_by_groups(table(spark, sf, "part", **HOLES), ["s", "t"], ["b", "t"])


@query(f"""WITH d AS (SELECT * FROM {select("part", **HOLES)}),
 m1 AS (SELECT b, t, s AS m FROM (SELECT b, t, s, row_number() OVER (PARTITION BY b, t ORDER BY count(*) DESC, s) AS r FROM d WHERE s IS NOT NULL GROUP BY b, t, s) WHERE r = 1),
 e AS (SELECT d.k, d.b, d.t, coalesce(d.s, m1.m) AS s FROM d LEFT JOIN m1 ON d.b IS NOT DISTINCT FROM m1.b AND d.t IS NOT DISTINCT FROM m1.t),
 m2 AS (SELECT b, s AS m FROM (SELECT b, s, row_number() OVER (PARTITION BY b ORDER BY count(*) DESC, s) AS r FROM e WHERE s IS NOT NULL GROUP BY b, s) WHERE r = 1)
 SELECT e.k, e.b, e.t, coalesce(e.s, m2.m) AS s FROM e LEFT JOIN m2 ON e.b IS NOT DISTINCT FROM m2.b""")
def impute_by_hierarchy(spark, sf):
    return impute.impute_by_hierarchy(table(spark, sf, "part", **HOLES), "s", ["b", "t", "s"])[0]


@query(f"""WITH d AS (SELECT * FROM {select('part', **HOLES)}),
 m1 AS (SELECT b, t, s AS m FROM (SELECT b, t, s, row_number() OVER (PARTITION BY b, t ORDER BY count(*) DESC, s) AS r FROM d WHERE s IS NOT NULL GROUP BY b, t, s) WHERE r = 1),
 e AS (SELECT d.k, d.b, d.t, d.s IS NULL AND m1.m IS NOT NULL AS f1, coalesce(d.s, m1.m) AS s FROM d LEFT JOIN m1 ON d.b IS NOT DISTINCT FROM m1.b AND d.t IS NOT DISTINCT FROM m1.t),
 m2 AS (SELECT b, s AS m FROM (SELECT b, s, row_number() OVER (PARTITION BY b ORDER BY count(*) DESC, s) AS r FROM e WHERE s IS NOT NULL GROUP BY b, s) WHERE r = 1)
 SELECT 'b,t' AS keys, count(*) FILTER (WHERE f1) AS filled FROM e UNION ALL SELECT 'b', count(*) FILTER (WHERE e.s IS NULL AND m2.m IS NOT NULL) FROM e LEFT JOIN m2 ON e.b IS NOT DISTINCT FROM m2.b""")
def imputed_by_level(spark, sf):
    """How many nulls each level of the hierarchy fills."""
    _, counts = impute.impute_by_hierarchy(table(spark, sf, "part", **HOLES), "s", ["b", "t", "s"])
    return spark.createDataFrame([(",".join(c["keys"]), c["filled"]) for c in counts], "keys string, filled long")


@query(f"SELECT count(*) FILTER (WHERE b IS NULL) AS b, count(*) FILTER (WHERE s IS NULL) AS s FROM {select('part', **HOLES)}")
def remaining_nulls(spark, sf):
    return impute.remaining_nulls(table(spark, sf, "part", **HOLES), ["b", "s"])


@query("""SELECT o.o_orderkey AS pk, o.game, o.cabinet, m.theme, a.theme_key::VARCHAR AS theme_key, a.color, s.total AS qty_total FROM (SELECT o_orderkey, o_custkey AS game, o_orderpriority AS cabinet FROM orders) o
  LEFT JOIN (SELECT c_custkey AS game, '1-URGENT' AS cabinet, c_mktsegment AS theme FROM customer) m ON o.game = m.game AND o.cabinet = m.cabinet
  LEFT JOIN (SELECT lower(c_mktsegment) AS theme, min(c_nationkey) AS theme_key, 'c' AS color FROM customer GROUP BY 1) a ON lower(m.theme) = a.theme
  LEFT JOIN (SELECT l_linenumber AS theme_key, sum(l_quantity) AS total FROM lineitem GROUP BY 1) s ON a.theme_key = s.theme_key""")
def joined_data(spark, sf):
    perf = table(spark, sf, "orders", pk="o_orderkey", game="o_custkey", cabinet="o_orderpriority")
    mapping = table(spark, sf, "customer", game="c_custkey", cabinet="'1-URGENT'", theme="c_mktsegment")
    attributes = table(spark, sf, "customer").groupBy(F.upper("c_mktsegment").alias("theme")).agg(F.min("c_nationkey").alias("theme_key")).withColumn("color", F.lit("c"))
    sales = table(spark, sf, "lineitem", theme_key="l_linenumber", qty="l_quantity")
    return joins.joined_data(perf, mapping, attributes, sales, "game", "cabinet", "theme", "theme_key", "qty").withColumn("theme_key", F.col("theme_key").cast("string"))
