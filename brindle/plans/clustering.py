"""Queries of features, distances, linkage and like items."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import aggregate, clean, cluster, features, flow, likeitems
from brindle.plans.registry import query, select, table


def _clean(c: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(lower({c}), '[ \\t\\r\\n]+', ' ', 'g')), ''), '__missing__')"


@query(f"""SELECT p_partkey AS id, 'cat__p_type_' || {_clean("p_type")} AS feature, 3.0::DOUBLE AS value FROM part
  UNION ALL SELECT p_partkey, 'bool__big', 2.0 FROM part WHERE p_size > 25
  UNION ALL SELECT p_partkey, '__profile_bias', 0.01 FROM part""")
def weighted_features(spark, sf):
    df = table(spark, sf, "part", k="p_partkey", p_type="p_type", big="CASE WHEN p_size > 25 THEN 'yes' WHEN p_size > 10 THEN 'no' END", constant="'true'")
    return features.feature_table(df, "k", {"p_type": 1.5, "absent": 9.0}, {"big": 1.0, "constant": 4.0})


@query("""WITH d AS (SELECT p_partkey AS id, ln(1 + greatest(p_retailprice, 0)) AS v FROM part), q AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM d)
  SELECT id, 'num__price_bet' AS feature, round((least(greatest(v, lo), hi) - lo) / (hi - lo) * 2.4, 6) AS value FROM d, q WHERE v > lo""")
def numeric_features(spark, sf):
    return features.numeric(table(spark, sf, "part", id="p_partkey", price_bet="p_retailprice"), "id", "price_bet", 1.2).withColumn("value", F.round("value", 6))


@query("""WITH t AS (SELECT DISTINCT p_partkey AS id, unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+')) AS token FROM part),
  k AS (SELECT token, count(*) AS n FROM t WHERE length(token) >= 3 AND NOT regexp_full_match(token, '[0-9]+') AND token NOT IN ('the', 'new', 'standard') GROUP BY 1 HAVING n >= 2 AND n <= (SELECT floor(count(*) * 0.55) FROM part) ORDER BY n DESC, token LIMIT 140)
  SELECT id, 'token__' || token AS feature, 1.4::DOUBLE AS value FROM t JOIN k USING (token)""")
def token_features(spark, sf):
    return features.token_block(table(spark, sf, "part"), "p_partkey", ["p_name", "p_type"])


@query("""WITH c AS (SELECT c_custkey AS id, CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'rare ' || c_custkey ELSE lower(c_mktsegment) END AS s, c_custkey % 3 = 0 AS b, greatest(c_acctbal, 0) AS v FROM customer), t AS (SELECT count(*) AS n FROM c),
  q AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM c),
  f AS (SELECT CASE WHEN s IS NULL THEN '__missing__' WHEN s LIKE 'rare%' THEN '__other__' ELSE s END AS value, 'c_mktsegment' AS source, 'categorical' AS kind, 3.0::DOUBLE AS w, 3.0::DOUBLE AS x FROM c
    UNION ALL SELECT 'flag_b', 'flag_b', 'boolean', 1.0, 1.0 FROM c WHERE b
    UNION ALL SELECT 'balance', 'balance', 'numeric', 2.0, (least(greatest(v, lo), hi) - lo) / (hi - lo) * 2.0 FROM c, q WHERE v > lo
    UNION ALL SELECT 'bias', '__profile_bias', 'bias', 0.01, 0.01 FROM c),
  g AS (SELECT value, source, kind, w, count(*) AS active, sum(x) AS total, max(x) AS top FROM f GROUP BY ALL)
  SELECT CASE kind WHEN 'categorical' THEN 'cat__c_mktsegment_' || value WHEN 'boolean' THEN 'bool__flag_b' WHEN 'numeric' THEN 'num__balance' ELSE '__profile_bias' END AS feature_column,
    CASE kind WHEN 'categorical' THEN 'C Mktsegment' || CASE WHEN starts_with(value, '__') THEN '' ELSE ': ' || upper(value[1]) || value[2:] END WHEN 'boolean' THEN 'Flag B' WHEN 'numeric' THEN 'Balance' ELSE 'Profile bias' END AS friendly_feature_name,
    source AS source_column, CASE kind WHEN 'categorical' THEN 'C Mktsegment' WHEN 'boolean' THEN 'Flag B' WHEN 'numeric' THEN 'Balance' ELSE '  Profile Bias' END AS friendly_source_name, CASE WHEN source = 'c_mktsegment' THEN 'semantic_theme_category' ELSE kind END AS feature_group, kind AS feature_type, value AS feature_value,
    CASE kind WHEN 'bias' THEN w ELSE w / 2 END AS base_weight, CASE kind WHEN 'bias' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS multiplier, w AS final_weight, active AS active_count, round(active / n, 6) AS active_rate, round(total / n, 6) AS mean_weighted_value, round(top, 6) AS max_weighted_value,
    value IN ('__missing__', '__other__') AS is_missing_or_other, kind <> 'bias' AND value NOT IN ('__missing__', '__other__') AS is_reportable FROM g, t""")
def feature_metadata(spark, sf):
    """All sixteen columns, for categories with missing and rare levels, a boolean, a number and the bias."""
    df = table(spark, sf, "customer", id="c_custkey", c_mktsegment="CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'rare ' || c_custkey ELSE c_mktsegment END", flag_b="CASE WHEN c_custkey % 3 = 0 THEN 'yes' END", balance="greatest(c_acctbal, 0)", constant="'a'")
    long = features.feature_table(df, "id", {"c_mktsegment": 1.5, "constant": 1.0}, {"flag_b": 0.5}, {"balance": 1.0})
    meta = features.feature_metadata(long, df.count(), ("forbidden",), {"c_mktsegment": 1.5, "flag_b": 0.5, "balance": 1.0}, theme_column="c_mktsegment")
    return meta.withColumns({c: F.round(c, 6) for c in ("active_rate", "mean_weighted_value", "max_weighted_value")})


@query("""SELECT a.vec_id AS i, b.vec_id AS j, round(1 - list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 6) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id""")
def cosine_distances(spark, sf):
    rows = table(spark, sf, "embeddings", id="vec_id", vector="embedding")
    return cluster.pair_distances(rows).withColumn("distance", F.round("distance", 6))


@query(f"""WITH t AS (SELECT s_suppkey AS id, 'nation_' || s_nationkey AS f, 1.5::DOUBLE AS v FROM supplier UNION ALL SELECT s_suppkey, 'balance', s_acctbal / 1000 FROM supplier WHERE s_acctbal <> 0 UNION ALL SELECT s_suppkey, 'bias', 0.5 FROM supplier),
  q AS (SELECT id, sqrt(sum(v * v)) AS s FROM t GROUP BY 1), p AS (SELECT a.id AS i, b.id AS j, sum(a.v * b.v) AS d FROM t a JOIN t b ON a.f = b.f AND a.id < b.id GROUP BY 1, 2)
  SELECT i, j, round(greatest(0, 1 - d / (x.s * y.s)), 6) AS distance FROM p JOIN q x ON x.id = i JOIN q y ON y.id = j""")
def sparse_cosine_distances(spark, sf):
    """Cosine distances of sparse rows: memory by values, not by features."""
    s = table(spark, sf, "supplier", id="s_suppkey", nation="CONCAT('nation_', s_nationkey)", balance="s_acctbal")
    cells = F.array(F.struct(F.col("nation").alias("feature"), F.lit(1.5).alias("value")), F.struct(F.lit("balance").alias("feature"), (F.col("balance") / 1000).cast("double").alias("value")), F.struct(F.lit("bias").alias("feature"), F.lit(0.5).alias("value")))
    long = s.select("id", F.inline(cells))
    return cluster.pair_distances(cluster.sparse_rows(long)).withColumn("distance", F.round("distance", 6))


@query("""WITH g AS (SELECT label AS cluster, c.i AS feature, avg(embedding[c.i]::DOUBLE) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS i) c GROUP BY 1, 2),
  a AS (SELECT c.i AS feature, avg(embedding[c.i]::DOUBLE) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS i) c GROUP BY 1)
  SELECT cluster::BIGINT AS cluster, 'f' || lpad(feature::VARCHAR, 2, '0') AS feature, round(g.m, 6) AS cluster_mean, round(a.m, 6) AS global_mean FROM g JOIN a USING (feature)""")
def feature_lift(spark, sf):
    e = table(spark, sf, "embeddings")
    long = e.select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("at", "v")).select("id", F.concat(F.lit("f"), F.lpad((F.col("at") + 1).cast("string"), 2, "0")).alias("feature"), F.col("v").cast("double").alias("value"))
    out = aggregate.lift(long, e.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("cluster")))
    return out.select("cluster", "feature", F.round("cluster_mean", 6).alias("cluster_mean"), F.round("global_mean", 6).alias("global_mean"))


def _items(spark, sf):
    e = table(spark, sf, "embeddings", vec="vec_id", vector="embedding", d="date_add(DATE'2020-01-01', CAST(vec_id * 37 % 1500 AS INT))")
    return clean.dense_ids(e, [F.col("vec")], "id").select("id", "vector", "d")


@query()
def complete_linkage(spark, sf):
    return cluster.linkage(_items(spark, sf))


@query()
def flat_clusters(spark, sf):
    return cluster.clusters(cluster.keep_tree(cluster.linkage(_items(spark, sf))), 8)


@query()
def elbow_scores(spark, sf):
    items = _items(spark, sf)
    return cluster.elbow(items, cluster.keep_tree(cluster.linkage(items)))


@query()
def like_items(spark, sf):
    items = _items(spark, sf)
    tree = cluster.keep_tree(cluster.linkage(items))
    role = likeitems.roles(items, "id", "d").select("id", "role")
    return likeitems.like_items(tree, role, items.select("id", "vector"), cluster.clusters(tree, 8))


@query()
def like_items_grouped(spark, sf):
    return likeitems.grouped_mapping(like_items(spark, sf))


# The same steps after a tree that SQL can write down: blocks of 2, 4, 8, ... items in order of their ids.


def block_tree(spark, n: int):
    """Merges of n items (merge_step, left_id, right_id, merge_distance, size): two neighbouring blocks of each level become one of the next; a last
    block without a neighbour goes up as it is. The driver only holds a number per level."""
    out, blocks, first, last, height = None, n, 0, n - 1, 0
    while blocks > 1:
        height, pairs = height + 1, blocks // 2
        child = lambda i, blocks=blocks, first=first, last=last: F.when(i == blocks - 1, last).otherwise(i + first)
        made = n if height == 1 else upto
        b = F.col("id")
        size = F.least(F.lit(1 << height), F.lit(n) - b * (1 << height))
        level = spark.range(pairs).select((b + (made - n)).alias("merge_step"), child(b * 2).cast("long").alias("left_id"), child(b * 2 + 1).cast("long").alias("right_id"), F.lit(float(height)).alias("merge_distance"), size.cast("long").alias("size"))
        out = level if out is None else out.unionByName(level)
        last = last if blocks % 2 else made + pairs - 1
        first, upto, blocks = made, made + pairs, pairs + blocks % 2
    return out if out is not None else spark.createDataFrame([], "merge_step bigint, left_id bigint, right_id bigint, merge_distance double, size bigint")


def _given(spark, sf):
    items = _items(spark, sf)
    tree = block_tree(spark, items.count())
    role = likeitems.roles(items, "id", "d").select("id", "role")
    return items, tree, role


#: Items 0..n-1 with their blocks at each level, and whether each is of the holdout.
_BLOCKS = """items AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, embedding AS v, DATE '2020-01-01' + (vec_id * 37 % 1500)::INT AS d FROM embeddings),
  role AS (SELECT id, row_number() OVER (ORDER BY d DESC, id) <= greatest(1, ceil(count(*) OVER () * 0.1)) AS held FROM items),
  levels AS (SELECT id, l, id // (1 << l) AS b FROM items, (SELECT unnest(range(0, 24)) AS l)),
  blocks AS (SELECT l, b, count(*) AS size, count(*) FILTER (WHERE NOT held) AS hist FROM levels JOIN role USING (id) GROUP BY 1, 2)"""
_LIKE = f"""{_BLOCKS},
  chosen AS (SELECT id, min(l) AS l FROM levels JOIN blocks USING (l, b) JOIN role USING (id) WHERE held AND hist > 0 GROUP BY 1),
  found AS (SELECT t.id AS target_id, h.id AS like_id, t.l, k.size, k.hist FROM chosen t JOIN levels a ON a.id = t.id AND a.l = t.l JOIN levels h ON h.l = t.l AND h.b = a.b JOIN role r ON r.id = h.id AND NOT r.held JOIN blocks k ON k.l = t.l AND k.b = a.b),
  far AS (SELECT f.*, greatest(0, 1 - list_dot_product(x.v::DOUBLE[], y.v::DOUBLE[]) / sqrt(list_dot_product(x.v::DOUBLE[], x.v::DOUBLE[]) * list_dot_product(y.v::DOUBLE[], y.v::DOUBLE[]))) AS dist FROM found f JOIN items x ON x.id = target_id JOIN items y ON y.id = like_id)"""


@query(f"""WITH {_LIKE}
  SELECT target_id, like_id, row_number() OVER (PARTITION BY target_id ORDER BY round(dist, 9), like_id) AS candidate_rank, round(dist, 6) AS pair_distance, round(greatest(0, least(1, 1 - dist)), 6) AS similarity_score,
    l::DOUBLE AS merge_distance, 0.0::DOUBLE AS merge_similarity_score, size AS smallest_qualifying_cluster_size, hist AS qualifying_historical_in_cluster, target_id // 64 = like_id // 64 AS same_flat_cluster FROM far""")
def like_items_of_given_tree(spark, sf):
    items, tree, role = _given(spark, sf)
    cut = items.select("id", F.floor(F.col("id") / 64).alias("cluster"))
    out = likeitems.like_items(tree, role, items.select("id", "vector"), cut).drop("smallest_qualifying_cluster_node_id")
    return out.withColumns({c: F.round(c, 6) for c in ("pair_distance", "similarity_score")})


@query(f"""WITH {_LIKE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY round(dist, 9), like_id) AS candidate_rank FROM far)
  SELECT target_id, like_id, candidate_rank, round(dist, 6) AS pair_distance, size AS smallest_qualifying_cluster_size, hist AS qualifying_historical_in_cluster FROM ranked WHERE candidate_rank <= 3""")
def nearest_like_items_of_given_tree(spark, sf):
    """At most three like items a target."""
    items, tree, role = _given(spark, sf)
    out = likeitems.like_items(tree, role, items.select("id", "vector"), items.select("id", F.lit(0).alias("cluster")), limit=3)
    return out.select("target_id", "like_id", "candidate_rank", F.round("pair_distance", 6).alias("pair_distance"), "smallest_qualifying_cluster_size", "qualifying_historical_in_cluster")


@query(f"""WITH {_LIKE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY round(dist, 9), like_id) AS k, greatest(0, least(1, 1 - dist)) AS sim FROM far)
  SELECT r.target_id, (t.d)::VARCHAR AS target_release_date, string_agg(r.like_id::VARCHAR, ' | ' ORDER BY k) AS like_ids, string_agg(CASE WHEN r.like_id % 3 = 0 THEN 'nan' ELSE 'theme ' || (r.like_id % 7)::VARCHAR END, ' | ' ORDER BY k) AS like_themes,
    string_agg('nan', ' | ' ORDER BY k) AS like_names, count(*) AS n_like, round(max(sim), 6) AS best_similarity, round(avg(sim), 6) AS mean_similarity
  FROM ranked r JOIN items t ON t.id = r.target_id GROUP BY 1, 2""")
def like_items_grouped_of_given_tree(spark, sf):
    items, tree, role = _given(spark, sf)
    cut = items.select("id", F.lit(0).alias("cluster"))
    profiles = items.select("id", F.col("d").cast("string").alias("release_date"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("theme "), (F.col("id") % 7).cast("string"))).alias("theme_name_friendly"))
    mapping = likeitems.with_attributes(likeitems.like_items(tree, role, items.select("id", "vector"), cut), profiles)
    out = likeitems.grouped_mapping(mapping, ("target_release_date",))
    return out.withColumns({c: F.round(c, 6) for c in ("best_similarity", "mean_similarity")})


@query(f"""WITH {_BLOCKS} SELECT id, k AS cluster FROM levels JOIN (SELECT b, row_number() OVER (ORDER BY size DESC, b) AS k FROM blocks WHERE l = 6) USING (b) WHERE l = 6""")
def flat_clusters_of_given_tree(spark, sf):
    items, tree, _ = _given(spark, sf)
    return cluster.clusters(tree, -(-items.count() // 64))


@query("""WITH u AS (SELECT vec_id AS id, i, embedding[i]::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS v FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)),
  c AS (SELECT k, id % k AS cluster, i, v FROM u, (SELECT unnest(range(2, 17)) AS k)),
  p AS (SELECT k, cluster, i, sum(v * v) AS q, sum(v) AS s, count(*) AS n FROM c GROUP BY 1, 2, 3),
  e AS (SELECT k, sum(q - s * s / n) AS sse, count(DISTINCT cluster) AS a, min(n) AS lo, max(n) AS hi FROM p GROUP BY 1),
  w AS (SELECT *, first(a) OVER z AS x1, last(a) OVER z AS x2, first(sse) OVER z AS y1, last(sse) OVER z AS y2, lag(sse) OVER (ORDER BY k) - sse AS down FROM e WINDOW z AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  SELECT k::INT AS requested_k, a AS actual_k, round(sse, 6) AS within_cluster_sse, lo AS min_cluster_size, hi AS max_cluster_size, round(down, 6) AS sse_drop, round(abs((x2 - x1) * (y1 - sse) - (y2 - y1) * (x1 - a)) / sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 6) AS elbow_distance_to_line FROM w""")
def cut_scores_of_given_cuts(spark, sf):
    rows = table(spark, sf, "embeddings", id="vec_id", vector="embedding")
    members = rows.select("id", F.transform(F.sequence(F.lit(2), F.lit(16)), lambda k: F.pmod(F.col("id"), k).cast("long")).alias("labels"))
    return cluster.cut_scores(rows, members, 2).withColumns({c: F.round(c, 6) for c in ("within_cluster_sse", "sse_drop", "elbow_distance_to_line")})


_FEATURES = """m AS (SELECT p_partkey AS id, p_size % 4 AS cluster, lower(p_type) AS t, lower(p_brand) AS b FROM part), size AS (SELECT cluster, count(*) AS n FROM m GROUP BY 1),
  f AS (SELECT id, cluster, 'cat__p_type_' || t AS feature, 'p_type' AS source FROM m UNION ALL SELECT id, cluster, 'cat__p_brand_' || b, 'p_brand' FROM m),
  g AS (SELECT feature, source, count(*) * 2.0::DOUBLE / (SELECT count(*) FROM m) AS mean FROM f GROUP BY 1, 2),
  l AS (SELECT size.cluster, g.feature, g.source, (SELECT count(*) FROM f WHERE f.cluster = size.cluster AND f.feature = g.feature) * 2.0::DOUBLE / size.n - g.mean AS lift FROM size, g)"""


def _lift(spark, sf):
    df = table(spark, sf, "part", id="p_partkey", p_type="p_type", p_brand="p_brand", size="p_size")
    long = features.feature_table(df, "id", {"p_type": 1.0, "p_brand": 1.0}).where(F.col("feature") != features.BIAS_FEATURE)
    lift = aggregate.lift(long, df.select("id", (F.col("size") % 4).cast("long").alias("cluster")))
    return lift.withColumns({"source_column": F.regexp_extract("feature", "^cat__(p_type|p_brand)_", 1), "is_reportable": F.lit(True)})


@query(f"""WITH {_FEATURES}, r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(lift, 9) DESC, feature) AS rank, max(lift) OVER (PARTITION BY cluster) AS top FROM l WHERE lift > 0)
  SELECT cluster::BIGINT AS cluster, feature, round(lift, 6) AS lift, rank::INT AS rank, lift >= greatest(0.02, top * 0.5) AS is_important FROM r WHERE (lift >= greatest(0.02, top * 0.5) OR rank <= 5) AND rank <= 12""")
def reportable_lift(spark, sf):
    return likeitems.reportable_lift(_lift(spark, sf), 0.02, 0.5, n=12).withColumn("lift", F.round("lift", 6))


@query(f"""WITH {_FEATURES}, r AS (SELECT *, row_number() OVER (PARTITION BY cluster, source ORDER BY round(lift, 9) DESC, feature) AS rank FROM l WHERE lift > 0)
  SELECT cluster::BIGINT AS cluster, feature, round(lift, 6) AS lift, rank::INT AS rank, (source <> 'p_type')::INT AS part FROM r WHERE rank <= CASE WHEN source = 'p_type' THEN 2 ELSE 4 END""")
def description_lift(spark, sf):
    return likeitems.description_lift(_lift(spark, sf), "p_type").drop("is_important").withColumn("lift", F.round("lift", 6))


@query()
def like_item_flow(spark, sf):
    """Suppliers as items, from their columns to the grouped mapping."""
    return flow.find_like_items(_suppliers(spark, sf), **_FLOW)["grouped"]


@query()
def cluster_summary(spark, sf):
    return flow.find_like_items(_suppliers(spark, sf), **_FLOW)["summary"]


_FLOW = dict(id_col="s_suppkey", date="release_date", categories={"game_type": 1.5, "product_family": 1.0}, booleans={"is_wap": 0.5}, numbers={"bet": 0.7}, texts=("theme_name",), k=8)


def _suppliers(spark, sf):
    return table(spark, sf, "supplier", s_suppkey="s_suppkey", theme_name="s_name", release_date="date_add(DATE'2020-01-01', CAST(s_suppkey * 37 % 1500 AS INT))", game_type="CONCAT('type ', s_nationkey % 5)", product_family="CONCAT('family ', s_nationkey)", is_wap="CASE WHEN s_suppkey % 3 = 0 THEN 'yes' ELSE 'no' END", bet="s_acctbal")


#: Attributes of parts and a relation map of line items, with dirt in keys, dates, methods and flags.
ATTRIBUTES = dict(
    theme_name="p_name", theme_name_friendly="CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE ' Part  ' || CAST(p_partkey AS STRING) END", game_type="p_type", product_family="p_brand",
    game_matrix="""CASE p_partkey % 3 WHEN 0 THEN '["Bingo Hall", "reels"]' WHEN 1 THEN 'lottery; x' END""", audit_is_deleted="CASE WHEN p_partkey % 13 = 0 THEN 'Y' ELSE 'n' END",
    na_release_date="CASE WHEN p_partkey % 2 = 0 THEN CAST(date_add(DATE'2015-01-01', CAST(p_partkey % 900 AS INT)) AS STRING) ELSE 'soon' END", apac_release_date="CASE WHEN p_partkey % 5 = 0 THEN '2014-06-01' END",
)
RELATIONS = dict(
    theme_name_friendly="'part ' || CAST(l_partkey AS STRING)", perf_game_name="'Game ' || CAST(l_suppkey AS STRING)", match_score="CAST(l_quantity AS STRING)", game_release_date="CAST(CAST(l_shipdate AS DATE) AS STRING)",
    match_method="CASE l_linenumber % 4 WHEN 0 THEN 'raw_exact' WHEN 1 THEN 'no_match' WHEN 2 THEN 'Basic_Clean_Exact' ELSE 'weak_review_only' END",
)
_ATTR = select("part", **ATTRIBUTES, apart="p_partkey").replace("date_add(DATE'2015-01-01', CAST(p_partkey % 900 AS INT))", "(DATE '2015-01-01' + (p_partkey % 900)::INT)").replace("STRING", "VARCHAR")


@query(f"""WITH r AS (SELECT theme_name_friendly AS k, lower(perf_game_name) AS name, lower(match_method) AS m, match_score::DOUBLE AS s, game_release_date::DATE AS d, CASE lower(match_method) WHEN 'raw_exact' THEN 1 WHEN 'basic_clean_exact' THEN 2 ELSE 99 END AS p FROM {select("lineitem", **RELATIONS).replace("STRING", "VARCHAR")}),
  o AS (SELECT * FROM r WHERE m NOT IN ('no_match', 'weak_review_only')),
  b AS (SELECT k, arg_min(name, (p, -s, name)) AS best, count(DISTINCT name) AS n, arg_min(s, (p, -s, name)) AS score, arg_min(d, (p, -s, name, d)) AS matched FROM o GROUP BY 1),
  ns AS (SELECT k, string_agg(name, ' | ' ORDER BY i) AS names FROM (SELECT k, name, row_number() OVER (PARTITION BY k ORDER BY min((p, -s, name))) AS i FROM o GROUP BY 1, 2) WHERE i <= 8 GROUP BY 1),
  a AS (SELECT *, 'part ' || apart::VARCHAR AS join_key, try_cast(na_release_date AS DATE) AS na, apac_release_date::DATE AS ap FROM {_ATTR} WHERE trim(theme_name_friendly) <> '' AND audit_is_deleted <> 'Y'),
  j AS (SELECT a.*, b.*, ns.names, least(na, ap, matched) AS released FROM a JOIN b ON join_key = b.k JOIN ns ON ns.k = b.k),
  l AS (SELECT *, max(released) OVER () AS latest FROM j)
  SELECT join_key, row_number() OVER (ORDER BY apart) - 1 AS profile_id, best AS best_historical_game_name, names AS historical_game_names, n AS historical_candidate_count, score AS best_match_score, released::VARCHAR AS profile_release_date,
    ((year(latest) - year(released)) * 12 + month(latest) - month(released))::INT AS release_age_months, (apart % 3 = 0)::INT::DOUBLE AS attr_matrix_token_bingo, (apart % 3 = 1)::INT::DOUBLE AS attr_matrix_token_lottery FROM l""")
def item_profiles(spark, sf):
    """Attributes joined to the profile of their relation rows, with dates, ages and flags."""
    out = flow.profiles(table(spark, sf, "part", **ATTRIBUTES, apart="p_partkey"), table(spark, sf, "lineitem", **RELATIONS), ["apart"])
    return out.select("join_key", "profile_id", "best_historical_game_name", "historical_game_names", "historical_candidate_count", "best_match_score", F.col("profile_release_date").cast("string").alias("profile_release_date"), "release_age_months", "attr_matrix_token_bingo", "attr_matrix_token_lottery")


@query("""WITH m AS (SELECT s_suppkey AS id, s_suppkey % 3 AS cluster, s_suppkey % 5 = 0 AS held, DATE '2020-01-01' + (s_suppkey * 37 % 1500)::INT AS d, s_suppkey * 7 % 40 AS age, 'type ' || (s_suppkey % 4) AS t FROM supplier),
  s AS (SELECT cluster, t, count(*) AS n FROM m GROUP BY 1, 2), z AS (SELECT cluster, count(*) AS n FROM m GROUP BY 1), a AS (SELECT t, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM m) AS share FROM m GROUP BY 1),
  top AS (SELECT cluster, string_agg(t || ' (' || round(n * 100.0 / all_n)::INT || '%)', '; ' ORDER BY k) AS shares FROM (SELECT s.cluster, t, s.n, z.n AS all_n, row_number() OVER (PARTITION BY s.cluster ORDER BY s.n DESC, t) AS k FROM s JOIN z ON z.cluster = s.cluster) WHERE k <= 3 GROUP BY 1),
  lifts AS (SELECT z.cluster, a.t, 3.0::DOUBLE * coalesce(s.n, 0) / z.n - 3.0::DOUBLE * a.share AS lift FROM z CROSS JOIN a LEFT JOIN s ON s.cluster = z.cluster AND s.t = a.t),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(lift, 9) DESC, t) AS k FROM lifts)
  SELECT m.cluster AS cluster_id, count(*) AS profile_count, count(*) FILTER (WHERE held) AS holdout_count, count(*) FILTER (WHERE NOT held) AS historical_count, min(d)::VARCHAR AS min_release_date, max(d)::VARCHAR AS max_release_date, median(age)::DOUBLE AS median_release_age_months,
    any_value(shares) AS top_game_type, any_value((SELECT string_agg('game type ' || t, '; ' ORDER BY k) FROM ranked r WHERE r.cluster = m.cluster AND k <= 3)) AS top_distinguishing_features,
    coalesce(any_value((SELECT string_agg('Game Type: Type ' || t[6:], '; ' ORDER BY k) FROM ranked r WHERE r.cluster = m.cluster AND lift > 0 AND k <= 2)), NULL) AS cluster_description
  FROM m JOIN top ON top.cluster = m.cluster GROUP BY 1""")
def cluster_summary_of_given_cut(spark, sf):
    """The summary over a cut that SQL can write down, with the description by reportable lift."""
    s = table(spark, sf, "supplier", id="s_suppkey", cluster="s_suppkey % 3", role=f"CASE WHEN s_suppkey % 5 = 0 THEN '{likeitems.HOLDOUT}' ELSE '{likeitems.HISTORICAL}' END", d="date_add(DATE'2020-01-01', CAST(s_suppkey * 37 % 1500 AS INT))", release_age_months="s_suppkey * 7 % 40", game_type="'type ' || CAST(s_suppkey % 4 AS STRING)")
    long = features.feature_table(s, "id", {"game_type": 1.5})
    meta = features.feature_metadata(long, s.count(), weights={"game_type": 1.5})
    out = flow.summary(s, long, "d", 3, meta, 0.02, 0.5, "game_type")
    return out.withColumns({c: F.col(c).cast("string") for c in ("min_release_date", "max_release_date")}).drop("important_features")


@query()
def classical_scaling(spark, sf):
    return cluster.classical_scaling(_items(spark, sf))


@query()
def weighted_clusters(spark, sf):
    """Euclidean complete linkage of the weighted features of suppliers; one feature has no weight and one weight no feature."""
    s = table(spark, sf, "supplier", id="s_suppkey - 1", nation="s_nationkey", balance="s_acctbal")
    long = s.select("id", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), v.cast("double").alias("value")) for n, v in (("nation", F.col("nation")), ("balance", F.col("balance") / 1000), ("unused", F.col("id")))])).alias("f")).select("id", "f.*")
    return cluster.weighted_clusters(long, {"nation": 1.0, "balance": 2.0, "absent": 3.0})
