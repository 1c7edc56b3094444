"""Queries of cleaning, scalar and list operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import arrays, scalars
from brindle.functions.names import rename
from brindle.operators import clean, expand, likeitems
from brindle.plans.registry import query, select, table

MONEY = dict(k="c_custkey", v="CASE c_custkey % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN ' 12% ' WHEN 2 THEN '(5)' WHEN 3 THEN '$' || CAST(c_custkey AS STRING) WHEN 4 THEN NULL ELSE '1,' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') || '.5' END")


@query(f"""SELECT k, TRY_CAST(regexp_replace(trim(CASE WHEN v IN ('N/A') THEN NULL ELSE v END), '[,%]', '', 'g') AS DOUBLE) AS v,
                  TRY_CAST(regexp_replace(trim(v), '[$,%]', '', 'g') AS DOUBLE) AS w FROM {select("customer", **MONEY)}""")
def null_tokens_numeric_parse(spark, sf):
    df = table(spark, sf, "customer", **MONEY)
    both = clean.clean_columns(df.withColumn("raw", F.col("v")), numeric=["v"])
    return both.select("k", "v", F.col("raw")).withColumn("w", scalars.parse_number("raw", currency=True)).drop("raw")


TEXT = dict(k="o_orderkey", v="CASE o_orderkey % 7 WHEN 0 THEN '  ' || o_orderpriority || ' ' WHEN 1 THEN '123' WHEN 2 THEN '1.5' WHEN 3 THEN '-5' WHEN 4 THEN '1,234' WHEN 5 THEN ' Unknown' ELSE o_orderstatus END")


@query(f"""SELECT k, CASE WHEN regexp_full_match(lower(trim(v)), '[0-9]+(\\.[0-9]+)?') OR lower(trim(v)) = 'unknown' THEN NULL ELSE lower(trim(v)) END AS v,
                  CASE WHEN regexp_full_match(lower(trim(v)), '[0-9]+(\\.[0-9]+)?') THEN NULL ELSE lower(trim(v)) END AS w FROM {select("orders", **TEXT)}""")
def string_clean(spark, sf):
    return table(spark, sf, "orders", **TEXT).select("k", scalars.clean_text("v", ("unknown",)).alias("v"), scalars.clean_text("v", ("unknown",), recheck=False).alias("w"))


TOKENS = dict(k="o_orderkey", v="CASE o_orderkey % 5 WHEN 0 THEN ' - ' WHEN 1 THEN '-' WHEN 2 THEN 'null' ELSE ' ' || o_orderstatus END")


@query(f"SELECT k, CASE WHEN v IN ('-', 'null') THEN NULL ELSE v END AS v, CASE WHEN trim(v) IN ('-', 'null') THEN NULL ELSE v END AS w FROM {select('orders', **TOKENS)}")
def null_tokens(spark, sf):
    df = table(spark, sf, "orders", **TOKENS)
    exact = clean.null_tokens(df, ("-", "null"))
    return clean.null_tokens(df.withColumnRenamed("v", "w"), ("-", "null"), trimmed=True).join(exact, "k")


DATES = dict(k="o_orderkey", v="CASE o_orderkey % 5 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 1 THEN substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) WHEN 2 THEN '01/15/2024' WHEN 3 THEN 'Jan-24' END", d="CAST(o_orderdate AS DATE)")


@query(f"""SELECT k, CAST(CASE k % 5 WHEN 0 THEN d WHEN 1 THEN date_trunc('month', d) END AS DATE)::VARCHAR AS lenient,
                  CASE k % 5 WHEN 2 THEN '2024-01-15' END AS formatted FROM {select("orders", **DATES)}""")
def lenient_date(spark, sf):
    return table(spark, sf, "orders", **DATES).select("k", scalars.parse_date("v").cast("string").alias("lenient"), scalars.parse_date("v", "MM/dd/yyyy").cast("string").alias("formatted"))


PARTS = dict(k="p_partkey", a="CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END", b="CASE WHEN p_partkey % 2 = 0 THEN p_retailprice * 2 END", c="CAST(p_size AS DOUBLE)")


@query(f"SELECT k, coalesce(a, b, c) AS a, coalesce(NULL, b) AS z FROM {select('part', **PARTS)}")
def complementary_fill(spark, sf):
    return clean.fill_from(table(spark, sf, "part", **PARTS), {"a": ["b", "c", "absent"], "z": ["b"]}, drop=True)


BRANDS = dict(k="p_partkey", v="CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN '  ' || upper(p_brand) ELSE p_brand END")


@query(f"SELECT k, CASE lower(trim(v)) WHEN 'brand#1' THEN 'first' WHEN 'brand#11' THEN 'first' WHEN 'brand#23' THEN 'other' ELSE lower(trim(v)) END AS v FROM {select('part', **BRANDS)}")
def map_standardize(spark, sf):
    return table(spark, sf, "part", **BRANDS).select("k", scalars.lookup("v", {" Brand#1": "first", "BRAND#11 ": "first", "brand#23": "other"}).alias("v"))


OWN = dict(k="p_partkey", v="CASE p_partkey % 9 WHEN 0 THEN 'Not Owned' WHEN 1 THEN 'leased-own' WHEN 2 THEN 'Unknown' WHEN 3 THEN 'capital' WHEN 4 THEN NULL WHEN 5 THEN ' Owned' WHEN 6 THEN 'Lease' WHEN 7 THEN 'for sale' ELSE p_type END")


@query(f"""SELECT k, CASE WHEN lower(trim(v)) IN ('owned', 'for sale') THEN 'owned' WHEN lower(trim(v)) IN ('leased', 'lease', 'not owned') THEN 'leased' WHEN lower(trim(v)) LIKE '%leas%' OR lower(trim(v)) LIKE '%cap%' THEN 'leased'
                  WHEN lower(trim(v)) LIKE '%own%' AND lower(trim(v)) NOT LIKE '%lease%' THEN 'owned' END AS v FROM {select("part", **OWN)}""")
def rule_cascade(spark, sf):
    return table(spark, sf, "part", **OWN).select("k", scalars.ownership("v", ("owned", "for sale"), ("leased", "lease", "not owned"), ("leas", "cap"), ("own",)).alias("v"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def typo_map(spark, sf):
    return clean.clean_columns(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), typos={"o_orderstatus": {"F": "final", "O": "open"}})


@query("SELECT n_nationkey, n_name FROM nation")
def drop_all_null_columns(spark, sf):
    return clean.drop_all_null(table(spark, sf, "nation", n_nationkey="n_nationkey", n_name="n_name", empty="CAST(NULL AS STRING)"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def equality_filters(spark, sf):
    return clean.apply_filters(table(spark, sf, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}).select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey FROM customer WHERE lower(trim(c_mktsegment)) IN ('building', 'machinery')")
def allow_list_filter(spark, sf):
    return clean.keep_in(table(spark, sf, "customer"), "c_mktsegment", [" Building", "machinery"]).select("c_custkey")


@query(f"SELECT k, v FROM {select('part', **BRANDS)} WHERE v NOT IN ('Brand#11', 'Brand#12') OR v IS NULL")
def exclude_keep_null(spark, sf):
    return clean.exclude_in(table(spark, sf, "part", **BRANDS), "v", ["Brand#11", "Brand#12"])


DELETED = dict(k="c_custkey", v="CASE c_custkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'No' WHEN 2 THEN '2' WHEN 3 THEN NULL WHEN 4 THEN 'maybe' ELSE 'f' END")


@query(f"SELECT k, CASE k % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'true' WHEN 5 THEN 'false' END AS b FROM {select('customer', **DELETED)}")
def boolean_parse(spark, sf):
    return table(spark, sf, "customer", **DELETED).select("k", scalars.parse_bool("v").cast("string").alias("b"))


@query(f"SELECT k, v FROM {select('customer', **DELETED)} WHERE k % 6 NOT IN (0, 2)")
def soft_delete_filter(spark, sf):
    return clean.drop_deleted(table(spark, sf, "customer", **DELETED), "v")


@query("SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'building' THEN 'build' WHEN 'machinery' THEN 'machine' ELSE lower(c_mktsegment) END AS segment FROM customer")
def case_recode(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", scalars.recode("c_mktsegment", {"building": "build", "machinery": "machine"}).alias("segment"))


FIX = dict(k="p_partkey", v="CASE p_partkey % 5 WHEN 0 THEN 'Foo?' WHEN 1 THEN 'no match' WHEN 2 THEN NULL ELSE p_name END", f="p_brand")


@query(f"SELECT k, lower(CASE WHEN contains(v, '?') THEN 'no_match' WHEN v = 'no match' THEN 'no_match' WHEN v IS NULL THEN f ELSE v END) AS v FROM {select('part', **FIX)}")
def correction_rule(spark, sf):
    return table(spark, sf, "part", **FIX).select("k", scalars.correction("v", "f").alias("v"))


MESSY = dict(k="p_partkey", v="CASE p_partkey % 6 WHEN 0 THEN '  ' || upper(p_type) || '   x ' WHEN 1 THEN '   ' WHEN 2 THEN NULL WHEN 3 THEN '[''' || p_brand || ''']' ELSE p_type END")
NORM = "nullif(trim(regexp_replace(lower({}), '[ \\t\\r\\n]+', ' ', 'g')), '')"


@query(f"SELECT k, {NORM.format('v')} AS n, coalesce({NORM.format("regexp_replace(v, '[\\[\\](){}\"''\\\\]', '', 'g')".replace('{}', '{{}}').replace('{{}}', '{}'))}, '__missing__') AS c FROM {select('part', **MESSY)}")
def normalized_text(spark, sf):
    return table(spark, sf, "part", **MESSY).select("k", scalars.norm_text("v").alias("n"), scalars.clean_category("v").alias("c"))


@query(f"""SELECT k, CASE WHEN {NORM.format('v')} IS NULL THEN NULL WHEN {NORM.format('v')} = 'brass' THEN 'exact' WHEN {NORM.format('v')} LIKE '%steel%' THEN 'metal' WHEN {NORM.format('v')} LIKE '%s%' THEN 'has s' ELSE 'Other' END AS b FROM {select("part", **MESSY)}""")
def dictionary_bucket(spark, sf):
    return table(spark, sf, "part", **MESSY).select("k", scalars.bucket("v", {"steel": "metal", "s": "has s", "brass": "exact"}).alias("b"))


#: Words of the invented prose stand in for themes.
THEMES = {"small": ["the", "of"], "french": ["les", "dans"], "german": ["und", "der", "die"], "spanish": ["el", "los", "que"]}


def _has(words, plural=""):
    return f"regexp_matches(' ' || lower(text) || ' ', '[^a-z0-9]({'|'.join(words)}){plural}[^a-z0-9]')"


@query(f"""SELECT doc_id, CASE {' '.join(f"WHEN {_has(w)} THEN '{k}'" for k, w in THEMES.items())} ELSE 'none' END AS b,
       CASE {' '.join(f"WHEN {_has(w, 's?')} THEN array_to_string(list_filter([{', '.join(f"CASE WHEN {_has([x], 's?')} THEN '{x}' END" for x in w)}], lambda x: x IS NOT NULL), ',')" for k, w in THEMES.items())} ELSE '' END AS words FROM documents""")
def theme_bucket(spark, sf):
    df = clean.keyword_buckets(table(spark, sf, "documents"), ["text"], THEMES, "__b", "words")
    return df.select("doc_id", scalars.regex_bucket("text", THEMES, "none").alias("b"), F.replace("words", F.lit(", "), F.lit(",")).alias("words"))


#: Words of part names and types, with a keyword of two words, one with a sign, and plurals in the texts.
MATERIALS = {"plated": ["anodized-tin", "plated nickel"], "metals": ["brass", "copper", "steel", "tin", "nickel"], "colours": ["red", "green", "blue"]}
PART_TEXTS = dict(p_partkey="p_partkey", a="CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'nan' WHEN 2 THEN 'No theme here' ELSE p_type || 's' END", b="CASE WHEN p_partkey % 5 = 0 THEN 'Anodized, TIN!' WHEN p_partkey % 7 > 2 THEN p_name END")


@query(f"""WITH t AS (SELECT p_partkey, ' ' || trim(regexp_replace(concat_ws(' ', nullif(lower(trim(a)), 'nan'), nullif(lower(trim(b)), 'nan')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS x FROM {select("part", **PART_TEXTS)}),
  h AS (SELECT p_partkey, {", ".join(f"list_filter([{', '.join(repr(k) for k in words)}], lambda k: contains(x, ' ' || replace(k, '-', ' ') || ' ') OR contains(x, ' ' || replace(k, '-', ' ') || 's ')) AS {b}" for b, words in MATERIALS.items())} FROM t)
  SELECT p_partkey, CASE {" ".join(f"WHEN len({b}) > 0 THEN '{b}'" for b in MATERIALS)} ELSE '__missing__' END AS bucket, CASE {" ".join(f"WHEN len({b}) > 0 THEN array_to_string({b}[1:2], ', ')" for b in MATERIALS)} ELSE '' END AS keywords FROM h""")
def keyword_buckets(spark, sf):
    """The first bucket with a keyword in two normalized texts, and at most two of its keywords."""
    return clean.keyword_buckets(table(spark, sf, "part", **PART_TEXTS), ["a", "b"], MATERIALS, limit=2).select("p_partkey", "bucket", "keywords")


@query("""SELECT doc_id, len(t)::BIGINT AS n, array_to_string(t, ' ') AS t FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: length(x) >= 3 AND NOT regexp_full_match(x, '[0-9]+') AND x NOT IN ('the', 'and')) AS t FROM documents)""")
def tokenize(spark, sf):
    return table(spark, sf, "documents").select("doc_id", scalars.tokens("text", ("the", "and")).alias("t")).select("doc_id", F.size("t").cast("long").alias("n"), F.array_join("t", " ").alias("t"))


@query("""SELECT o_orderkey, ((year(m) - year(o_orderdate)) * 12 + month(m) - month(o_orderdate))::INTEGER AS release_age_months,
       CASE WHEN (year(m) - year(o_orderdate)) * 12 + month(m) - month(o_orderdate) < 6 THEN '0_5_months' WHEN (year(m) - year(o_orderdate)) * 12 + month(m) - month(o_orderdate) < 12 THEN '6_11_months'
            WHEN (year(m) - year(o_orderdate)) * 12 + month(m) - month(o_orderdate) < 24 THEN '12_23_months' WHEN (year(m) - year(o_orderdate)) * 12 + month(m) - month(o_orderdate) < 48 THEN '24_47_months'
            WHEN (year(m) - year(o_orderdate)) * 12 + month(m) - month(o_orderdate) < 84 THEN '48_83_months' ELSE '84_plus_months' END AS release_age_bucket FROM orders, (SELECT max(o_orderdate) AS m FROM orders)""")
def release_age(spark, sf):
    return likeitems.with_age(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "release_age_months", "release_age_bucket")


@query("SELECT l_orderkey, l_linenumber, round(ln(1 + greatest(l_extendedprice - 20000, 0)), 6) AS x, round(greatest(least(1 - l_discount * 12, 1), 0), 6) AS y FROM lineitem")
def log_and_clip(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(scalars.log1p_clip(F.col("l_extendedprice") - 20000), 6).alias("x"), F.round(scalars.clip01(1 - F.col("l_discount") * 12), 6).alias("y"))


SEVERAL = dict(k="o_orderkey", a="CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END", b="CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) - 10 END")


@query(f"SELECT k, least(a, b)::VARCHAR AS first FROM {select('orders', **SEVERAL)}")
def earliest_date(spark, sf):
    return likeitems.earliest(table(spark, sf, "orders", **SEVERAL), ["a", "b"], "first").select("k", F.col("first").cast("string").alias("first"))


LISTS = dict(k="p_partkey", v="CASE p_partkey % 5 WHEN 0 THEN '[''Bingo'', ''Lottery'']' WHEN 1 THEN '[\"P''s & Q\"]' WHEN 2 THEN '[]' WHEN 3 THEN NULL ELSE '[\"Bingo\", null]' END")


@query(f"SELECT k, k % 5 IN (0, 4) AS m_bingo, k % 5 = 0 AS m_lottery, k % 5 = 1 AS m_p_s_q, (CASE k % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 4 THEN 2 ELSE 0 END)::INTEGER AS n, k % 5 IN (0, 4) AS has_bin FROM {select('part', **LISTS)}")
def list_flags(spark, sf):
    df = table(spark, sf, "part", **LISTS).withColumn("a", arrays.parse_list("v"))
    return expand.flags(df, F.col("a"), "m").withColumns({"n": F.size("a"), "has_bin": arrays.any_item_contains(F.col("a"), "BIN")}).drop("v", "a")


LOOSE = dict(k="p_partkey", v="CASE p_partkey % 4 WHEN 0 THEN '[''a'', ''B'']' WHEN 1 THEN 'x; y |z,, x' WHEN 2 THEN NULL ELSE ' nan ' END")


@query(f"""SELECT k, CASE k % 4 WHEN 0 THEN 'a|B' WHEN 1 THEN 'x|y|z|x' WHEN 2 THEN '' ELSE 'nan' END AS loose,
       CASE k % 4 WHEN 0 THEN 'a|b' WHEN 1 THEN 'x|y|z|x' ELSE '' END AS parts, CASE k % 4 WHEN 0 THEN 'a + B' WHEN 1 THEN 'x + y + z' WHEN 2 THEN '' ELSE 'nan' END AS firsts FROM {select('part', **LOOSE)}""")
def loose_lists(spark, sf):
    a = arrays.lenient_list("v")
    return table(spark, sf, "part", **LOOSE).select("k", F.array_join(a, "|").alias("loose"), F.array_join(arrays.delimited("v", lower=True), "|").alias("parts"), arrays.join_distinct(a, 8, " + ").alias("firsts"))


@query("SELECT c_custkey AS id, 'cat__c_mktsegment_' || c_mktsegment AS feature, 1.5::DOUBLE AS value FROM customer")
def one_hot_long(spark, sf):
    return expand.one_hot_long(table(spark, sf, "customer"), "c_custkey", "c_mktsegment", 1.5)


@query("SELECT o_orderkey, (o_orderstatus = 'F')::INTEGER AS \"cat__o_orderstatus_F\", (o_orderstatus = 'O')::INTEGER AS \"cat__o_orderstatus_O\", (o_orderstatus = 'P')::INTEGER AS \"cat__o_orderstatus_P\" FROM orders")
def one_hot_wide(spark, sf):
    return expand.one_hot_wide(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"]).drop("o_orderstatus")


@query("SELECT r_regionkey AS region_key, lower(trim(r_name)) AS the_name FROM region")
def rename_and_normalize(spark, sf):
    return clean.normalize_text(rename(table(spark, sf, "region", **{"`Region / Key`": "r_regionkey", "`x`": "r_name"}).toDF("Region / Key", "x"), {"x": " The-Name "}))


@query("SELECT lower(p_brand) AS p_brand, lower(p_type) AS p_type FROM part")
def lower_projection(spark, sf):
    return clean.lower_only(table(spark, sf, "part"), ["p_brand", "p_type"])


@query("SELECT p_partkey, (row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1)::BIGINT AS profile_id FROM part")
def dense_row_id(spark, sf):
    return clean.dense_ids(table(spark, sf, "part"), [F.desc("p_retailprice"), F.col("p_partkey")]).select("p_partkey", "profile_id")


@query(rf"""SELECT p_partkey, CASE {' '.join(f"WHEN regexp_matches(t, '{chr(92)}b({'|'.join(w)}){chr(92)}b') THEN '{k}'" for k, w in scalars.THEME_BUCKETS.items())} ELSE 'uncategorized_theme' END AS theme
  FROM (SELECT p_partkey, lower(concat_ws(' ', p_name, CASE p_partkey % 9 WHEN 0 THEN 'Pirate' WHEN 1 THEN 'the king''s gold' WHEN 2 THEN 'catfish' WHEN 3 THEN 'multi game' WHEN 4 THEN 'snow-fire' WHEN 5 THEN 'aztec queen' END)) AS t FROM part)""")
def theme_of_several_columns(spark, sf):
    more = "CASE p_partkey % 9 WHEN 0 THEN 'Pirate' WHEN 1 THEN \"the king's gold\" WHEN 2 THEN 'catfish' WHEN 3 THEN 'multi game' WHEN 4 THEN 'snow-fire' WHEN 5 THEN 'aztec queen' END"
    return table(spark, sf, "part", p_partkey="p_partkey", a="p_name", b=more).select("p_partkey", scalars.theme("a", "b").alias("theme"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Mystery / Sci-Fi' WHEN 1 THEN 'Food / Drink' WHEN 2 THEN '' WHEN 3 THEN '' ELSE 'Two Words' END AS shown FROM part""")
def value_label(spark, sf):
    level = "CASE p_partkey % 5 WHEN 0 THEN ' Mystery_SciFi ' WHEN 1 THEN 'food_drink' WHEN 2 THEN 'None' WHEN 3 THEN NULL ELSE 'two_words' END"
    return table(spark, sf, "part", p_partkey="p_partkey", c=level).select("p_partkey", scalars.value_label("c").alias("shown"))
