"""U: projections, cleaning and normalising."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import exprs as X
from millrace.operators import cleaning
from millrace.plans.registry import query
from millrace.sources.tables import table

# Raw tags and the standard ones they stand for.
STANDARD = [("ECONOMY", "cheap"), ("SMALL", "compact"), ("STANDARD", "plain"), ("PROMO", "cheap")]


@query("u1_list_or_scalar", "SELECT event_id, event_type || ' ' || user_id AS joined, CAST(user_id AS VARCHAR) AS single FROM events")
def u1(spark, d):
    parts = F.array("event_type", F.col("user_id").cast("string"))
    return table(spark, d, "events").select("event_id", cleaning.joined(parts).alias("joined"), cleaning.joined(F.array(F.col("user_id").cast("string"))).alias("single"))


@query("u2_region_join", "SELECT event_id, CASE WHEN trim(event_type) <> '' THEN event_type || ',' ELSE '' END || user_id AS regions FROM events")
def u2(spark, d):
    parts = F.array("event_type", F.lit(" "), F.col("user_id").cast("string"))
    return table(spark, d, "events").select("event_id", F.array_join(F.filter(parts, lambda x: F.trim(x) != ""), ",").alias("regions"))


@query("u3_clean_text", "SELECT doc_id, md5(trim(replace(text, '[ ]', ''), ' ')) AS digest, trim(replace(text, '[ ]', ''), ' ') = '' AS empty FROM documents")
def u3(spark, d):
    t = F.trim(F.replace("text", F.lit("[ ]"), F.lit("")))
    return table(spark, d, "documents").select("doc_id", F.md5(t.cast("binary")).alias("digest"), (t == "").alias("empty"))


@query("u4_safe_int", "SELECT c_custkey, CAST(greatest(0, trunc(c_acctbal)) AS BIGINT) AS amount FROM customer")
def u4(spark, d):
    messy = F.concat(F.lit(" "), F.format_number("c_acctbal", 2), F.lit(" "))
    return table(spark, d, "customer").select("c_custkey", X.safe_int(messy).alias("amount"))


@query("u5_first_digits", "SELECT p_partkey, CAST(nullif(regexp_extract(p_brand || 'x7', '([0-9]+)', 1), '') AS BIGINT) AS number FROM part")
def u5(spark, d):
    return table(spark, d, "part").select("p_partkey", X.first_digits(F.concat("p_brand", F.lit("x7"))).alias("number"))


@query("u6_rename_map", """
SELECT c_custkey AS id, c_name AS title, c_nationkey || ',' || c_mktsegment AS tags, '{"balance":"' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || '"}' AS detail FROM customer""")
def u6(spark, d):
    detail = F.to_json(F.struct(F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("balance")))
    tags = F.array_join(F.array(F.col("c_nationkey").cast("string"), "c_mktsegment"), ",")
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), tags.alias("tags"), detail.alias("detail"))


@query("u7_compact", """
SELECT c_custkey, '{' || CASE WHEN c_acctbal > 0 THEN '"name":"' || c_name || '",' ELSE '' END || '"segment":"' || c_mktsegment || '"}' AS document FROM customer""")
def u7(spark, d):
    fields = {"name": F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(""), "segment": F.col("c_mktsegment")}
    return table(spark, d, "customer").select("c_custkey", cleaning.compact(fields).alias("document"))


@query("u8_json_keys", """
SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS value FROM events""")
def u8(spark, d):
    doubled = F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', " k ": ""}'))
    return cleaning.clean_keys(table(spark, d, "events").select("event_id", doubled.alias("props")), "event_id", "props")


@query("u9_tags", """
SELECT event_id, CASE WHEN event_type = CAST(user_id AS VARCHAR) THEN event_type ELSE event_type || ',' || user_id END AS tags FROM events""")
def u9(spark, d):
    user = F.col("user_id").cast("string")
    listed = F.to_json(F.array("event_type", user, F.col("event_type")))
    plain = F.concat_ws(" , ", "event_type", user, F.lit(""), "event_type")
    raw = F.when(F.col("event_id") % 2 == 0, listed).otherwise(plain)
    return table(spark, d, "events").select("event_id", F.array_join(X.distinct_tags(raw), ",").alias("tags"))


@query("u10_standard_tags", """
SELECT p_partkey, array_to_string(list_sort(list_distinct([CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'SMALL' THEN 'compact' WHEN 'STANDARD' THEN 'plain' WHEN 'PROMO' THEN 'cheap' ELSE 'other' END, 'other'])), ',') AS tags FROM part""")
def u10(spark, d):
    raw = F.concat_ws(",", "p_type", "p_brand")
    return table(spark, d, "part").select("p_partkey", F.array_join(cleaning.standard_tags(raw, dict(STANDARD)), ",").alias("tags"))


@query("u11_two_sources", """
SELECT 'order' AS origin, o_orderkey AS id, o_orderdate AS at, o_totalprice AS amount, NULL AS kind FROM orders
UNION ALL SELECT 'event', event_id, ts, value, event_type FROM events""")
def u11(spark, d):
    orders = table(spark, d, "orders").select(F.lit("order").alias("origin"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"), F.col("o_totalprice").alias("amount"))
    events = table(spark, d, "events").select(F.lit("event").alias("origin"), F.col("event_id").alias("id"), F.col("ts").alias("at"), F.col("value").alias("amount"), F.col("event_type").alias("kind"))
    return orders.unionByName(events, allowMissingColumns=True)


@query("u12_nested_projection", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.a.b') AS b FROM events")
def u12(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.a.b").alias("b"))


@query("u13_truncate", "SELECT doc_id, substr(text, 1, 80) AS head FROM documents")
def u13(spark, d):
    return table(spark, d, "documents").select("doc_id", F.substring("text", 1, 80).alias("head"))


@query("u14_labelled_text", """
SELECT doc_id, concat_ws(chr(10), CASE WHEN lang <> '' THEN 'language: ' || lang END, CASE WHEN source <> 'src0' THEN 'source: ' || source END, 'text: ' || substr(text, 1, 200)) AS prompt FROM documents""")
def u14(spark, d):
    fields = [F.when(F.col("lang") != "", F.concat(F.lit("language: "), "lang")), F.when(F.col("source") != "src0", F.concat(F.lit("source: "), "source"))]
    return table(spark, d, "documents").select("doc_id", F.concat_ws("\n", *fields, F.concat(F.lit("text: "), F.substring("text", 1, 200))).alias("prompt"))


@query("u15_range_pair", "SELECT p_partkey, p_size AS low, p_size + 5 AS high FROM part")
def u15(spark, d):
    pair = F.array("p_size", F.col("p_size") + 5)
    return table(spark, d, "part").select("p_partkey", F.element_at(pair, 1).alias("low"), F.element_at(pair, 2).alias("high"))


@query("u16_merged_tags", """
SELECT p_brand, string_agg(tag, ',' ORDER BY tag) AS tags FROM (SELECT DISTINCT p_brand, unnest(string_split(p_name, ' ') || [p_type]) AS tag FROM part) GROUP BY 1""")
def u16(spark, d):
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit("，"), "p_type")).otherwise(F.concat("p_type", F.lit("、"), "p_name"))
    return cleaning.merge_tags(table(spark, d, "part").withColumn("raw", raw), "p_brand", "raw")


@query("u17_first_appearance", """
SELECT p_brand, string_agg(p_type, '/' ORDER BY first) AS tags FROM (SELECT p_brand, p_type, min(p_partkey) AS first FROM part GROUP BY 1, 2) GROUP BY 1""")
def u17(spark, d):
    return cleaning.tags_in_order(table(spark, d, "part"), "p_brand", "p_type", "p_partkey")
