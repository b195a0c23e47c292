"""W and S: windows, first and latest rows, and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregation as A
from millrace.operators import sets as S
from millrace.plans.registry import query
from millrace.sources.tables import table


@query("w1_first_per_key", "SELECT user_id, event_type, arg_min(event_id, epoch_us(ts) * 1000000 + event_id) AS event_id FROM events GROUP BY 1, 2".replace("epoch_us(ts) * 1000000 + event_id", "(ts, event_id)"))
def w1(spark, d):
    return A.top_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], 1).select("user_id", "event_type", "event_id")


@query("w2_prefer_hits", """
SELECT conv_id, turn, hit FROM (SELECT conv_id, turn, contains(text, 'the') AS hit, row_number() OVER (PARTITION BY conv_id ORDER BY contains(text, 'the') DESC, turn, role) AS r FROM conversations) WHERE r <= 3""")
def w2(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", F.contains("text", F.lit("the")).alias("hit"))
    return A.top_per_key(rows, ["conv_id"], [F.desc("hit"), "turn", "role"], 3).select("conv_id", "turn", "hit")


@query("w3_latest_change", """
SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS value, max(o_orderdate) AS updated_at FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AND o_orderpriority <> '' GROUP BY 1""")
def w3(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("value"), F.col("o_orderdate").alias("updated_at"), F.col("o_orderkey").alias("id"))
    return S.latest_change(orders, "o_custkey", "1996-01-01", "1999-01-01")


@query("w4_first_days", """
SELECT user_id, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS days FROM (SELECT user_id, day, row_number() OVER (PARTITION BY user_id ORDER BY day) AS r FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)) WHERE r <= 5 GROUP BY 1""")
def w4(spark, d):
    days = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    first = A.top_per_key(days, ["user_id"], ["day"], 5)
    return first.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_list("day")), ",").alias("days"))  # five at most


@query("w5_sorted_search", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def w5(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'O'").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100).select("o_orderkey", "o_orderdate")


@query("w6_priority_label", """
SELECT doc_id, CASE WHEN contains(text, '!!') THEN 'loud' WHEN contains(text, 'License') THEN 'legal' WHEN contains(text, '@') THEN 'contact' ELSE 'plain' END AS label FROM documents""")
def w6(spark, d):
    labels = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(p).alias("priority"), F.lit(n).alias("label"))) for p, n, c in (
        (3, "contact", F.contains("text", F.lit("@"))), (1, "loud", F.contains("text", F.lit("!!"))), (2, "legal", F.contains("text", F.lit("License"))), (9, "plain", F.lit(True)))]))
    return table(spark, d, "documents").select("doc_id", F.array_min(labels)["label"].alias("label"))


@query("w7_mixed_feed", """
WITH f AS (SELECT o_orderkey, 'ranked' AS pool FROM orders WHERE o_custkey % 10 <> 0 ORDER BY o_totalprice DESC, o_orderkey LIMIT 70),
g AS (SELECT o_orderkey, 'followed' AS pool FROM orders WHERE o_custkey % 10 = 0 ORDER BY o_orderdate DESC, o_orderkey LIMIT 30) FROM f UNION ALL FROM g""")
def w7(spark, d):
    orders = table(spark, d, "orders")
    return S.mixed_feed(orders.where("o_custkey % 10 <> 0"), [F.desc("o_totalprice"), "o_orderkey"], orders.where("o_custkey % 10 = 0"), [F.desc("o_orderdate"), "o_orderkey"], 100, 0.7).select("o_orderkey", "pool")


@query("w8_cap", "SELECT event_id FROM events ORDER BY ts, event_id LIMIT 1000")
def w8(spark, d):
    return table(spark, d, "events").orderBy("ts", "event_id").limit(1000).select("event_id")


@query("s1_union_strata", """
SELECT stratum, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM (SELECT 'legal' AS stratum, n_chars FROM documents WHERE contains(text, 'License') UNION ALL SELECT 'other', n_chars FROM documents WHERE NOT contains(text, 'License')) GROUP BY 1""")
def s1(spark, d):
    docs, legal = table(spark, d, "documents"), F.contains("text", F.lit("License"))
    strata = docs.where(legal).select(F.lit("legal").alias("stratum"), "n_chars").unionByName(docs.where(~legal).select(F.lit("other").alias("stratum"), "n_chars"))
    return strata.groupBy("stratum").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("s2_distinct_union", "SELECT source AS name FROM documents UNION SELECT event_type FROM events")
def s2(spark, d):
    return table(spark, d, "documents").select(F.col("source").alias("name")).union(table(spark, d, "events").select("event_type")).distinct()


@query("s3_day_difference", "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events EXCEPT SELECT CAST(ts AS DATE) FROM events WHERE user_id = 7")
def s3(spark, d):
    events = table(spark, d, "events")
    return S.days_left(events, events.where("user_id = 7"), "ts")


@query("s4_distinct_texts", "SELECT conv_id, count(DISTINCT text) AS texts FROM conversations GROUP BY 1 HAVING count(DISTINCT text) >= 4")
def s4(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.countDistinct("text").alias("texts")).where("texts >= 4")
