"""C: change tracking, history and merges. The second version of a table is derived from the first."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes as C
from millrace.plans.registry import query
from millrace.sources.tables import scratch, table
from millrace.streaming import jobs as J
from millrace.streaming import merges

_V2 = """(SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders)"""
_CHANGES = " UNION ALL ".join(
    f"SELECT a.o_orderkey AS id, '{f}' AS field, coalesce(a.{f}, '') AS before, coalesce(b.{f}, '') AS after FROM orders a JOIN {_V2} b USING (o_orderkey) WHERE coalesce(a.{f}, '') <> coalesce(b.{f}, '')"
    for f in ("o_orderstatus", "o_orderpriority")
)


def _versions(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    new = old.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    return old, new.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_orderpriority")))


@query("c1_field_changes", _CHANGES)
def c1(spark, d):
    return C.field_changes(*_versions(spark, d), "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("c2_history_rows", f"SELECT id, field, after AS value, o_orderdate AS uptime FROM ({_CHANGES}) JOIN orders ON o_orderkey = id")
def c2(spark, d):
    old, new = _versions(spark, d)
    return C.field_changes(old, new, "o_orderkey", ["o_orderstatus", "o_orderpriority"], "o_orderdate").select("id", "field", F.col("after").alias("value"), "uptime")


@query("c3_capped_history", """
WITH s AS (SELECT user_id, event_type, ts, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM s WHERE before IS NULL OR before <> event_type)
SELECT user_id, string_agg(event_type || '@' || event_id, ',' ORDER BY ts, event_id) AS history FROM c WHERE r <= 10 GROUP BY 1""")
def c3(spark, d):
    out = C.capped_history(table(spark, d, "events"), "user_id", "event_type", ["ts", "event_id"], 10)
    return out.select("user_id", F.array_join(F.transform("history", lambda h: F.concat(h["value"], F.lit("@"), h["event_id"])), ",").alias("history"))


_UPDATES = """(SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'N' || c_name ELSE '' END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE '' END AS segment FROM customer WHERE c_custkey % 4 < 3
  UNION ALL SELECT -1 - c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 50 = 0)"""


def _updates(spark, d):
    c = table(spark, d, "customer")
    known = c.where("c_custkey % 4 < 3").select(
        "c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("N"), "c_name")).otherwise("").alias("c_name"), F.when(F.col("c_custkey") % 3 == 0, "MOVED").otherwise("").alias("c_mktsegment")
    )
    new = c.where("c_custkey % 50 = 0").select((-1 - F.col("c_custkey")).alias("c_custkey"), "c_name", "c_mktsegment")
    return c.select("c_custkey", "c_name", "c_mktsegment"), known.unionByName(new)


@query("c4_upsert", f"""
SELECT coalesce(c_custkey, k) AS c_custkey, coalesce(nullif(name, ''), c_name) AS c_name, coalesce(nullif(segment, ''), c_mktsegment) AS c_mktsegment FROM customer FULL JOIN {_UPDATES} ON c_custkey = k""")
def c4(spark, d):
    return C.upsert(*_updates(spark, d), "c_custkey")


@query("c4_bucket_merge", f"""
SELECT coalesce(c_custkey, k) AS c_custkey, coalesce(nullif(name, ''), c_name) AS c_name, coalesce(nullif(segment, ''), c_mktsegment) AS c_mktsegment FROM customer FULL JOIN {_UPDATES} ON c_custkey = k""")
def c4b(spark, d):
    old, updates = _updates(spark, d)
    target, out = scratch(spark, "target"), scratch(spark, "merge")
    merges.create(old, target, "c_custkey", 16)
    turns = J.spooled_in_turn([updates.where(F.pmod("c_custkey", F.lit(2)) == k) for k in range(2)], scratch(spark, "updates"))
    merges.merge_stream(spark, turns, target, "c_custkey", 16, out, files=1)
    return merges.read(spark, target)


@query("c6_bucket_counts", f"SELECT CASE WHEN c_custkey IS NULL THEN 'insert' ELSE 'update' END AS action, count(*) AS n FROM {_UPDATES} LEFT JOIN customer ON c_custkey = k GROUP BY 1")
def c6b(spark, d):
    old, updates = _updates(spark, d)
    target = scratch(spark, "target")
    merges.create(old, target, "c_custkey", 16)
    turns = J.spooled_in_turn([updates], scratch(spark, "updates"))
    return merges.merge_stream(spark, turns, target, "c_custkey", 16, scratch(spark, "merge"))


@query("c5_replace", """
SELECT o_orderkey, arg_max(o_orderstatus, v) AS o_orderstatus FROM (SELECT o_orderkey, o_orderstatus, 1 AS v FROM orders UNION ALL SELECT o_orderkey, 'X', 2 FROM orders WHERE o_orderkey % 5 = 0) GROUP BY 1""")
def c5(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return C.replace(old, old.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])


@query("c6_upsert_counts", f"SELECT CASE WHEN c_custkey IS NULL THEN 'insert' ELSE 'update' END AS action, count(*) AS n FROM {_UPDATES} LEFT JOIN customer ON c_custkey = k GROUP BY 1")
def c6(spark, d):
    return C.plan(*_updates(spark, d), "c_custkey").groupBy("action").agg(F.count("*").alias("n"))


@query("c7_valid_history", """
SELECT o_custkey, count(*) AS entries FROM orders WHERE o_orderpriority <> '' AND o_orderdate IS NOT NULL GROUP BY 1 HAVING bool_or(o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01')""")
def c7(spark, d):
    entries = table(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("value"), F.col("o_orderdate").alias("updated_at"))
    return C.valid_entries(entries, "o_custkey", "1998-01-01", "1999-01-01")


@query("c8_dry_run", f"""
SELECT count(*) FILTER (c_custkey IS NOT NULL AND (name <> '' OR segment <> '')) AS updates, count(*) FILTER (c_custkey IS NULL) AS inserts, count(*) FILTER (c_custkey IS NOT NULL AND name = '' AND segment = '') AS unchanged FROM {_UPDATES} LEFT JOIN customer ON c_custkey = k""")
def c8(spark, d):
    old, updates = _updates(spark, d)
    p = C.plan(old, updates, "c_custkey")
    touched = (F.col("c_name") != "") | (F.col("c_mktsegment") != "")
    update = F.col("action") == "update"
    return p.agg(F.count_if(update & touched).alias("updates"), F.count_if(~update).alias("inserts"), F.count_if(update & ~touched).alias("unchanged"))


@query("c9_history_of_key", f"SELECT id, field, after AS value, o_orderdate AS uptime FROM ({_CHANGES}) JOIN orders ON o_orderkey = id WHERE id = 35 ORDER BY uptime DESC, field")
def c9(spark, d):
    old, new = _versions(spark, d)
    history = C.field_changes(old, new, "o_orderkey", ["o_orderstatus", "o_orderpriority"], "o_orderdate")
    return history.where("id = 35").orderBy(F.desc("uptime"), "field").select("id", "field", F.col("after").alias("value"), "uptime")
