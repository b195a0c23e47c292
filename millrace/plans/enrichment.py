"""J: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import exprs as X
from millrace.operators import enrichment as J
from millrace.plans.registry import query
from millrace.plans.routing import TARGETS
from millrace.sources.tables import table


@query("j1_enrich_empty", """
SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END, ''), c_mktsegment) AS tag, coalesce(c_name, '') AS name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def j1(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("tag"), F.lit("").alias("name"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("tag"), F.col("c_name").alias("name"))
    out = J.fill_empty(orders, customers, "key", ["tag", "name"])
    return out.select("o_orderkey", "tag", F.coalesce("name", F.lit("")).alias("name"))


@query("j1_fill_counts", """
SELECT count(*) AS n, count(*) FILTER (o_orderkey % 2 = 1 AND c_custkey IS NOT NULL) AS tags_filled FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def j1b(spark, d):
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.agg(F.count("*").alias("n"), X.count_of((F.col("o_orderkey") % 2 == 1) & F.col("c_custkey").isNotNull()).alias("tags_filled"))


_MATCH = """
WITH wanted AS (SELECT o_orderkey AS k, CAST(o_orderkey % 9 AS INT) AS line FROM orders),
exact AS (SELECT k, line, min(l_partkey) AS part FROM wanted JOIN lineitem ON l_orderkey = k AND l_linenumber = line GROUP BY 1, 2),
fallback AS (SELECT w.k, w.line, arg_min(l_partkey, l_linenumber * 10000000 + l_partkey) AS part FROM wanted w JOIN lineitem ON l_orderkey = w.k
  WHERE NOT EXISTS (FROM exact e WHERE e.k = w.k AND e.line = w.line) GROUP BY 1, 2)
"""


@query("j2_two_step_match", _MATCH + "SELECT k, line, part, 'exact' AS matched_by FROM exact UNION ALL SELECT k, line, part, 'key' FROM fallback")
def j2(spark, d):
    wanted = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 9).cast("int").alias("line"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"))
    return J.match_in_two_steps(wanted, items, "k", "line", "part")


@query("j3_existence", """
SELECT count(*) AS customers, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) AS present,
  round(count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) / count(*), 6) AS ratio FROM customer""")
def j3(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("there", F.lit(True))
    out = table(spark, d, "customer").join(keys, "c_custkey", "left").agg(F.count("*").alias("customers"), F.count("there").alias("present"))
    return out.withColumn("ratio", F.round(X.share(F.col("present"), F.col("customers")), 6))


@query("j3_absent", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate >= TIMESTAMP '1998-01-01')")
def j3b(spark, d):
    recent = table(spark, d, "orders").where("o_orderdate >= TIMESTAMP '1998-01-01'")
    return table(spark, d, "customer").join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j4_distinct_per_shard", "SELECT o_custkey % 16 AS shard, count(DISTINCT o_custkey) AS entities, count(*) AS n FROM orders GROUP BY 1")
def j4(spark, d):
    return table(spark, d, "orders").groupBy((F.col("o_custkey") % 16).alias("shard")).agg(F.countDistinct("o_custkey").alias("entities"), F.count("*").alias("n"))


@query("j5_category_join", f"SELECT doc_id, target FROM documents JOIN (VALUES {', '.join(map(str, TARGETS))}) AS t(name, target) ON source = name")
def j5(spark, d):
    targets = spark.createDataFrame(TARGETS, "source string, target string")
    return table(spark, d, "documents").join(F.broadcast(targets), "source").select("doc_id", "target")


@query("j6_muted_and_followed", """
WITH muted AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50),
followed AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_discount >= 0.1 UNION SELECT min(s_suppkey) FROM supplier)
SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (FROM followed) AND s_suppkey NOT IN (FROM muted)""")
def j6(spark, d):
    items, suppliers = table(spark, d, "lineitem"), table(spark, d, "supplier")
    muted = items.where("l_returnflag = 'R' AND l_quantity >= 50").select(F.col("l_suppkey").alias("s_suppkey"))
    followed = items.where("l_discount >= 0.1").select(F.col("l_suppkey").alias("s_suppkey")).unionByName(suppliers.agg(F.min("s_suppkey").alias("s_suppkey")))
    return suppliers.join(followed, "s_suppkey", "left_semi").join(muted, "s_suppkey", "left_anti").select("s_suppkey", "s_name")


@query("j7_equi_join", "SELECT o_orderkey, o_totalprice, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def j7(spark, d):
    o, c, n = (table(spark, d, x) for x in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    return joined.select("o_orderkey", "o_totalprice", "c_name", "n_name")


@query("j8_skip_enriched", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL)")
def j8(spark, d):
    done = table(spark, d, "labels").where("quality IS NOT NULL").select("doc_id")
    return table(spark, d, "documents").select("doc_id").join(done, "doc_id", "left_anti")


@query("j9_missing_target", "SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id) WHERE source <> '' AND quality IS NULL")
def j9(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").where("source <> '' AND quality IS NULL").select("doc_id", "source")
