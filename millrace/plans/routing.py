"""B: hash routing and category mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import exprs as X
from millrace.operators import routes
from millrace.plans.registry import query
from millrace.sources.tables import scratch, table

_SHARD = """CAST((('0x' || substr(md5(trim(c_name)), 1, 16))::UBIGINT % 1000 * 616 + ('0x' || substr(md5(trim(c_name)), 17, 16))::UBIGINT % 1000) % 1000 AS BIGINT)"""


@query("b1_shard", f"SELECT c_custkey, {_SHARD} AS shard, 'entity_' || lpad(CAST({_SHARD} AS VARCHAR), 3, '0') AS target FROM customer")
def b1(spark, d):
    return routes.shard(table(spark, d, "customer"), "c_name", 1000, "entity_").select("c_custkey", "shard", "target")


@query("b2_shard_writes", f"SELECT {_SHARD} AS shard, count(*) AS n FROM customer GROUP BY 1")
def b2(spark, d):
    path = scratch(spark, "shards")
    routes.shard(table(spark, d, "customer"), "c_name", 1000, "entity_").select("c_custkey", "shard").repartition("shard").write.partitionBy("shard").parquet(path)
    return spark.read.schema("c_custkey long, shard long").parquet(path).groupBy("shard").agg(F.count("*").alias("n"))


# A mapping of sources to targets, in which names are written in several ways.
TARGETS = [("src0", "news"), ("src1", "news"), ("src2", "forum"), ("src3", "forum"), ("src4", "wiki"), ("src5", "code")]
ALIASES = [("src10", "src1"), ("src12", "src2")]


def _values(rows, names):
    return "(SELECT * FROM (VALUES " + ", ".join(str(r) for r in rows) + f") AS v({names}))"


@query("b3_route_counts", f"""
SELECT coalesce(target, 'unmapped') AS target, source, count(*) AS n FROM documents LEFT JOIN {_values(TARGETS, 'name, target')} m ON source = name
GROUP BY 1, 2 ORDER BY n DESC, source LIMIT 15""")
def b3(spark, d):
    targets = spark.createDataFrame(TARGETS, "source string, target string")
    routed = table(spark, d, "documents").join(F.broadcast(targets), "source", "left").groupBy(F.coalesce("target", F.lit("unmapped")).alias("target"), "source")
    return routed.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(15)


@query("b4_mapping_fallback", f"""
WITH t AS {_values(TARGETS, 'name, target')}, a AS {_values(ALIASES, 'alias, canonical')},
s AS (SELECT DISTINCT source || CASE WHEN length(source) % 2 = 0 THEN '-mirror' ELSE '' END AS raw FROM documents)
SELECT raw, coalesce(t1.target, t2.target, t3.target, t4.target) AS target,
  CASE WHEN t1.target IS NOT NULL THEN 'exact' WHEN t2.target IS NOT NULL THEN 'alias' WHEN t3.target IS NOT NULL THEN 'trimmed' WHEN t4.target IS NOT NULL THEN 'trimmed alias' END AS matched_by
FROM s LEFT JOIN t t1 ON t1.name = raw LEFT JOIN a a1 ON a1.alias = raw LEFT JOIN t t2 ON t2.name = a1.canonical
LEFT JOIN t t3 ON t3.name = regexp_replace(raw, '[-—|/].*$', '') LEFT JOIN a a2 ON a2.alias = regexp_replace(raw, '[-—|/].*$', '') LEFT JOIN t t4 ON t4.name = a2.canonical""")
def b4(spark, d):
    raw = F.concat("source", F.when(F.length("source") % 2 == 0, "-mirror").otherwise(""))
    names = table(spark, d, "documents").select(raw.alias("raw")).distinct()
    return routes.map_with_fallback(names, "raw", spark.createDataFrame(TARGETS, "name string, target string"), spark.createDataFrame(ALIASES, "alias string, canonical string"))


@query("b5_duplicate_mappings", "SELECT p_name AS name, count(DISTINCT p_brand) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def b5(spark, d):
    return routes.ambiguous(table(spark, d, "part"), "p_name", "p_brand")


@query("b6_composite_key", "SELECT l_orderkey, l_linenumber, l_orderkey || '|' || l_linenumber AS id FROM lineitem")
def b6(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.composite_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("id"))
