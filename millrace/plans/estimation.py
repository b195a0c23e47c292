"""E: sampling and estimation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import estimation as E
from millrace.plans.registry import query
from millrace.sources.tables import table

_SEEDED = "md5(CAST(doc_id AS VARCHAR) || '|42')"


@query("e1_seeded_sample", f"SELECT doc_id FROM documents ORDER BY {_SEEDED}, doc_id LIMIT 100")
def e1(spark, d):
    return E.seeded_sample(table(spark, d, "documents"), "doc_id", 100, 42).select("doc_id")


@query("e2_partition_sample", "SELECT event_id, user_id FROM events WHERE ('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::UBIGINT % 20 = 42 % 20")
def e2(spark, d):
    return E.partition_sample(table(spark, d, "events"), "user_id", 20, 42).select("event_id", "user_id")


@query("e3_shuffled_cap", f"SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY {_SEEDED}, doc_id) AS r FROM documents) WHERE r <= 25")
def e3(spark, d):
    return E.quota_sample(table(spark, d, "documents"), "lang", "doc_id", 25, 42).select("lang", "doc_id")


_WILSON = """round(CASE WHEN n = 0 THEN 0 ELSE greatest(0, (p + 1.9208 / n - 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n)) END, 6) AS low,
  round(CASE WHEN n = 0 THEN 0 ELSE least(1, (p + 1.9208 / n + 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n)) END, 6) AS high"""
_LABELLED = "SELECT {g}, count(*) AS all_rows, count(quality) AS n, CAST(coalesce(sum(quality), 0) AS BIGINT) AS k, CASE WHEN count(quality) > 0 THEN coalesce(sum(quality), 0) / count(quality) ELSE 0.0 END AS p FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1"


def _labelled(spark, d, group):
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.groupBy(group).agg(F.count("*").alias("all_rows"), F.count("quality").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("k"))


@query("e4_wilson", f"SELECT lang, n, k, {_WILSON} FROM ({_LABELLED.format(g='lang')})")
def e4(spark, d):
    return E.wilson(_labelled(spark, d, "lang"), "k", "n").select("lang", "n", "k", "low", "high")


@query("e5_stratified_estimate", f"""
SELECT source, all_rows AS candidates, CAST(round(all_rows * p) AS BIGINT) AS estimate, CAST(round(all_rows * low) AS BIGINT) AS low, CAST(round(all_rows * high) AS BIGINT) AS high
FROM (SELECT source, all_rows, p, {_WILSON} FROM ({_LABELLED.format(g='source')}))""")
def e5(spark, d):
    return E.stratified(_labelled(spark, d, "source"), "source", "all_rows", "k", "n")


@query("e6_strata_and_rest", f"""
WITH e AS (SELECT lang, all_rows, CAST(round(all_rows * p) AS BIGINT) AS est FROM ({_LABELLED.format(g='lang')}))
SELECT lang AS stratum, est AS n FROM e UNION ALL SELECT 'other', CAST(greatest(0, sum(all_rows) - sum(est)) AS BIGINT) FROM e""")
def e6(spark, d):
    return E.with_rest(E.stratified(_labelled(spark, d, "lang"), "lang", "all_rows", "k", "n"), "lang")


_RATE = "r AS (SELECT event_type, count(*) FILTER (value > 20) / count(*) AS rate FROM events WHERE user_id % 4 = 0 GROUP BY 1)"


@query("e7_daily_estimate", f"""
WITH {_RATE}, c AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT day, CAST(sum(n) AS BIGINT) AS n, round(sum(n * coalesce(rate, 0)), 4) AS estimate FROM c LEFT JOIN r USING (event_type) GROUP BY 1""")
def e7(spark, d):
    events = table(spark, d, "events")
    return E.daily(events, "ts", "event_type", E.rates(events.where("user_id % 4 = 0"), "event_type", F.col("value") > 20))


@query("e8_quota_candidates", f"""
SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {_SEEDED}, doc_id) AS r FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)) WHERE r <= 5""")
def e8(spark, d):
    fresh = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    return E.quota_sample(fresh, "source", "doc_id", 5, 42).select("source", "doc_id")


@query("e9_row_estimate_by_day", f"""
WITH {_RATE}, c AS (SELECT event_type, count(*) AS n, any_value(rate) AS rate FROM events JOIN r USING (event_type) GROUP BY 1), t AS (SELECT sum(n * rate) AS total, sum(n) AS rows FROM c)
SELECT CAST(ts AS DATE) AS day, round(any_value(total) * count(*) / any_value(rows), 4) AS allocated FROM events, t GROUP BY 1""")
def e9(spark, d):
    events = table(spark, d, "events")
    return E.allocated(events, "ts", "event_type", E.rates(events.where("user_id % 4 = 0"), "event_type", F.col("value") > 20))
