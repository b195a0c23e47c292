"""G and R: aggregations, rankings and tiers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import exprs as X
from millrace.operators import aggregation as A
from millrace.operators import intervals, sketches
from millrace.plans.registry import query
from millrace.sources.tables import scratch, table


@query("g1_most_common", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 20")
def g1(spark, d):
    return A.most_common(table(spark, d, "events"), "user_id", 20)


@query("g2_day_histogram", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= 2")
def g2(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n")).where("n >= 2")


@query("g3_distinct_keys", "SELECT event_type, count(DISTINCT user_id || '|' || CAST(ts AS DATE)) AS entities FROM events GROUP BY 1")
def g3(spark, d):
    key = F.concat_ws("|", "user_id", F.to_date("ts"))
    return table(spark, d, "events").groupBy("event_type").agg(F.countDistinct(key).alias("entities"))


@query("g3_approx_distinct")
def g3b(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.approx_count_distinct(F.concat_ws("|", "user_id", F.to_date("ts")), 0.01).alias("entities"))


def _week_sketches(spark, d):
    """Stored sketches of the users of every day and kind, and what they say of the seven days up to each."""
    path = scratch(spark, "sketches")
    sketches.store(sketches.day_sketches(table(spark, d, "events"), ["event_type"], F.to_date("ts"), F.col("user_id")), path)
    return sketches.trailing(spark.read.parquet(path), ["event_type"], 7)


@query("g3_sketched_weeks")
def g3c(spark, d):
    return _week_sketches(spark, d)


@query("g3_sketched_weeks_exact", """
WITH u AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day, user_id FROM events), e AS (SELECT DISTINCT event_type, day FROM u)
SELECT e.event_type, e.day, count(DISTINCT user_id) AS entities, true AS within FROM e JOIN u ON u.event_type = e.event_type AND u.day BETWEEN e.day - 6 AND e.day GROUP BY 1, 2""")
def g3d(spark, d):
    """What the sketches say, held against exact counts: within four standard errors."""
    users = table(spark, d, "events").select("event_type", F.to_date("ts").alias("there"), "user_id").distinct()
    ends = users.select("event_type", "user_id", F.explode(F.sequence("there", F.date_add("there", 6))).alias("day"))
    exact = ends.groupBy("event_type", "day").agg(F.countDistinct("user_id").alias("entities"))
    both = exact.join(_week_sketches(spark, d).withColumnRenamed("entities", "estimate"), ["event_type", "day"])
    near = F.abs(F.col("estimate") - F.col("entities")) <= F.greatest(F.lit(1.0), 4 * sketches.STANDARD_ERROR * F.col("entities"))
    return both.select("event_type", "day", "entities", near.alias("within"))


@query("g4_strata_counts", """
SELECT lang, count(*) AS n, count(*) FILTER (n_chars < 500) AS short, count(*) FILTER (n_chars >= 5000) AS long, round(avg(CASE WHEN contains(text, 'License') THEN n_chars END), 4) AS licensed_chars FROM documents GROUP BY 1""")
def g4(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(F.col("n_chars") < 500).alias("short"), F.count_if(F.col("n_chars") >= 5000).alias("long"),
        F.round(F.avg(F.when(F.contains("text", F.lit("License")), F.col("n_chars"))), 4).alias("licensed_chars"),
    )


@query("g5_window_totals", "SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) AS slice, count(*) AS n, count(*) FILTER (value > 1) AS valid, count(DISTINCT user_id) AS entities FROM events GROUP BY 1")
def g5(spark, d):
    slice_ = F.floor(F.unix_timestamp("ts") / 86400).alias("slice")
    return table(spark, d, "events").groupBy(slice_).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 1).alias("valid"), F.countDistinct("user_id").alias("entities"))


@query("g6_latest_per_key", "SELECT user_id, event_id, rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 3")
def g6(spark, d):
    return A.top_per_key(table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id", F.col("rank").cast("long").alias("rank"))


@query("g7_engagement", """
SELECT user_id, round(sum(value), 4) AS total, count(*) AS n, string_agg(event_type, ',' ORDER BY event_id) AS kinds FROM events GROUP BY 1""")
def g7(spark, d):
    events = table(spark, d, "events")
    totals = events.groupBy("user_id").agg(F.round(F.sum("value"), 4).alias("total"), F.count("*").alias("n"))
    return totals.join(A.joined_in_order(events, "user_id", "event_id", "event_type"), "user_id", "left").withColumnRenamed("joined", "kinds")


@query("g8_hot_score", """
WITH e AS (SELECT user_id, event_type, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 72 HOUR)
SELECT user_id, round(4 * count(*) FILTER (event_type = 'purchase') + 3 * count(*) FILTER (event_type = 'click') + 2 * count(*) FILTER (event_type = 'view') + 0.01 * sum(value), 4) AS score
FROM e GROUP BY 1 ORDER BY score DESC, user_id LIMIT 50""")
def g8(spark, d):
    return A.hot(table(spark, d, "events"), "user_id", 72, {"purchase": 4, "click": 3, "view": 2}, 0.01).orderBy(F.desc("score"), "user_id").limit(50)


@query("g9_trending", """
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_type <> '' AND ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1 ORDER BY total DESC, event_type LIMIT 50""")
def g9(spark, d):
    return A.trending(table(spark, d, "events"), "event_type", "ts", "value", 24, 50)


@query("g10_global_statistics", """
SELECT count(*) AS orders, count(DISTINCT o_custkey) AS customers, round(coalesce(sum(o_totalprice), 0), 2) AS total, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS mean_filled FROM orders""")
def g10(spark, d):
    return table(spark, d, "orders").agg(
        F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"), F.round(F.coalesce(F.sum("o_totalprice"), F.lit(0)), 2).alias("total"),
        F.round(F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), 2).alias("mean_filled"),
    )


@query("g11_cross_event", """
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), m AS (SELECT user_id, min(event_type) AS mode FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS best FROM c) WHERE n = best GROUP BY 1)
SELECT e.user_id, count(*) AS n, any_value(m.mode) AS mode, bool_or(value > 40) AS high, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds
FROM events e JOIN m USING (user_id) GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, e.user_id LIMIT 20""")
def g11(spark, d):
    return A.cross_event(table(spark, d, "events"), "user_id", "event_type", F.col("value") > 40).orderBy(F.desc("n"), "user_id").limit(20)


@query("g12_rates", """
SELECT lang, count(*) AS n, round(CASE WHEN count(*) > 0 THEN 100.0 * count(quality) / count(*) ELSE 0 END, 2) AS coverage, round(CASE WHEN count(quality) > 0 THEN 100.0 * sum(quality) / count(quality) ELSE 0 END, 2) AS accuracy
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def g12(spark, d):
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    out = joined.groupBy("lang").agg(F.count("*").alias("n"), F.count("quality").alias("done"), F.sum("quality").alias("good"))
    percent = lambda a, b: F.round(100 * X.share(F.col(a), F.col(b)), 2)
    return out.select("lang", "n", percent("done", "n").alias("coverage"), percent("good", "done").alias("accuracy"))


@query("g13_label_distribution", "SELECT quality, toxic, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS ratio FROM labels GROUP BY 1, 2")
def g13(spark, d):
    counts = table(spark, d, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))
    return counts.withColumn("ratio", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("g14_pivot", """
SELECT CAST(ts AS DATE) AS day, """ + ", ".join(f"round(coalesce(sum(value) FILTER (event_type = '{k}'), 0), 4) AS {k}" for k in ("click", "error", "purchase", "view")) + """ FROM events GROUP BY 1""")
def g14(spark, d):
    kinds = ["click", "error", "purchase", "view"]
    wide = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).pivot("event_type", kinds).agg(F.sum("value"))
    return wide.na.fill(0.0).select("day", *[F.round(k, 4).alias(k) for k in kinds])


@query("g15_shares", """
WITH c AS (SELECT lang, count(*) AS n, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
SELECT lang, n, round(n / sum(n) OVER (), 6) AS share_all, round(CASE WHEN sum(labelled) OVER () > 0 THEN labelled / sum(labelled) OVER () ELSE 0 END, 6) AS share_labelled FROM c""")
def g15(spark, d):
    counts = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").groupBy("lang").agg(F.count("*").alias("n"), F.count("quality").alias("labelled"))
    every = Window.partitionBy()  # over one row per language
    part = lambda c: F.round(X.share(F.col(c), F.sum(c).over(every)), 6)
    return counts.select("lang", "n", part("n").alias("share_all"), part("labelled").alias("share_labelled"))


@query("g16_distinct_pairs", "SELECT count(*) AS pairs FROM (SELECT DISTINCT user_id, event_type FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL)")
def g16(spark, d):
    return table(spark, d, "events").agg(F.countDistinct("user_id", "event_type").alias("pairs"))


@query("g17_tier_distribution", "SELECT CASE WHEN c_acctbal >= 7500 THEN 'high' WHEN c_acctbal >= 2500 THEN 'middle' ELSE 'low' END AS tier, count(*) AS n FROM customer GROUP BY 1")
def g17(spark, d):
    tier = F.when(F.col("c_acctbal") >= 7500, "high").when(F.col("c_acctbal") >= 2500, "middle").otherwise("low")
    return table(spark, d, "customer").groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))


@query("g18_day_totals", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS total, count(*) - count(DISTINCT event_id) AS repeated FROM events GROUP BY 1""")
def g18(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), (F.count("*") - F.countDistinct("event_id")).alias("repeated")
    )


@query("g19_gap_days", """
WITH p AS (SELECT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase' AND user_id % 50 = 0)
SELECT CAST(day AS DATE) AS day FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS day FROM events) WHERE CAST(day AS DATE) NOT IN (SELECT day FROM p)""")
def g19(spark, d):
    events = table(spark, d, "events")
    there = events.where("event_type = 'purchase' AND user_id % 50 = 0").select(F.to_date("ts").alias("day"))
    return A.gap_days(events, "ts", there)


@query("g20_fallback_ratio", """
SELECT count(*) FILTER (event_type = 'error') AS fallbacks, count(*) * 2 AS estimated_calls, round(count(*) FILTER (event_type = 'error') / (count(*) * 2), 6) AS ratio FROM events""")
def g20(spark, d):
    out = table(spark, d, "events").agg(F.count_if(F.col("event_type") == "error").alias("fallbacks"), (F.count("*") * 2).alias("estimated_calls"))
    return out.withColumn("ratio", F.round(X.share(F.col("fallbacks"), F.col("estimated_calls")), 6))


@query("g21_nested_rollup", """
WITH c AS (SELECT l_suppkey, l_returnflag, count(DISTINCT l_partkey) AS parts, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, CAST(sum(parts) AS BIGINT) AS parts, round(sum(quantity), 2) AS quantity, string_agg(l_returnflag || '=' || parts, ',' ORDER BY l_returnflag) AS by_flag FROM c GROUP BY 1""")
def g21(spark, d):
    return A.nested_rollup(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag", "l_partkey", "l_quantity").select(
        "l_suppkey", "parts", "quantity", F.array_join(F.transform(F.sort_array(F.map_entries("children")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("by_flag")
    )


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("g22_table_counts", "WITH c AS (" + " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _TABLES) + ") SELECT name, n FROM c UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM c")
def g22(spark, d):
    counts = None
    for t in _TABLES:
        one = table(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts.rollup("name").agg(F.sum("n").alias("n")).select(F.coalesce("name", F.lit("total")).alias("name"), "n")


@query("g23_consistency", """
WITH t AS (SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT event_type) AS kinds, count(*) AS n FROM events GROUP BY 1, 2)
SELECT 'repeated keys' AS problem, count(*) AS n FROM t WHERE n > 1 UNION ALL SELECT 'several kinds', count(*) FROM t WHERE kinds > 1
UNION ALL SELECT 'labelled without text', count(*) FROM labels LEFT JOIN documents USING (doc_id) WHERE quality IS NOT NULL AND coalesce(trim(text), '') = ''
UNION ALL SELECT 'sums differ', count(*) FROM (SELECT day, sum(n) AS s FROM t GROUP BY 1) JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS c FROM events GROUP BY 1) USING (day) WHERE s <> c""")
def g23(spark, d):
    return A.consistency(table(spark, d, "events"), table(spark, d, "labels"), table(spark, d, "documents"))


@query("g24_period_average", """
WITH days AS (SELECT count(DISTINCT CAST(ts AS DATE)) AS d, sum(value) AS v FROM events)
SELECT event_type, round(sum(value) / any_value(d), 4) AS per_day, round(sum(value) / any_value(v), 6) AS share FROM events, days GROUP BY 1""")
def g24(spark, d):
    events = table(spark, d, "events")
    total = events.agg(F.countDistinct(F.to_date("ts")).alias("d"), F.sum("value").alias("v"))
    groups = events.groupBy("event_type").agg(F.sum("value").alias("s")).join(F.broadcast(total))
    return groups.select("event_type", F.round(F.col("s") / F.col("d"), 4).alias("per_day"), F.round(F.col("s") / F.col("v"), 6).alias("share"))


# Least balances of the tiers, by segment; the default row serves all others.
TIERS = [("MACHINERY", 9000.0, 6000.0, 3000.0), ("FURNITURE", 8000.0, 5000.0, 2000.0)]
DEFAULT_TIER = (7000.0, 4000.0, 1000.0)


@query("r1_tiers", """
SELECT c_custkey, CASE WHEN c_acctbal >= a THEN 'S' WHEN c_acctbal >= b THEN 'A' WHEN c_acctbal >= c THEN 'B' ELSE 'C' END AS tier FROM (SELECT c_custkey, c_acctbal,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 9000 WHEN 'FURNITURE' THEN 8000 ELSE 7000 END AS a, CASE c_mktsegment WHEN 'MACHINERY' THEN 6000 WHEN 'FURNITURE' THEN 5000 ELSE 4000 END AS b,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 3000 WHEN 'FURNITURE' THEN 2000 ELSE 1000 END AS c FROM customer)""")
def r1(spark, d):
    return A.tiers(table(spark, d, "customer"), "c_mktsegment", "c_acctbal", spark.createDataFrame(TIERS, "category string, s double, a double, b double"), DEFAULT_TIER).select("c_custkey", "tier")


@query("r1_interval_tiers", """
WITH b AS (SELECT s_nationkey AS n, s_acctbal AS low, lead(s_acctbal) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS high, s_suppkey FROM supplier),
a AS (SELECT * FROM b UNION ALL SELECT s_nationkey, NULL, min(s_acctbal), -1 FROM supplier GROUP BY 1)
SELECT c_custkey, s_suppkey AS tier FROM customer JOIN a ON n = c_nationkey AND (low IS NULL OR low <= c_acctbal) AND (high IS NULL OR c_acctbal < high)""")
def r1b(spark, d):
    """The balances of a nation's suppliers are its thresholds; the tier is the supplier at or below a customer's balance, -1 below all."""
    s = table(spark, d, "supplier")
    above = F.lead("s_acctbal").over(Window.partitionBy("s_nationkey").orderBy("s_acctbal", "s_suppkey"))
    bands = s.select(F.col("s_nationkey").alias("category"), F.col("s_acctbal").alias("low"), above.alias("high"), F.col("s_suppkey").alias("label"))
    lowest = s.groupBy(F.col("s_nationkey").alias("category")).agg(F.min("s_acctbal").alias("high"))
    bands = bands.unionByName(lowest.select("category", F.lit(None).cast("double").alias("low"), "high", F.lit(-1).cast("long").alias("label")))
    out = intervals.in_intervals(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), "c_nationkey", "c_acctbal", bands)
    return out.select("c_custkey", F.col("label").alias("tier"))


@query("r2_default_tier", "SELECT c_mktsegment, c_mktsegment NOT IN ('MACHINERY', 'FURNITURE') AS by_default, count(*) AS n FROM customer GROUP BY 1, 2")
def r2(spark, d):
    known = spark.createDataFrame([(t[0],) for t in TIERS], "c_mktsegment string").withColumn("known", F.lit(True))
    joined = table(spark, d, "customer").join(F.broadcast(known), "c_mktsegment", "left")
    return joined.groupBy("c_mktsegment", F.isnull("known").alias("by_default")).agg(F.count("*").alias("n"))


@query("r3_allowed_tiers", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE') AND c_acctbal IS NOT NULL")
def r3(spark, d):
    return table(spark, d, "customer").where(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE") & F.col("c_acctbal").isNotNull()).select("c_custkey")


@query("r4_top_tier_counters", """
SELECT c_custkey, c_acctbal, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS spent FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_acctbal >= 9000 GROUP BY 1, 2""")
def r4(spark, d):
    top = table(spark, d, "customer").where("c_acctbal >= 9000")
    counters = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    out = top.join(counters, F.col("c_custkey") == F.col("o_custkey"), "left")
    return out.select("c_custkey", "c_acctbal", F.coalesce("n", F.lit(0)).alias("orders"), F.round(F.coalesce("s", F.lit(0)), 2).alias("spent"))
