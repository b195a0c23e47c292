"""X: streams, state and runs that resume. Streams read files and run until these are used up."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import folds
from millrace.plans.registry import query
from millrace.sources.tables import scratch, table
from millrace.streaming import jobs as J
from millrace.streaming import state as S


@query("a14_stream_decode", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 10 <> 0")
def a14(spark, d):
    good = F.to_json(F.struct("event_id", F.from_json("props", "k long").alias("data")))
    lines = table(spark, d, "events").select(F.when(F.col("event_id") % 10 == 0, '{"broken": ').otherwise(good).alias("value"))
    return J.decoded(spark, J.spooled(lines, scratch(spark, "lines"), "text"), "event_id long, data struct<k: long>", ["event_id"]).select("event_id", "data.k")


_ROUTES = [("errors", "error"), ("money", "purchase"), ("attention", "click"), ("attention", "view")]


@query("x1_stream_routing", "SELECT CASE event_type WHEN 'error' THEN 'errors' WHEN 'purchase' THEN 'money' ELSE 'attention' END AS task, count(*) AS n FROM events WHERE event_type IN ('error', 'purchase', 'click', 'view') GROUP BY 1")
def x1(spark, d):
    return J.routed(spark, f"{d}/events.parquet", "event_type", _ROUTES).groupBy("task").agg(F.count("*").alias("n"))


@query("x2_processed_keys", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND user_id % 2 = 0)")
def x2(spark, d):
    events = table(spark, d, "events")
    return J.unprocessed(events, events.where("event_type = 'error' AND user_id % 2 = 0").select("user_id"), "user_id").select("event_id")


@query("x2_stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def x2b(spark, d):
    return J.stream_distinct(spark, f"{d}/events.parquet", ["user_id", "event_type"])


@query("x3_mark_processed", "SELECT 'dry' AS run, 0 AS marked UNION ALL SELECT 'real', count(DISTINCT user_id) FROM events")
def x3(spark, d):
    marks, events, counts = scratch(spark, "marks"), table(spark, d, "events"), None
    events.select("user_id").limit(0).write.parquet(marks)
    for run, dry in (("dry", True), ("real", False)):
        J.mark(events, "user_id", marks, dry)
        one = spark.createDataFrame([(run, spark.read.parquet(marks).count())], "run string, marked long")
        counts = one if counts is None else counts.unionByName(one)
    return counts


_X4_SQL = """
WITH RECURSIVE e AS (SELECT event_id, ts, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events),
t AS (SELECT user_id, event_type, ts, min(r) AS r FROM e GROUP BY 1, 2, 3),
n AS MATERIALIZED (SELECT e.user_id, e.event_type, e.r, t.r AS next FROM e ASOF JOIN t ON e.user_id = t.user_id AND e.event_type = t.event_type AND e.ts + INTERVAL 20 MINUTE <= t.ts),
p AS (SELECT user_id, event_type, CAST(1 AS BIGINT) AS r FROM e WHERE r = 1 UNION ALL SELECT p.user_id, p.event_type, n.next FROM p JOIN n USING (user_id, event_type, r))
SELECT event_id, ts, user_id, event_type FROM e JOIN p USING (user_id, event_type, r)"""


@query("x4_short_lived_dedupe", _X4_SQL)
def x4(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    return folds.expiring_first(events, ["user_id", "event_type"], "ts", "event_id", 20 * 60)


#: Files of a part of a stream that is taken in two parts.
_FILES = 8


def _mixed(spark, d):
    """The events in two parts, without regard to their time."""
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    return J.spooled_in_turn([events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == k) for k in range(2)], scratch(spark, "mixed"), _FILES)


@query("x4_stream_expiring", _X4_SQL)
def x4b(spark, d):
    return S.expiring_first(spark, _mixed(spark, d), ["user_id", "event_type"], "ts", "event_id", 20 * 60, scratch(spark, "expiring"), delay="40 days", files=_FILES, complete=True)


@query("x5_stream_buffers", """
WITH RECURSIVE e AS (SELECT user_id, event_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r, count(*) OVER (PARTITION BY user_id) AS total FROM events),
s AS (SELECT user_id, r, total, ts AS began, event_id AS first, [event_type] AS seen, 0 AS dropped, false AS brim, NULL::STRUCT(began TIMESTAMP, first BIGINT, n BIGINT, dropped BIGINT, reason VARCHAR)[] AS out FROM e WHERE r = 1
  UNION ALL SELECT e.user_id, e.r, e.total, CASE WHEN fresh THEN ts ELSE began END, CASE WHEN fresh THEN event_id ELSE first END,
    CASE WHEN fresh THEN [event_type] WHEN list_contains(seen, event_type) THEN seen ELSE list_append(seen, event_type) END,
    CASE WHEN fresh THEN 0 WHEN list_contains(seen, event_type) THEN dropped + 1 ELSE dropped END,
    NOT fresh AND NOT list_contains(seen, event_type) AND len(seen) + 1 = 4,
    CASE WHEN brim THEN NULL WHEN fresh THEN [{'began': began, 'first': first, 'n': len(seen), 'dropped': dropped, 'reason': 'time'}] END
  FROM (SELECT s.user_id AS u, s.r AS q, began, first, seen, dropped, s.brim FROM s) JOIN e ON e.user_id = u AND e.r = q + 1, LATERAL (SELECT brim OR ts >= began + INTERVAL 6 HOUR AS fresh)),
f AS (SELECT user_id, unnest(out, recursive := true) FROM s WHERE out IS NOT NULL
  UNION ALL SELECT user_id, began, first, len(seen), dropped, 'size' FROM s WHERE brim
  UNION ALL SELECT user_id, began, first, len(seen), dropped, 'time' FROM s WHERE r = total AND NOT brim)
SELECT user_id, began, first, n, dropped, reason FROM f""")
def x5c(spark, d):
    return S.buffers(spark, _mixed(spark, d), ["user_id"], "ts", "event_id", "event_type", 4, 6 * 3600, scratch(spark, "buffers"), delay="40 days", files=_FILES, complete=True)


@query("x5_micro_batches", "SELECT event_type, count(*) AS n FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY 1")
def x5(spark, d):
    return J.micro_batches(spark, f"{d}/events.parquet", ["event_id"], scratch(spark, "batches")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("x5_flushes", """
WITH RECURSIVE e AS (SELECT user_id % 8 AS shard, event_id, ts, row_number() OVER (PARTITION BY user_id % 8 ORDER BY ts, event_id) AS r, count(*) OVER (PARTITION BY user_id % 8) AS total FROM events),
t AS (SELECT shard, ts, min(r) AS r FROM e GROUP BY 1, 2),
n AS MATERIALIZED (SELECT e.shard, e.r, least(e.r + 20, coalesce(t.r, e.total + 1)) AS next, CASE WHEN e.r + 20 <= least(coalesce(t.r, e.total + 1), e.total + 1) THEN 'size' WHEN t.r IS NULL THEN 'end' ELSE 'time' END AS reason
  FROM e ASOF LEFT JOIN t ON e.shard = t.shard AND e.ts + INTERVAL 1 HOUR <= t.ts),
b AS (SELECT shard, CAST(1 AS BIGINT) AS r, CAST(0 AS BIGINT) AS batch FROM e WHERE r = 1 UNION ALL SELECT b.shard, n.next, batch + 1 FROM b JOIN n USING (shard, r))
SELECT shard, batch, event_id AS first, least(next, total + 1) - r AS n, reason FROM b JOIN n USING (shard, r) JOIN e USING (shard, r)""")
def x5b(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", F.pmod("user_id", F.lit(8)).alias("shard"))
    return folds.flushes(events, ["shard"], "ts", "event_id", 20, 3600)


@query("x6_shard_writes", "SELECT user_id % 8 AS shard, count(*) AS n FROM events GROUP BY 1")
def x6(spark, d):
    out = scratch(spark, "shards")
    J.shard_writes(spark, f"{d}/events.parquet", "user_id", 8, out)
    return spark.read.parquet(f"{out}/rows").groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("n"))


@query("x6_write_counts", """
SELECT user_id % 8 AS shard, count(*) FILTER (event_type <> 'error') AS written, count(*) FILTER (event_type = 'error') AS failed, 1 AS attempts FROM events GROUP BY 1""")
def x6b(spark, d):
    return J.shard_writes(spark, f"{d}/events.parquet", "user_id", 8, scratch(spark, "shards"), valid=F.col("event_type") != "error")


@query("x7_hour_windows", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def x7(spark, d):
    return J.hour_windows(spark, f"{d}/events.parquet")


@query("x7_closed_windows", """
WITH e AS (SELECT *, CASE WHEN event_id % 20 = 7 THEN 3 ELSE least(day(ts) // 10, 2) END AS file, date_trunc('hour', ts) AS start FROM events),
m AS (SELECT f.file, (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 1 DAY FROM e WHERE e.file < f.file) AS mark FROM (SELECT DISTINCT file FROM e) f)
SELECT CASE WHEN coalesce(start + INTERVAL 1 HOUR <= mark, false) THEN 'late' ELSE 'window' END AS kind, start, event_type, count(*) AS n FROM e JOIN m USING (file) GROUP BY ALL""")
def x7c(spark, d):
    events, out = table(spark, d, "events"), scratch(spark, "windows")
    late = F.col("event_id") % 20 == 7  # these come last, most of them too late
    third = F.least(F.floor(F.dayofmonth("ts") / 10), F.lit(2))
    source = J.spooled_in_turn([*[events.where(~late & (third == k)) for k in range(3)], events.where(late)], scratch(spark, "turns"))
    closed = J.closed_windows(spark, source, "ts", ["event_type"], "1 hour", "1 day", out, files=1, complete=True)
    missed = J.written(spark, f"{out}/late", events.schema).groupBy(F.date_trunc("hour", "ts").cast(dict(events.dtypes)["ts"]).alias("start"), "event_type").agg(F.count("*").alias("n"))
    rows = [x.select(F.lit(kind).alias("kind"), "start", "event_type", "n") for x, kind in ((closed, "window"), (missed, "late"))]
    return rows[0].unionByName(rows[1])


@query("x7_run_days", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE event_type = 'error' GROUP BY 1""")
def x7d(spark, d):
    events, out = table(spark, d, "events").withColumn("day", F.to_date("ts")), scratch(spark, "days")

    def work(todo):
        errors = events.where("event_type = 'error'").join(todo, "day", "left_semi")
        return errors.groupBy("day").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))

    days = events.select("day").distinct()
    J.run_days(days.where(F.dayofmonth("day") % 2 == 0), out, {"kind": "error"}, work)
    J.run_days(days, out, {"kind": "error"}, work)
    return J.written(spark, f"{out}/rows", "n long, users long, day date").select("day", "n", "users")


@query("x7_days_to_do", """
SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE day(ts) % 2 = 0)""")
def x7b(spark, d):
    days = table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct()
    done = days.where(F.dayofmonth("day") % 2 == 0).withColumn("fingerprint", F.lit("h=6"))
    return J.days_to_do(days, done, "h=6")


@query("x8_late_and_future", "SELECT event_id, ts > TIMESTAMP '2024-01-20' AS future, CAST(ts AS DATE) AS day FROM events")
def x8(spark, d):
    return table(spark, d, "events").select("event_id", (F.col("ts") > F.lit("2024-01-20").cast("timestamp")).alias("future"), F.to_date("ts").alias("day"))


@query("x9_newest_first", """
SELECT day, row_number() OVER (ORDER BY day DESC) AS turn FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) <= (SELECT CAST(max(ts) AS DATE) - 1 FROM events))""")
def x9(spark, d):
    events = table(spark, d, "events")
    last = events.agg(F.date_sub(F.max(F.to_date("ts")), 1).alias("last"))
    days = events.select(F.to_date("ts").alias("day")).distinct().join(F.broadcast(last), F.col("day") <= F.col("last")).select("day")
    return days.withColumn("turn", F.row_number().over(Window.orderBy(F.desc("day"))).cast("long"))  # one row per day


@query("x10_budget", """
WITH c AS (SELECT CAST(ts AS DATE) AS day, least(count(*), 300) AS calls FROM events GROUP BY 1), s AS (SELECT day, calls, sum(calls) OVER (ORDER BY day DESC) AS upto FROM c)
SELECT day, calls, CAST(upto AS BIGINT) AS upto FROM s WHERE upto <= 5000""")
def x10(spark, d):
    calls = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.least(F.count("*"), F.lit(300)).alias("calls"))
    upto = F.sum("calls").over(Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0))  # one row per day
    return calls.withColumn("upto", upto).where("upto <= 5000")
