"""A: scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import scanning, variants
from millrace.plans.registry import query
from millrace.sources.tables import scratch, table


@query("a1_keyset_pages", """
SELECT o_orderkey // 1000 AS page, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus <> '' GROUP BY 1""")
def a1(spark, d):
    return scanning.keyset_pages(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 1000)


@query("a1_row_pages", """
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS page FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus <> ''""")
def a1b(spark, d):
    return scanning.row_pages(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", 1000).select("o_orderkey", "page")


@query("a2_bounded_scan", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 500")
def a2b(spark, d):
    return scanning.bounded_scan(table(spark, d, "documents"), ["doc_id", "lang"], 500, "doc_id")


@query("a2_projection", "SELECT doc_id, lang, n_chars FROM documents")
def a2(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "n_chars")


@query("a3_time_slices", """
SELECT CAST(floor(epoch(ts) / 21600) AS BIGINT) AS slice, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1""")
def a3(spark, d):
    return scanning.time_slices(table(spark, d, "events"), "ts", 6).groupBy("slice").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("a4_days", """
SELECT CAST(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS DATE) AS day FROM events""")
def a4(spark, d):
    return scanning.days_between(table(spark, d, "events"), "ts")


@query("a5_missing_keys", """
SELECT count(*) FILTER (coalesce(lang, '') = '') AS skipped, count(*) FILTER (coalesce(lang, '') <> '') AS used FROM documents""")
def a5(spark, d):
    empty = F.coalesce("lang", F.lit("")) == ""
    return table(spark, d, "documents").agg(F.count_if(empty).alias("skipped"), F.count_if(~empty).alias("used"))


@query("a5_counted_on_the_way", """
SELECT count(*) AS given, count(*) FILTER (coalesce(text, '') = '') AS skipped, count(*) FILTER (coalesce(text, '') <> '') AS written, sum(length(text)) AS chars FROM documents""")
def a5b(spark, d):
    empty = F.coalesce("text", F.lit("")) == ""
    counts = scanning.written_with_counts(
        table(spark, d, "documents").select("doc_id", "text"), scratch(spark, "used"), {"given": F.count("*"), "skipped": F.count_if(empty)}, ~empty,
        {"written": F.count("*"), "chars": F.sum(F.length("text"))},
    )
    return spark.createDataFrame([counts], "given long, skipped long, written long, chars long")


@query("a6_suffix_drop", "SELECT page_id, url FROM pages WHERE NOT (lower(url) LIKE '%#top' OR lower(url) LIKE '%.pdf')")
def a6(spark, d):
    u = F.lower("url")
    return table(spark, d, "pages").where(~(u.endswith("#top") | u.endswith(".pdf"))).select("page_id", "url")


@query("a7_tsv", "SELECT source AS value, count(*) AS frequency FROM documents GROUP BY 1")
def a7(spark, d):
    path = scratch(spark, "frequencies")
    table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n")).write.csv(path, sep="\t")
    return spark.read.csv(path, sep="\t", schema="value string, frequency long")


@query("a8_log_lines", """
SELECT CAST(ts AS DATE) AS day, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2""")
def a8(spark, d):
    lines = table(spark, d, "events").select(F.concat_ws("\t", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(F.lit("user-"), F.col("user_id"), F.lit("-"), F.col("event_type"))).alias("line"))
    return scanning.parse_lines(lines, "line").groupBy("day", "kind").agg(F.count("*").alias("n"))


@query("a9_row_kinds", """
SELECT CAST(ts AS DATE) AS day, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS fails,
  CAST(sum(CASE WHEN event_type = 'view' THEN user_id ELSE 0 END) AS BIGINT) AS view_users, count(*) AS rounds FROM events GROUP BY 1""")
def a9(spark, d):
    lines = table(spark, d, "events").select(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" ["), F.col("event_type"), F.lit("] user="), F.col("user_id")).alias("line"))
    part = lambda i: F.regexp_extract("line", r"^(\d{4}-\d\d-\d\d) \[(\w+)\] user=(\d+)$", i)
    rows = lines.select(part(1).cast("date").alias("day"), part(2).alias("kind"), part(3).cast("long").alias("user"))
    return rows.groupBy("day").agg(
        F.count_if(F.col("kind") == "error").alias("fails"), F.sum(F.when(F.col("kind") == "view", F.col("user")).otherwise(0)).alias("view_users"), F.count("*").alias("rounds")
    )


@query("a10_latest_line", """
SELECT event_type, max(event_id) AS event_id, CAST(json_extract(arg_max(props, event_id), '$.k') AS BIGINT) AS k FROM events GROUP BY 1""")
def a10(spark, d):
    last = table(spark, d, "events").groupBy("event_type").agg(F.max("event_id").alias("event_id"), F.max_by("props", "event_id").alias("props"))
    return last.select("event_type", "event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("a11_mapping", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def a11(spark, d):
    return table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


@query("a12_lookup", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def a12(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment")


@query("a13_metrics", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, coalesce(TRY_CAST(json_extract_string(props, '$.missing') AS BIGINT), 0) AS missing FROM events""")
def a13(spark, d):
    m = F.from_json("props", "map<string,string>")
    value = lambda k: F.coalesce(F.element_at(m, k).try_cast("long"), F.lit(0).cast("long")).alias(k)
    return table(spark, d, "events").select("event_id", value("k"), value("missing"))


@query("a15_json_lines", "SELECT doc_id, lang, source, n_chars FROM documents")
def a15(spark, d):
    path = scratch(spark, "lines")
    table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").write.json(path)
    return spark.read.json(path, schema="doc_id long, lang string, source string, n_chars long")


@query("a16_reports", """
SELECT 'summary' AS report, 'rows' AS item, count(*) AS n FROM documents UNION ALL
SELECT 'lang', lang, count(*) FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source""")
def a16(spark, d):
    docs, path = table(spark, d, "documents"), scratch(spark, "reports")
    summary = docs.agg(F.count("*").alias("n")).select(F.lit("summary").alias("report"), F.lit("rows").alias("item"), "n")
    reports = [docs.groupBy(c).agg(F.count("*").alias("n")).select(F.lit(c).alias("report"), F.col(c).alias("item"), "n") for c in ("lang", "source")]
    for r in reports:
        summary = summary.unionByName(r)
    summary.write.partitionBy("report").parquet(path)
    return spark.read.schema("item string, n long, report string").parquet(path).select("report", "item", "n")


@query("a17_flatten", "SELECT event_id, user_id, event_type AS kind, value AS amount, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def a17(spark, d):
    nested = table(spark, d, "events").select(
        "event_id", "user_id", F.col("event_type").alias("kind"), F.col("value").alias("amount"), F.from_json("props", "k long").alias("props")
    )
    return scanning.flatten(nested)


def _shapes(spark, d):
    """Events as JSON of three shapes, and every thirteenth as no JSON at all."""
    k = F.get_json_object("props", "$.k").cast("long")
    flat = F.to_json(F.struct(F.col("value").cast("string").alias("amount"), k.alias("k")))
    deep = F.to_json(F.struct(F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("kind")).alias("last")).alias("user")))
    listed = F.to_json(F.struct(F.array(k, "user_id").alias("ids"), (F.col("user_id") % 2 == 0).alias("even")))
    shape = F.when(F.col("event_id") % 13 == 0, F.lit("{no")).when(F.col("event_id") % 3 == 0, flat).when(F.col("event_id") % 3 == 1, deep).otherwise(listed)
    return table(spark, d, "events").select("event_id", shape.alias("raw"))


@query("a17_any_shape", """
SELECT event_id, CASE WHEN s = 0 THEN k END AS k, CASE WHEN s = 1 THEN user_id END AS user_id, CASE WHEN s = 1 THEN event_type END AS last_kind,
  CASE WHEN s = 2 THEN '[' || k || ',' || user_id || ']' END AS ids, CASE WHEN s = 2 THEN user_id % 2 = 0 END AS even
FROM (SELECT *, CASE WHEN event_id % 13 = 0 THEN -1 ELSE event_id % 3 END AS s, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")
def a17b(spark, d):
    out = variants.one_table(_shapes(spark, d), "event_id", "raw")
    return out.select("event_id", "k", F.col("`user.id`").alias("user_id"), F.col("`user.last.kind`").alias("last_kind"), "ids", "even")


@query("a17_paths", """
SELECT path, kind, count(*) AS n FROM (SELECT unnest(CASE WHEN event_id % 3 = 0 THEN [{'path': 'amount', 'kind': 'STRING'}, {'path': 'k', 'kind': 'BIGINT'}]
  WHEN event_id % 3 = 1 THEN [{'path': 'user.id', 'kind': 'BIGINT'}, {'path': 'user.last.kind', 'kind': 'STRING'}]
  ELSE [{'path': 'ids', 'kind': 'ARRAY'}, {'path': 'even', 'kind': 'BOOLEAN'}] END, recursive := true) FROM events WHERE event_id % 13 <> 0) GROUP BY 1, 2""")
def a17c(spark, d):
    return variants.leaves(_shapes(spark, d), "event_id", "raw").groupBy("path", "kind").agg(F.count("*").alias("n"))


@query("a18_phrase_and_terms", "SELECT doc_id, source FROM documents WHERE contains(text, 'License') AND source IN ('src0', 'src1', 'src2')")
def a18(spark, d):
    return table(spark, d, "documents").where(F.contains("text", F.lit("License")) & F.col("source").isin("src0", "src1", "src2")).select("doc_id", "source")


@query("a19_control_characters", r"SELECT doc_id, md5(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) AS digest FROM documents")
def a19(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "").cast("binary")).alias("digest"))


@query("a20_retention", """
SELECT event_id FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 7 FROM events)""")
def a20(spark, d):
    return scanning.retain(table(spark, d, "events"), "ts", 7).select("event_id")
