"""K: keyword and rule matching over documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import matching as M
from millrace.operators import relevance
from millrace.plans.registry import query
from millrace.sources.tables import scratch, table

# Words to look for, and a rule table over documents.
WORDS = ("License", "rights reserved", "example.com", "und", "the")
TECHNICAL = ("License", "http", "example.com", "@")
PLAIN = ("the", "und", "que", "de")
TASKS = [("legal", "License"), ("legal", "rights reserved"), ("contact", "@"), ("links", "http"), ("german", " und ")]
RULES = [
    ("notice", "veto", "!!", 1), ("notice", "reject", "***", 2), ("notice", "require", "License", 3),
    ("contact", "veto", "%%%", 1), ("contact", "require", "@", 3), ("contact", "ambiguous", "example", 4), ("contact", "concrete", ".com", 4),
]


def _list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _rows(rows, names):
    return "(VALUES " + ", ".join(str(r) for r in rows) + f") AS v({names})"


@query("k1_any_keyword", f"SELECT doc_id FROM documents WHERE len(list_filter({_list(WORDS[:3])}, lambda w: contains(text, w))) > 0")
def k1(spark, d):
    return table(spark, d, "documents").where(M.any_of("text", WORDS[:3])).select("doc_id")


@query("k1_long_list", """
SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents)
WHERE w IN (SELECT w FROM (SELECT lower(unnest(string_split(text, ' '))) AS w FROM benchmark) WHERE length(w) > 11)""")
def k1b(spark, d):
    words = table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word")).where(F.length("word") > 11)
    return M.any_of_many(table(spark, d, "documents"), "doc_id", "text", words, "word")


# Documents in which letters stand for characters of other scripts, and phrases of two to five words of the same.
_SCRIPTS = ("aeiouns", "漢字仮名文жд")


@query("k1_phrases", f"""
WITH d AS (SELECT doc_id, translate(text, '{_SCRIPTS[0]}', '{_SCRIPTS[1]}') AS t FROM documents),
w AS (SELECT DISTINCT translate(array_to_string(string_split(text, ' ')[2:k + 1], ' '), '{_SCRIPTS[0]}', '{_SCRIPTS[1]}') AS phrase FROM benchmark, (VALUES (2), (3), (5)) AS n(k))
SELECT doc_id, phrase FROM d JOIN w ON contains(t, phrase)""")
def k1c(spark, d):
    words = F.split(F.translate("text", *_SCRIPTS), " ")
    phrases = table(spark, d, "benchmark").select(F.explode(F.array(*[F.array_join(F.slice(words, 2, k), " ") for k in (2, 3, 5)])).alias("phrase"))
    docs = table(spark, d, "documents").select("doc_id", F.translate("text", *_SCRIPTS).alias("t"))
    return M.listed(docs, "doc_id", "t", phrases, "phrase").withColumnRenamed("word", "phrase")


@query("k2_matched_keywords", f"SELECT doc_id, array_to_string(list_filter({_list(WORDS)}, lambda w: contains(text, w)), ',') AS matched FROM documents")
def k2(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(M.matched("text", WORDS), ",").alias("matched"))


@query("k3_fan_out", f"SELECT DISTINCT doc_id, task FROM documents, {_rows(TASKS, 'task, term')} WHERE contains(text, term)")
def k3(spark, d):
    return M.fan_out(table(spark, d, "documents"), "doc_id", "text", TASKS)


@query("k4_rule_config", f"SELECT category, kind, count(*) AS terms, count(DISTINCT doc_id) AS documents FROM {_rows(RULES, 'category, kind, term, priority')} LEFT JOIN documents ON contains(text, term) GROUP BY 1, 2"
       .replace("count(*) AS terms", "count(DISTINCT term) AS terms"))
def k4(spark, d):
    rules = spark.createDataFrame(RULES, "category string, kind string, term string, priority int")
    hits = table(spark, d, "documents").select("doc_id", F.explode(M.matched("text", sorted({r[2] for r in RULES}))).alias("term"))
    found = hits.join(F.broadcast(rules), "term", "right")
    return found.groupBy("category", "kind").agg(F.countDistinct("term").alias("terms"), F.countDistinct("doc_id").alias("documents"))


@query("k5_blocklist", """
SELECT doc_id, array_to_string(list_filter(['src1', 'legal', 'contact'], lambda c: CASE c WHEN 'src1' THEN contains(lower(source), 'src1') WHEN 'legal' THEN contains(lower(text), 'license') ELSE contains(lower(text), '@') END), ',') AS blocked FROM documents""")
def k5(spark, d):
    return M.blocked(table(spark, d, "documents"), "doc_id", ("source", "text"), {"src1": ("source", ("src1",)), "legal": ("text", ("license",)), "contact": ("text", ("@",))})


@query("k6_ordered_filter", """
SELECT doc_id, CASE WHEN source = 'src19' THEN source WHEN contains(text, '!!') THEN '' WHEN contains(text, '***') AND NOT contains(text, 'License') THEN '' WHEN lang NOT IN ('en', 'de') THEN '' ELSE source END AS passed FROM documents""")
def k6(spark, d):
    return M.ordered_filter(table(spark, d, "documents"), "source", [
        (F.col("source") == "src19", F.col("source")),
        (F.contains("text", F.lit("!!")), F.lit("")),
        (F.contains("text", F.lit("***")) & ~F.contains("text", F.lit("License")), F.lit("")),
        (~F.col("lang").isin("en", "de"), F.lit("")),
    ]).select("doc_id", "passed")


@query("k7_gates", f"""
WITH r AS (SELECT * FROM {_rows(RULES, 'category, kind, term, priority')}), c AS (SELECT DISTINCT category FROM r),
hit AS (SELECT doc_id, category, kind FROM documents JOIN r ON contains(text, term)),
f AS (SELECT doc_id, c.category,
  EXISTS (FROM hit h WHERE h.doc_id = d.doc_id AND h.category = c.category AND kind = 'veto') AS veto,
  EXISTS (FROM hit h WHERE h.doc_id = d.doc_id AND h.category = c.category AND kind = 'reject') AS reject,
  EXISTS (FROM hit h WHERE h.doc_id = d.doc_id AND h.category = c.category AND kind = 'require') AS req,
  EXISTS (FROM hit h WHERE h.doc_id = d.doc_id AND h.category = c.category AND kind = 'ambiguous') AS amb,
  EXISTS (FROM hit h WHERE h.doc_id = d.doc_id AND h.category = c.category AND kind = 'concrete') AS conc
  FROM documents d, c)
SELECT doc_id, category, CASE WHEN veto THEN 'veto' WHEN reject THEN 'reject' WHEN NOT req THEN 'require' WHEN amb AND NOT conc THEN 'ambiguous' END AS reason,
  NOT (veto OR reject OR NOT req OR (amb AND NOT conc)) AS passed FROM f""")
def k7(spark, d):
    return M.gates(table(spark, d, "documents"), "doc_id", "text", RULES)


@query("k8_normalise", r"SELECT doc_id, md5(lower(regexp_replace(text, '[^0-9A-Za-z#\x{4e00}-\x{9fff}]', '', 'g'))) AS digest FROM documents")
def k8(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(M.normalised(F.col("text")).cast("binary")).alias("digest"))


@query("k9_grounding", r"""
WITH d AS (SELECT doc_id, lower(regexp_replace(text, '[^0-9A-Za-z#\x{4e00}-\x{9fff}]', '', 'g')) AS t FROM documents),
b AS (SELECT item_id, lower(regexp_replace(text, '[^0-9A-Za-z#\x{4e00}-\x{9fff}]', '', 'g')) AS e FROM benchmark)
SELECT item_id, count(*) AS grounded FROM b JOIN d ON e <> '' AND contains(t, e) GROUP BY 1""")
def k9(spark, d):
    return M.grounded(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("k9_grounded_turns", r"""
WITH t AS (SELECT conv_id, turn, lower(regexp_replace(text, '[^0-9A-Za-z#\x{4e00}-\x{9fff}]', '', 'g')) AS e,
  lower(regexp_replace(coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role), ''), '[^0-9A-Za-z#\x{4e00}-\x{9fff}]', '', 'g')) AS s FROM conversations)
SELECT conv_id, turn, e <> '' AND (contains(s, e) OR list_has_any([e[i:i+3] FOR i IN range(1, length(e) - 2)], [s[i:i+3] FOR i IN range(1, length(s) - 2)])) AS grounded FROM t""")
def k9b(spark, d):
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn", "role"))
    turns = table(spark, d, "conversations").select("conv_id", "turn", "text", before.alias("source"))
    return turns.select("conv_id", "turn", M.grounded_in(F.col("source"), F.col("text")).alias("grounded"))


@query("k9_common_length", """
SELECT p_partkey, coalesce(list_max([list_max([n FOR n IN range(1, length(p_type) - i + 2) IF contains(p_name, p_type[i:i+n-1])]) FOR i IN range(1, length(p_type) + 1)]), 0) AS common FROM part""")
def k9c(spark, d):
    return table(spark, d, "part").select("p_partkey", M.common_length("p_type", "p_name").cast("long").alias("common"))


@query("k10_scores", """
SELECT doc_id, a, b, round(abs(a - b) / (a + b + 1e-6), 6) AS margin FROM (SELECT doc_id,
  CAST(contains(text, 'License') AS INT) + CAST(contains(text, 'http') AS INT) + CAST(contains(text, 'example.com') AS INT) + CAST(contains(text, '@') AS INT) AS a,
  CAST(contains(text, 'the') AS INT) + CAST(contains(text, 'und') AS INT) + CAST(contains(text, 'que') AS INT) + CAST(contains(text, 'de') AS INT) AS b FROM documents)""")
def k10(spark, d):
    scored = table(spark, d, "documents").select("doc_id", M.hits("text", TECHNICAL).alias("a"), M.hits("text", PLAIN).alias("b"))
    return scored.withColumn("margin", F.round(F.abs(F.col("a") - F.col("b")) / (F.col("a") + F.col("b") + 1e-6), 6))


@query("k11_tolerant_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def k11(spark, d):
    shapes = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("answer: "), "props", F.lit(" done"))).otherwise(F.replace("props", F.lit("}"), F.lit(",}")))
    return M.tolerant_json(table(spark, d, "events").select("event_id", shapes.alias("raw")), "raw", "k long").select("event_id", "parsed.k")


@query("k12_relevance", """
WITH s AS (SELECT doc_id, source, 3 * CAST(contains(text, 'License') AS INT) + 2 * CAST(contains(text, 'the') AS INT) + CAST(contains(source, '1') AS INT) AS score FROM documents)
SELECT source, max(score) AS best, count(*) AS n, arg_max(doc_id, score * 100000000 - doc_id) AS sample FROM s WHERE score > 0 GROUP BY 1 ORDER BY best DESC, n DESC, source LIMIT 10""")
def k12(spark, d):
    score = 3 * M.hits("text", ("License",)) + 2 * M.hits("text", ("the",)) + M.hits("source", ("1",))
    scored = table(spark, d, "documents").select("doc_id", "source", score.alias("score")).where("score > 0")
    best = scored.groupBy("source").agg(F.max("score").alias("best"), F.count("*").alias("n"), F.max_by("doc_id", F.struct("score", -F.col("doc_id"))).alias("sample"))
    return best.orderBy(F.desc("best"), F.desc("n"), "source").limit(10)


#: Searches, by name.
SEARCHES = {"licence": "MIT License granted", "place": "src1 example com", "words": "the und que"}

_TOKENS = "list_transform(regexp_extract_all(coalesce({0}, ''), '[0-9A-Za-z]+'), lambda t: lower(t))"


@query("k12_bm25", f"""
WITH f AS (SELECT doc_id, 'text' AS field, {_TOKENS.format("text")} AS t FROM documents UNION ALL SELECT doc_id, 'source', {_TOKENS.format("source")} FROM documents),
s AS (SELECT field, count(*) AS docs, avg(len(t)) AS mean FROM f WHERE len(t) > 0 GROUP BY 1), p AS (SELECT doc_id, field, len(t) AS length, unnest(t) AS term FROM f),
q AS (SELECT DISTINCT query, unnest(string_split(terms, ' ')) AS term FROM (VALUES ('licence', 'mit license granted'), ('place', 'src1 example com'), ('words', 'the und que')) v(query, terms)),
c AS (SELECT doc_id, field, length, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3, 4), n AS (SELECT field, term, count(*) AS df FROM c GROUP BY 1, 2),
r AS (SELECT query, doc_id, round(sum(CASE field WHEN 'text' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END * ln(1 + (docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))), 4) AS score
  FROM c JOIN n USING (field, term) JOIN s USING (field) JOIN q USING (term) GROUP BY 1, 2)
SELECT query, source, max(score) AS best, count(*) AS n, arg_min(r.doc_id, (-score, r.doc_id)) AS sample FROM r JOIN documents d ON d.doc_id = r.doc_id GROUP BY 1, 2""")
def k12b(spark, d):
    """For each search and source: the best score, the documents found and the best of them."""
    docs, path = table(spark, d, "documents"), scratch(spark, "index")
    relevance.build(docs, "doc_id", ["text", "source"], path)
    found = relevance.search(spark, path, SEARCHES, {"text": 1.0, "source": 2.0}).select("query", F.col("key").alias("doc_id"), F.round("score", 4).alias("score"))
    return found.join(docs.select("doc_id", "source"), "doc_id").groupBy("query", "source").agg(
        F.max("score").alias("best"), F.count("*").alias("n"), F.max_by("doc_id", F.struct("score", -F.col("doc_id"))).alias("sample")
    )


@query("k13_phrase_any_field", "SELECT doc_id FROM documents WHERE contains(concat_ws(' ', source, lang, text), 'src7 en') OR contains(concat_ws(' ', source, lang, text), 'MIT License')")
def k13(spark, d):
    every = F.concat_ws(" ", "source", "lang", "text")
    return table(spark, d, "documents").where(F.contains(every, F.lit("src7 en")) | F.contains(every, F.lit("MIT License"))).select("doc_id")


@query("k14_first_with_signal", """
SELECT conv_id, min(turn) AS turn, arg_min(role, turn) AS role FROM conversations WHERE contains(text, 'the') OR contains(text, 'que') GROUP BY 1""")
def k14(spark, d):
    rows = table(spark, d, "conversations").where(M.any_of("text", ("the", "que")))
    return rows.groupBy("conv_id").agg(F.min("turn").alias("turn"), F.min_by("role", "turn").alias("role"))
