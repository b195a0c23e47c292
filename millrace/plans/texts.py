"""T: text statistics, chunking and vector search."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import text as T
from millrace.operators import vectors as V
from millrace.plans.registry import query
from millrace.sources.tables import table


@query("t1_text_counts", r"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(len(regexp_extract_all(text, '[^ \t\n\r]+')) AS BIGINT) AS words, CAST(len(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]')) AS BIGINT) AS ideographs,
  CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines, CAST(len(list_filter(string_split(text, chr(10) || chr(10)), lambda x: trim(x, ' ' || chr(10)) <> '')) AS BIGINT) AS paragraphs FROM documents""")
def t1(spark, d):
    return T.counts(table(spark, d, "documents"), "doc_id", "text")


@query("t2_find_replace", r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '[0-9]+')) AS BIGINT) AS n, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS digest, CAST((length(text) - length(replace(text, 'the', ''))) // 3 AS BIGINT) AS literal FROM documents""")
def t2(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.regexp_count("text", F.lit("[0-9]+")).cast("long").alias("n"), F.md5(F.regexp_replace("text", "[0-9]+", "#").cast("binary")).alias("digest"),
        F.regexp_count("text", F.lit("the")).cast("long").alias("literal"),
    )


@query("t3_pattern_counts", r"""
SELECT doc_id, CAST(len(list_distinct(regexp_extract_all(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+'))) AS BIGINT) AS emails, CAST(len(list_distinct(regexp_extract_all(text, 'https?://[A-Za-z0-9./_?=#&-]+'))) AS BIGINT) AS urls,
  md5(regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', '[mail]', 'g')) AS redacted FROM documents""")
def t3(spark, d):
    return T.redact(table(spark, d, "documents"), "doc_id", "text")


@query("t4_term_frequency", r"""
SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents) WHERE length(term) > 1 GROUP BY 1 ORDER BY n DESC, term LIMIT 50""")
def t4(spark, d):
    return T.term_frequency(table(spark, d, "documents"), "text", 50)


@query("t5_cleaned_lines", r"""
SELECT doc_id, md5(array_to_string(list_filter([trim(regexp_replace(x, '[ \t]+', ' ', 'g'), ' ') FOR x IN string_split(text, chr(10))], lambda x: length(x) >= 10), chr(10))) AS digest FROM documents""")
def t5(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.cleaned(F.col("text"), 10).cast("binary")).alias("digest"))


@query("t6_chunks")
def t6(spark, d):
    return T.chunks(table(spark, d, "documents"), "doc_id", "text", 500).select("doc_id", "chunk", F.length("chunk_text").alias("chars"), F.md5(F.col("chunk_text").cast("binary")).alias("digest"))


@query("t6_chunks_cover", "SELECT doc_id, md5(text) AS digest FROM documents WHERE text <> ''")
def t6b(spark, d):
    pieces = T.chunks(table(spark, d, "documents"), "doc_id", "text", 500)
    whole = F.transform(F.sort_array(F.collect_list(F.struct("chunk", "chunk_text"))), lambda x: x["chunk_text"])
    return pieces.groupBy("doc_id").agg(F.md5(F.array_join(whole, "").cast("binary")).alias("digest"))


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents"


@query("t7_overlap", f"""
WITH l AS ({_LINES}) SELECT doc_id, i AS chunk, md5(coalesce(right(lag(line) OVER (PARTITION BY doc_id ORDER BY i), 20), '') || line) AS digest FROM l""")
def t7(spark, d):
    out = T.overlapping(T.lines(table(spark, d, "documents"), "doc_id", "text"), "doc_id", "chunk", "chunk_text", 20)
    return out.select("doc_id", "chunk", F.md5(F.col("chunk_text").cast("binary")).alias("digest"))


@query("t8_chunk_metadata", f"""
WITH l AS ({_LINES}) SELECT doc_id, i AS chunk_id, count(*) OVER (PARTITION BY doc_id) AS total_chunks, CAST(length(line) AS BIGINT) AS char_count FROM l""")
def t8(spark, d):
    total = F.count("*").over(Window.partitionBy("doc_id"))
    return T.lines(table(spark, d, "documents"), "doc_id", "text").select(
        "doc_id", F.col("chunk").alias("chunk_id"), total.alias("total_chunks"), F.length("chunk_text").cast("long").alias("char_count")
    )


_NORMAL = """n AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), v AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM n WHERE list_inner_product(e, e) > 0)"""
_TOP = f"""WITH {_NORMAL}, s AS (SELECT a.vec_id AS query_id, b.vec_id, b.label, round(list_inner_product(a.e, b.e) / (a.norm * b.norm), 5) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)"""


@query("t9_vector_top_k", _TOP + " SELECT query_id, vec_id, rank, score FROM t WHERE rank <= 5")
def t9(spark, d):
    vectors = table(spark, d, "embeddings")
    return V.top_k(vectors.where("vec_id % 50 = 0"), vectors, "vec_id", "embedding", 5)


@query("t10_vector_statistics", "SELECT count(*) AS n, CAST(min(len(embedding)) AS BIGINT) AS least, CAST(max(len(embedding)) AS BIGINT) AS most, count(DISTINCT label) AS labels FROM embeddings")
def t10(spark, d):
    size = F.size("embedding").cast("long")
    return table(spark, d, "embeddings").agg(F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most"), F.countDistinct("label").alias("labels"))


@query("t11_label_prototypes", f"""
WITH {_NORMAL}, u AS (SELECT label, i, avg(e[i] / norm) AS x FROM v, range(1, 65) r(i) GROUP BY 1, 2), c AS (SELECT label, list(x ORDER BY i) AS p FROM u GROUP BY 1),
s AS (SELECT vec_id, c.label, round(list_inner_product(e, p) / (norm * sqrt(list_inner_product(p, p))), 5) AS score FROM v, c)
SELECT vec_id, label, score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS r FROM s) WHERE r = 1""")
def t11(spark, d):
    return V.nearest_prototype(table(spark, d, "embeddings"), "vec_id", "embedding", "label")


@query("t12_enrichment_hook", """SELECT doc_id, CASE WHEN contains(text, 'License') THEN 'legal' WHEN contains(text, '!!') THEN 'loud' ELSE 'plain' END AS topic FROM documents""")
def t12(spark, d):
    return T.enrich(table(spark, d, "documents").select("doc_id", "text"), T.rule_stub([("License", "legal"), ("!!", "loud")], "plain"), "doc_id long, topic string")


@query("t13_batch_counts", "SELECT lang, count(*) AS given, count(*) AS returned, true AS complete FROM documents GROUP BY 1")
def t13(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    answers = T.enrich(docs.select("doc_id", "text"), T.rule_stub([], "plain"), "doc_id long, topic string")
    given = docs.groupBy("lang").agg(F.count("*").alias("given"))
    returned = docs.select("doc_id", "lang").join(answers, "doc_id").groupBy("lang").agg(F.count("*").alias("returned"))
    return given.join(returned, "lang", "left").select("lang", "given", F.coalesce("returned", F.lit(0)).alias("returned"), F.coalesce(F.col("given") == F.col("returned"), F.lit(False)).alias("complete"))


@query("t14_retrieval", _TOP + ", d AS (SELECT doc_id, source, substr(text, 1, 40) AS head FROM documents) SELECT query_id, rank, score, doc_id, source, head FROM t JOIN d ON d.doc_id = t.vec_id WHERE rank <= 3")
def t14(spark, d):
    vectors = table(spark, d, "embeddings")
    found = V.top_k(vectors.where("vec_id % 50 = 0"), vectors, "vec_id", "embedding", 3)
    docs = table(spark, d, "documents").select("doc_id", "source", F.substring("text", 1, 40).alias("head"))
    return found.join(docs, F.col("vec_id") == F.col("doc_id")).select("query_id", "rank", "score", "doc_id", "source", "head")


@query("t15_sentences", r"""
SELECT doc_id, i - 1 AS position, md5(trim(regexp_replace(s, '^[\s]+|[\s]+$', '', 'g'))) AS digest FROM (
  SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?]+[.!?]*[\s]*') AS l FROM documents))""")
def t15(spark, d):
    rows = table(spark, d, "documents").lateralJoin(T.Sentences(F.col("text").outer()))
    return rows.select("doc_id", F.col("position").cast("long").alias("position"), F.md5(F.col("sentence").cast("binary")).alias("digest"))
