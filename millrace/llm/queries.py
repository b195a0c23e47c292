"""Queries of this package's operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, classifier, divergence, infill, minhash, packing, quality_rules, segmentations, sharding, suffixes, url_rules, vectors_dedup, vocabulary, warc
from millrace.llm.common import read_table


def conversation_events(conversations: DataFrame) -> DataFrame:
    """An event log that ends in the given conversations.

    Every row is one message. It first streams a draft, the text back to front, which is then discarded: by a
    regeneration for assistants, by an edit for the others, which holds the first half of the text. The rest
    is streamed after it.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # repeated rows and turns are messages of their own: equal (turn, role, text) differ by their number alone
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("_n"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    half = F.floor(F.length("text") / 2).cast("int")
    assistant = F.col("role") == "assistant"
    first, second = F.left("text", half), F.substr("text", half + 1)
    steps = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("delta").alias("kind"), F.reverse("text").alias("part")),
        F.struct(F.lit(1).alias("seq"), F.when(assistant, F.lit("regenerate")).otherwise(F.lit("edit")).alias("kind"), first.alias("part")),
        F.struct(F.lit(2).alias("seq"), F.lit("delta").alias("kind"), second.alias("part")),
    )
    message = F.struct("turn", "role", F.sha2("text", 256).alias("digest"), "copy")
    return each.select("conv_id", message.alias("message_id"), "role", F.explode(steps).alias("s")).select(
        "conv_id", "message_id", "role", "s.seq", "s.kind", F.col("s.part").alias("text")
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql(
        "SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text"
        " FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"
    )
    messages = chat.fold_events(conversation_events(table.unionByName(own)))
    out = chat.read_back(chat.assemble(chat.render(messages)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text)) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, sha256(text)) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>\[\]]', '', 'g')) + 17) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    q = quality_rules.measure(docs, "q")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "token_entropy")
    return q.select("doc_id", *[F.col(f"q.{c}").alias(c) for c in names])


def op2_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = segmentations.sample(docs, 3)
    ids = F.col("ids")
    return out.select("doc_id", "rank", "log_prob", "perturbed", "inclusion", "log_inclusion", (F.length(ids) / 4).cast("long").alias("n_pieces"), F.crc32(ids).alias("ids_crc32"), F.crc32("text").alias("text_crc32"))


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
), ok AS (
  SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (
  WITH RECURSIVE r(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, links.y FROM r JOIN links ON r.other = links.x
  ) SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id
), n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN reach USING (vec_id) LEFT JOIN n USING (vec_id)
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_archives(read_table(spark, sf_dir, "pages"), warc.new_directory(spark))
    read = warc.read_archives(written, with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p
"""


def op6_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.repeated_passages(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP7_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), chunks AS (
  SELECT doc_id, n, k, x[1024*k+1:1024*k+1222] AS c FROM (SELECT *, unnest(range((n + 511) // 512)) AS k FROM d)
), places AS (
  SELECT doc_id, 512 * k + j AS i, md5_number(c[2*j+1:2*j+200]) AS w FROM (SELECT *, unnest(range(least(512, n - 99 - 512 * k))) AS j FROM chunks)
), judged AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1 AS later FROM places
), edges AS (
  SELECT doc_id, i, coalesce(i > 100 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS new FROM judged WHERE later
), runs AS (
  SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges) GROUP BY doc_id, run
), cuts AS (
  SELECT doc_id, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his FROM runs GROUP BY doc_id
), pieces AS (
  SELECT d.doc_id, x, n AS n_bytes, [0] || coalesce(his, []) AS froms, coalesce(los, []) || [n] AS tos, coalesce(len(los), 0) AS n_spans
  FROM d LEFT JOIN cuts USING (doc_id)
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_bytes - list_sum([tos[k] - froms[k] FOR k IN range(1, n_spans + 2)]) AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
  sha256(unhex(array_to_string([x[2*froms[k]+1:2*tos[k]] FOR k IN range(1, n_spans + 2)], ''))) AS kept_sha256
FROM pieces
"""


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


OP8_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, unnest(s) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= 85 * (len(a.s) + len(b.s) - n)
), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  WITH RECURSIVE r(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, ways.y FROM r JOIN ways ON r.other = ways.x
  ) SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN reach USING (doc_id)
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = vocabulary.default_path("byte_bpe_50k.json")
    return packing.pack(read_table(spark, sf_dir, "documents"), length=1024, added_path=added).drop("ids")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleave(read_table(spark, sf_dir, "documents"), 40, seed=42)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source")


#: The checksum's table of 256 entries, made in SQL one bit at a time.
_CRC_TABLE = "step0 AS (SELECT i, i AS c FROM range(256) r(i))" + "".join(
    f", step{k} AS (SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM step{k - 1})" for k in range(1, 9)
)

OP10_SQL = f"""
WITH {_CRC_TABLE}, crc AS (SELECT list(c ORDER BY i) AS t FROM step8
), d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS x FROM documents
), sized AS (
  SELECT doc_id, source, CAST(strlen(text) + 16 AS BIGINT) AS size,
    xor(list_reduce(list_transform(regexp_extract_all(x, '..'), lambda h: CAST('0x' || h AS BIGINT)), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) AS text_crc32
  FROM d, crc
), hashed AS (
  SELECT *, CAST('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_crc32), 1, 15) AS BIGINT) AS h FROM sized
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) - 1 AS r, count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM hashed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::HUGEINT * 549755813888 // n, h, source NULLS FIRST, doc_id, text_crc32, size) - 1 AS pos FROM ranked
), cut AS (SELECT *, pos * 40 // total AS shard FROM placed)
SELECT doc_id, source, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(pos - (shard * total + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM cut
"""


#: Verdict, host and path of each rule.
HOST_RULES = [
    url_rules.HostRule("allow", "com", "/"),
    url_rules.HostRule("block", "example.com", "/en/"),
    url_rules.HostRule("allow", "www.example.com", "/en/"),
    url_rules.HostRule("block", "net", "/es/"),
    url_rules.HostRule("block", "net", "/fr/"),
]


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", bad)
    return url_rules.judge(read_table(spark, sf_dir, "pages"), labels, HOST_RULES, support=0.002, least=5, confidence=0.5, longest=16)


#: Rules are all token sets with enough support and confidence; those that contain another one change no verdict.
OP11_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS a FROM pages
), s AS (
  SELECT row_number() OVER () AS r, page_id, translate(regexp_extract(a, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path,
    translate(substr(a, length(regexp_extract(a, '^[^?#]*')) + 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS rest FROM u
), t AS MATERIALIZED (
  SELECT *, list_sort(list_distinct([kind || ':' || w FOR w IN ws]
    || [ 'p:' || w FOR w IN regexp_extract_all(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF NOT regexp_full_match(w, '[0-9]+')]
    || [ 'q:' || w FOR w IN regexp_extract_all(rest, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF NOT regexp_full_match(w, '[0-9]+')])) AS tokens
  FROM (SELECT *, 'h' AS kind, [w FOR w IN regexp_extract_all(host, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF NOT regexp_full_match(w, '[0-9]+')] AS ws FROM s)
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad FROM labels GROUP BY doc_id
), labelled AS MATERIALIZED (
  SELECT r, tokens, bad FROM t JOIN marks ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{1,18})(?:/|\.[^/]*)?$', 1) AS BIGINT)
), least AS (SELECT greatest(5, CAST(ceil(0.002 * count(*)) AS BIGINT)) AS n FROM labelled
), known AS (
  SELECT token FROM (SELECT r, unnest(tokens) AS token FROM labelled WHERE bad) GROUP BY token HAVING count(*) >= (SELECT n FROM least)
), items AS (
  SELECT r, list(token ORDER BY token) AS items FROM (SELECT r, unnest(tokens) AS token FROM labelled WHERE bad) JOIN known USING (token) GROUP BY r
), sets AS (
  SELECT [items[k + 1] FOR k IN range(len(items)) IF (bits >> k) & 1 = 1] AS rule FROM (SELECT items, unnest(range(1, 1 << len(items))) AS bits FROM items)
), often AS (
  SELECT rule, count(*) AS n_bad FROM sets GROUP BY rule HAVING count(*) >= (SELECT n FROM least)
), rules AS MATERIALIZED (
  SELECT rule FROM often JOIN labelled ON list_has_all(tokens, rule) GROUP BY rule, n_bad HAVING n_bad >= 0.5 * count(*)
), fixed(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT r, max_by(f.host || f.path, length(f.host || f.path)) AS rule, max_by(f.verdict, length(f.host || f.path)) AS verdict
  FROM t JOIN fixed f ON (t.host = f.host OR ends_with(t.host, '.' || f.host)) AND starts_with(t.path, f.path) GROUP BY r
), mined AS (SELECT DISTINCT r FROM t JOIN rules ON list_has_all(tokens, rules.rule))
SELECT page_id, host, path, fits.rule, coalesce(fits.verdict, CASE WHEN mined.r IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM t LEFT JOIN fits USING (r) LEFT JOIN mined USING (r)
"""


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.transform(read_table(spark, sf_dir, "documents"), seed=42, percent=50, spm_percent=80)
    return out.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents
), h AS (
  SELECT *, len(u) AS n, [CAST('0x' || substr(s, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS h FROM d
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a+1:b], '') AS middle, array_to_string(u[b+1:], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"), least_docs=10, top=10)


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), langs AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT g.lang, source, v, langs.total AS lang_total, coalesce(c.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) c USING (lang, source)
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (total + 2 * v) AS BIGINT) AS p,
    CAST(1 + (1000000000 * (kept.n + 2)::HUGEINT) // (lang_total + 2 * v) AS BIGINT) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b USING (lang) LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source WHERE a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""


# What SQL can tell of operators whose tokens it cannot express.


def base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1's counts of words, lines and windows, and its base rules."""
    return op1_fertility(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


BASE_COUNTS_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i+7], ' ') AS v FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY 1
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  len(words) < 20 OR 100 * coalesce(n, 0) > 30 * len(words) AS base_failed
FROM w LEFT JOIN covered USING (doc_id)
"""


def segmentation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that the best of operator 2's segmentations decodes to."""
    out = segmentations.sample(read_table(spark, sf_dir, "documents").select("doc_id", "text"), 1)
    return out.select("doc_id", F.sha2(segmentations.decode(F.col("ids")), 256).alias("text_sha256"))


def packed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that operator 9's pieces of a document decode to, and whether they cover it without gap or overlap."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, length=1024, added_path=vocabulary.default_path("byte_bpe_50k.json"))
    whole = pieces.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "ids"))).alias("p"), F.max("doc_tokens").alias("n"), F.sum("length").alias("covered")
    )
    # every piece begins where the one before ends
    follows = F.forall(F.sequence(F.lit(1), F.size("p")), lambda i: F.when(i == 1, F.get("p", F.lit(0))["start"] == 0).otherwise(F.get("p", i - 1)["start"] == F.get("p", i - 2)["start"] + F.get("p", i - 2)["length"]))
    ids = F.concat(F.array(), F.transform("p", lambda x: F.hex(x["ids"])))
    text = packing.decode(F.unhex(F.array_join(ids, "")))
    return whole.select("doc_id", F.sha2(text, 256).alias("text_sha256"), (follows & (F.col("covered") == F.col("n"))).alias("covered"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fertility": op1_fertility,
    "op2_segmentations": op2_segmentations,
    "op3_vectors": op3_vectors,
    "op4_chat": op4_chat,
    "op5_warc": op5_warc,
    "op6_classifier": op6_classifier,
    "op7_suffixes": op7_suffixes,
    "op8_minhash": op8_minhash,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_urls": op11_urls,
    "op12_infill": op12_infill,
    "op13_divergence": op13_divergence,
    "base_counts": base_counts,
    "segmentation_texts": segmentation_texts,
    "packed_texts": packed_texts,
}

ORACLES: dict[str, str] = {
    "op3_vectors": OP3_SQL,
    "op4_chat": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op7_suffixes": OP7_SQL,
    "op8_minhash": OP8_SQL,
    "op10_sharding": OP10_SQL,
    "op11_urls": OP11_SQL,
    "op12_infill": OP12_SQL,
    "op13_divergence": OP13_SQL,
    "base_counts": BASE_COUNTS_SQL,
    "segmentation_texts": "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents",
    "packed_texts": "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, true AS covered FROM documents",
}
