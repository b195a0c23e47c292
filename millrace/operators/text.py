"""Text statistics, cleaning, chunking and the enrichment hook."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import small_batches


def counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, chars, words, ideographs, lines, paragraphs."""
    n = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    paragraphs = F.size(F.filter(F.split(text, "\n\n"), lambda x: F.regexp_replace(x, r"^[ \n]+", "") != "")).cast("long")
    return df.select(
        key, F.length(text).cast("long").alias("chars"), n(r"[^ \t\n\r]+").alias("words"), n("[一-鿿]").alias("ideographs"),
        F.size(F.split(text, "\n")).cast("long").alias("lines"), paragraphs.alias("paragraphs"),
    )


def redact(df: DataFrame, key: str, text: str) -> DataFrame:
    """Numbers of distinct addresses in a text, and a digest of the text without mail addresses; the addresses are not listed."""
    mail, url = "[A-Za-z0-9._]+@[A-Za-z0-9.]+", "https?://[A-Za-z0-9./_?=#&-]+"
    distinct = lambda p: F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(p), F.lit(0)))).cast("long")
    return df.select(key, distinct(mail).alias("emails"), distinct(url).alias("urls"), F.md5(F.regexp_replace(text, mail, "[mail]").cast("binary")).alias("redacted"))


def term_frequency(df: DataFrame, text: str, n: int) -> DataFrame:
    """term, n of the ``n`` most frequent lower-case runs of two or more ASCII letters, ties by term. Null texts have none; repeated rows count each."""
    terms = df.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))).alias("term")).where(F.length("term") > 1)
    return terms.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(n)


def cleaned(text: Column, least: int) -> Column:
    """Lines with single blanks, those of fewer than ``least`` characters dropped."""
    tidy = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.array_join(F.filter(tidy, lambda x: F.length(x) >= least), "\n")


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, chunk (from 1), chunk_text: the lines of each text. An empty text is one empty line, a null one has none; rows of equal keys stay apart."""
    rows = df.select(key, F.posexplode(F.split(text, "\n")).alias("i", "chunk_text"))
    return rows.select(key, (F.col("i") + 1).cast("long").alias("chunk"), "chunk_text")


def split_text(text: str, size: int) -> list[str]:
    """Pieces of at most ``size`` characters that end, if they can, after a paragraph, a line, a sentence or a word."""
    out, at = [], 0
    while at < len(text):
        end = min(at + size, len(text))
        if end < len(text):
            for mark in ("\n\n", "\n", ". ", " "):
                cut = text.rfind(mark, at + size // 2, end)
                if cut >= 0:
                    end = cut + len(mark)
                    break
        out.append(text[at:end])
        at = end
    return out


#: Characters of the texts whose pieces a Python worker holds at once, unless one text has more.
_HELD = 1 << 20


def _pieces(batches: Iterator[pa.RecordBatch], size: int, held: int = _HELD) -> Iterator[pa.RecordBatch]:
    """key, chunk, chunk_text of batches of (key, text), in batches of few texts."""
    for batch in batches:
        begin, n, sizes, out = 0, 0, [], []
        for i, text in enumerate(batch.column(1), 1):
            found = split_text(text.as_py() or "", size)
            sizes.append(len(found))
            out += found
            n += sum(map(len, found))
            if out and (n >= held or i == batch.num_rows):
                many = np.array(sizes)
                keys = batch.column(0).slice(begin, len(sizes)).take(pa.array(np.repeat(np.arange(len(sizes)), many)))
                chunk = np.arange(len(out)) - np.repeat(np.cumsum(many) - many, many) + 1
                yield pa.RecordBatch.from_arrays([keys, pa.array(chunk, pa.int64()), pa.array(out, pa.string())], ["key", "chunk", "chunk_text"])
                begin, n, sizes, out = i, 0, [], []


def chunks(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, chunk (from 1), chunk_text: a text in pieces that add up to it. Null and empty texts have none.

    A worker holds a batch of whole texts and the pieces of about a million characters.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, chunk long, chunk_text string"
    return rows.mapInArrow(lambda batches: _pieces(batches, size), schema).withColumnRenamed("key", key)


def overlapping(df: DataFrame, key: str, order: str, text: str, overlap: int) -> DataFrame:
    """Chunks with the last ``overlap`` characters of the one before in front."""
    before = F.lag(text).over(Window.partitionBy(key).orderBy(order))
    return df.withColumn(text, F.concat(F.coalesce(F.right(before, F.lit(overlap)), F.lit("")), F.col(text)))


def rule_stub(rules: Sequence[tuple[str, str]], default: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A deterministic stand-in for an external model: the topic of the first rule whose term a text holds."""

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        def topic(text):
            return next((t for term, t in rules if term in (text or "")), default)

        return pd.DataFrame({"doc_id": rows["doc_id"], "topic": rows["text"].map(topic)})

    return judge


def enrich(df: DataFrame, judge: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Every batch of rows through ``judge``, which may call an external service and returns frames of ``schema``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(judge, batches)

    return df.mapInPandas(run, schema)


SENTENCE = re.compile(r"[^.!?]+[.!?]*\s*")


@F.udtf(returnType=T.StructType([T.StructField("position", T.IntegerType()), T.StructField("sentence", T.StringType())]))
class Sentences:
    """Table function: position (from 0) and sentence, trimmed. A null or empty text, or one of stops alone, has none."""

    def eval(self, text: str):
        for i, m in enumerate(SENTENCE.finditer(text or "")):
            yield i, m[0].strip()
