"""A training corpus from raw documents: classify, apply rules, remove near-duplicates and repeated passages, pack.

Each stage takes what its predecessor kept. The first four return the columns of documents, whatever these are called; the last
returns pieces of packed sequences. All of them take rows with nulls in any column and whole texts of any length, judge every row by
itself where keys are null or repeat, and make an empty result of an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import classifier, minhash, packing, quality_rules, suffixes, vocabulary
from millrace.llm.common import read_table, shared_dir


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is near that of trusted ones of their language.

    Null and empty texts go. Rows of a null language are held against all trusted documents, null keys have no label, and repeated
    rows stay or go together. Without any trusted text all others stay.
    """
    return classifier.keep(docs, read_table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's fertility bands.

    Null, empty and short texts go; a null or unknown language takes the band of the text's script. Repeated rows stay or go together.
    """
    return quality_rules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is alike in 0.8 or more of its five-word shingles: that of the smallest key, null last.

    Of exactly repeated rows one stays. Texts without words are alike to none and stay.
    """
    return minhash.keep(docs, percent=80)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 100 bytes that an earlier place holds; n_chars is counted anew.

    No row goes. A null text becomes an empty one. Earlier is by key, null last, and by text where keys are equal.
    """
    return suffixes.remove(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, as pieces of documents along the curve.

    A null or empty text is its end id alone; repeated rows and null keys are documents like others.
    """
    return packing.pack(docs, length=1024, added_path=vocabulary.default_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", remove_passages),
    ("packing", pack),
]

#: Models and tokenizers are not expressible in SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each but the last is written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
