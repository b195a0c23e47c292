"""Targets in hash buckets that take updates: a merge reads and writes the buckets of its keys and no others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import changes
from millrace.streaming import jobs as J

_BUCKET = "_bucket"


def _in_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _save(rows: DataFrame, path: str, rows_per_file: int) -> None:
    writer = rows.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy(_BUCKET).parquet(path)


def create(df: DataFrame, path: str, key: str, buckets: int, rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` as a target: one folder for each bucket of ``key``. A null key has a bucket like others."""
    _save(_in_buckets(df, key, buckets), path, rows_per_file)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(_BUCKET)


def merge(spark: SparkSession, path: str, updates: DataFrame, key: str, buckets: int, aside: str, order: str | None = None, rows_per_file: int = 1_000_000) -> DataFrame:
    """action, n: how many keys the updates insert into the target at ``path``, and how many they update; see changes.upsert() for the rule.

    Only the buckets of the updates' keys are read and replaced; all other files stay. The new buckets are first written to ``aside``, so
    that a merge which is interrupted while it replaces them can be repeated: where ``aside`` is complete, it is taken as it is.
    Updates of a null key name no row. Without updates nothing is touched.
    """
    target = spark.read.parquet(path)
    columns = [c for c in target.columns if c != _BUCKET]
    if not J.exists(spark, f"{aside}/counts/_SUCCESS"):
        given = _in_buckets(updates.where(F.col(key).isNotNull()), key, buckets)
        touched = [r[0] for r in given.select(_BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        old = target.where(F.col(_BUCKET).isin(touched)).select(*columns)
        merged = changes.upsert(old, given.drop(_BUCKET), key, order)
        _save(_in_buckets(merged, key, buckets), f"{aside}/rows", rows_per_file)
        keys = given.select(key).distinct().join(old.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
        counts = keys.groupBy(F.when(F.col("_known"), "update").otherwise("insert").alias("action")).agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{aside}/counts")
    fresh = J.written(spark, f"{aside}/rows", target.schema)
    _save(fresh.select(*columns, _BUCKET), path, rows_per_file)
    return spark.read.schema("action string, n long").parquet(f"{aside}/counts")


def merge_stream(spark: SparkSession, source: str, path: str, key: str, buckets: int, out: str, order: str | None = None, files: int = 64, columns: Sequence[str] | None = None) -> DataFrame:
    """action, n over a stream of updates at ``source``, each batch merged into the target at ``path``.

    A call with the same ``out`` goes on where the last one ended; a batch that runs again merges what it has merged before and counts once.
    An empty stream changes nothing.
    """
    stream = J.events(spark, source, files)
    stream = stream.select(*columns) if columns else stream

    def write(batch: DataFrame, number: int) -> None:
        counts = merge(batch.sparkSession, path, batch, key, buckets, f"{out}/aside/batch={number}", order)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/batch={number}")

    J.run(stream, each=write, out=out)
    return J.written(spark, f"{out}/counts", "action string, n long").groupBy("action").agg(F.sum("n").alias("n"))
