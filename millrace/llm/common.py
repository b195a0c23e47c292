"""Helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Where the setting is missing, a local session, as in tests, takes a new temporary folder; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    made = getattr(spark, "_millrace_checkpoint_dir", None)
    if made is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        made = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark._millrace_checkpoint_dir = made
    return made


def cut(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder, so that a lost executor does not cost its lineage."""
    spark = df.sparkSession
    directory = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(directory)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """A frame written as Parquet to the shared folder and read again.

    For loops in which every round joins the result of the one before: with checkpointed frames rounds were measured to
    take longer and longer, probably for the constraints that the optimizer keeps for these; a table that is read has none.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of whole texts that one Arrow batch holds; Spark's default of 10,000 would be as many MB as a text has hundreds of characters.
TEXT_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, which hold whole texts in the JVM and in the Python workers at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > TEXT_ROWS:
        spark.conf.set(name, str(TEXT_ROWS))


def shuffle_width(spark: SparkSession, least: int = 1) -> int:
    """Partitions of a shuffle whose number Spark must not change."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_held: dict[str, object] = {}
_let_go: list[Callable[[], None]] = []


def let_go_with_tables(*caches: Callable[[], None]) -> None:
    """Functions that empty what the tables of of_worker() are made with."""
    _let_go.extend(caches)


def of_worker(name: str, make):
    """What ``make`` returns, kept in this Python worker until another name is asked for.

    Workers outlive stages; so only the tables of the operator at work take memory.
    """
    if name not in _held:
        no_tables()
        _held[name] = make()
    return _held[name]


_trimmed = 0.0


def no_tables() -> None:
    """Let go of what of_worker() holds, for operators that keep no tables of their own, and hand freed memory back to the system.

    Allocators keep it otherwise, and workers outlive stages. Memory is handed back once a second at most.
    """
    global _trimmed
    if _held:
        _held.clear()
        for empty in _let_go:
            empty()
        gc.collect()
    elif time.monotonic() - _trimmed < 1:
        return
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)
    _trimmed = time.monotonic()
