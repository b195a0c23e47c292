"""Scans in pages and time slices, line parsing, flattening and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import small, unused
from millrace.sources.tables import scratch


def keyset_pages(df: DataFrame, key: str, needed: str, page: int) -> DataFrame:
    """Key ranges of ``page`` keys over the rows whose ``needed`` is not empty: page, n, first_key, last_key.

    Pages are ranges of the key, so the filter reaches the scan and no page waits for the one before.
    """
    rows = df.where(F.col(needed).isNotNull() & (F.col(needed) != ""))
    return rows.groupBy(F.floor(F.col(key) / page).alias("page")).agg(F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def bounded_scan(df: DataFrame, columns: Sequence[str], max_docs: int | None = None, order: str | None = None) -> DataFrame:
    """The columns of all rows, or of the first ``max_docs`` by ``order``; the projection reaches the scan. A bound over the number of rows takes all."""
    rows = df.select(*columns)
    if max_docs is None:
        return rows
    return (rows.orderBy(order) if order else rows).limit(max_docs)


def row_pages(df: DataFrame, key: str, needed: str, page: int, pages_per_range: int = 64) -> DataFrame:
    """Rows whose ``needed`` is not empty, with the page of ``page`` rows they stand on in the order of ``key``, from 0.

    Rows are sorted in ranges of about ``pages_per_range`` pages that Spark chooses from a sample of the keys, and ties are dealt out by their place in the
    input, so that neither far-off keys nor one that most rows have fill a range. The ranges' counts give each its first rank; no page waits for the
    one before. Rows of equal keys may fall on either side of a page's end; a null key comes first. Extra columns stay whatever they are called, one called page is
    replaced, and an empty table has no page.
    """
    spark = df.sparkSession
    rows = df.where(F.col(needed).isNotNull() & (F.col(needed) != "")).select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "page"]).alias("row"), F.col(key).alias("k"))
    ranges = max(1, -(-rows.count() // (page * pages_per_range)))
    order = [F.col("k").asc_nulls_first(), F.col("tie")]
    spread = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the place in the partition
    path = scratch(spark, "pages")
    spread.select("row", F.spark_partition_id().alias("range"), inside.alias("place")).write.parquet(path)  # ranges are chosen anew with each run
    spread = spark.read.parquet(path)
    counts = spread.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # over one row per range
    first = counts.select("range", F.coalesce(before, F.lit(0)).alias("first"))
    number = F.floor((F.col("first") + F.col("place")) / page).cast("long")
    return spread.join(small(first), "range").select("row.*", number.alias("page"))


def time_slices(df: DataFrame, ts: str, hours: int) -> DataFrame:
    """``df`` with slice, the number of its contiguous window of ``hours`` since the epoch; null without a time. A column of that name is replaced."""
    return df.withColumn("slice", F.floor(F.unix_timestamp(ts) / (hours * 3600)).cast("long"))


def days_between(df: DataFrame, ts: str) -> DataFrame:
    """Every calendar day from the first to the last row; none of an empty table, and null times do not count."""
    ends = df.agg(F.min(ts).cast("date").alias("a"), F.max(ts).cast("date").alias("b"))
    return ends.where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("day"))


def parse_lines(df: DataFrame, line: str) -> DataFrame:
    """day and kind of tab-separated lines: the first field's date, and what follows the second's last dash."""
    parts = F.split(line, "\t")
    return df.select(F.substring(parts[0], 1, 10).cast("date").alias("day"), F.substring_index(parts[1], "-", -1).alias("kind"))


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as columns named by their path."""

    def leaves(schema: T.StructType, prefix: tuple[str, ...]):
        for f in schema:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, (*prefix, f.name))
            else:
                yield F.col(".".join(f"`{p}`" for p in (*prefix, f.name))).alias("_".join((*prefix, f.name)))

    return df.select(*leaves(df.schema, ()))


def retain(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows no more than ``days`` calendar days older than the newest; the boundary day stays. Rows without a time go, an empty table stays empty."""
    name = unused("_newest", df)
    newest = df.agg(F.max(ts).cast("date").alias(name))
    return df.join(F.broadcast(newest), F.col(ts).cast("date") >= F.date_sub(name, days)).drop(name)


def written_with_counts(df: DataFrame, path: str, before: Mapping[str, Column], keep: Column, after: Mapping[str, Column]) -> dict[str, object]:
    """Write the rows that ``keep`` holds for, and return measures of all rows and of the written ones, taken in that one pass.

    Measures are aggregates by name. A null ``keep`` drops the row. An empty table writes no rows and gives the measures of none. ``df`` should
    be a scan without a shuffle: rows of a stage that is run again after a loss would be measured again.
    """
    given, written = Observation(), Observation()
    seen = df.observe(given, *[c.alias(f"before_{n}") for n, c in before.items()])
    kept = seen.where(F.coalesce(keep, F.lit(False))).observe(written, *[c.alias(f"after_{n}") for n, c in after.items()])
    kept.write.parquet(path)
    return {n: given.get[f"before_{n}"] for n in before} | {n: written.get[f"after_{n}"] for n in after}
