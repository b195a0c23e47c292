"""Operator 10: proportional stratified interleaving into shards.

Rows are shuffled by a seeded hash and ranked within their source; the rank as a fraction of the
source's rows puts all sources on one scale, on which the rows are sorted and cut into shards of equal
row counts. Every shard thus has the mixture of the whole table, to within one row of each source.

Both rankings are distributed: a bucket of the sorted value bounds every window partition, and a small
table of bucket counts gives each bucket its first rank. No source, however large, meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAW = "rows"


def _ranked(df: DataFrame, group: list[str], bucket: str, order: list[str | Column], out: str) -> DataFrame:
    """0-based rank in the order (bucket, *order) within ``group``; a window never holds more than one bucket."""
    counts = df.groupBy(*group, bucket).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    keys = [*group, bucket]
    renamed = first.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
    inside = df.withColumn("_inside", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = inside.join(renamed, match)
    return joined.withColumn(out, F.col("_first") + F.col("_inside") - 1).drop("_first", "_inside", *[f"_k{i}" for i in range(len(keys))])


def interleave(
    df: DataFrame,
    shards: int,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 42,
    rows_per_bucket: int = 20_000,
) -> DataFrame:
    """Assign every row to a shard; return key, source, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 bytes of the text plus 16 and text_crc32 its checksum; a null text counts as empty.
    A null source is a stratum of its own and a null key is an ordinary value. Repeated rows are kept, each
    with a slot of its own; between equal rows it does not matter which one takes which slot. An empty
    table gives an empty result, and other columns are ignored. With fewer rows than shards some shards
    stay empty. ``rows_per_bucket`` only bounds the windows; it does not change the result.
    """
    rows = df.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # 60 bits of a digest that SQL engines share
    seeded = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32")
    rows = rows.withColumn("_h", F.conv(F.substring(F.md5(seeded.cast("binary")), 1, 15), 16, 10).cast("long"))
    by_source = df.groupBy(F.col(f"`{source}`").alias("_s")).agg(F.count("*").alias("_rows"))
    total = df.count()
    buckets = max(1, -(-total // rows_per_bucket))
    # ranges of the hash, so that the number of buckets does not change the order
    rows = rows.withColumn("_b", F.floor(F.shiftright("_h", 28) * F.lit(buckets) / F.lit(2**32)).cast("long"))
    rows = _ranked(rows, ["source"], "_b", ["_h", "doc_id", "text_crc32", "size"], "_rank")
    rows = rows.join(by_source, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # (rank + 1/2) / rows as an integer on a scale of 2^40, so that equal fractions are equal on every machine
    rows = rows.withColumn("_f", F.floor((2 * F.col("_rank") + 1).cast("decimal(38,0)") * F.lit(2**39) / F.col("_rows")).cast("long"))
    rows = rows.withColumn("_g", F.floor(F.col("_f") * F.lit(buckets) / F.lit(2**40)).cast("long"))
    rows = _ranked(rows, [], "_g", ["_f", "_h", F.col("source").asc_nulls_first(), "doc_id", "text_crc32", "size"], "_pos")
    shard = F.floor((F.col("_pos") * shards).cast("decimal(38,0)") / F.lit(max(total, 1))).cast("int")
    start = F.ceil((F.col("shard").cast("decimal(38,0)") * F.lit(total)) / F.lit(shards)).cast("long")
    rows = rows.withColumn("shard", shard)
    return rows.select(
        "doc_id", "source", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("_pos") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
