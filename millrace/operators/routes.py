"""Routing of rows to shards and named targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import md5_bucket
from millrace.operators.joins import small


def shard(df: DataFrame, key: str, shards: int, prefix: str) -> DataFrame:
    """``df`` with shard, stable over engines and runs, and target, the shard's name; both null for a null key. Columns of these names are replaced."""
    out = df.withColumn("shard", md5_bucket(F.col(key), shards))
    return out.withColumn("target", F.concat(F.lit(prefix), F.lpad(F.col("shard").cast("string"), len(str(shards - 1)), "0")))


def map_with_fallback(df: DataFrame, name: str, targets: DataFrame, aliases: DataFrame) -> DataFrame:
    """name, target, matched_by: exact, then by alias, then both again for the name up to its first separator.

    ``targets`` (name, target) and ``aliases`` (alias, canonical) have a row per name; they are broadcast if their bytes allow it. Null and
    unknown names keep null targets, repeated names are rows of their own, and other columns are ignored. Empty mappings match nothing.
    """
    known = aliases.join(targets, F.col("canonical") == F.col("name")).select("alias", F.col("target").alias("by_alias"))
    trimmed = F.regexp_replace(name, r"[-—|/].*$", "")
    out = df.withColumn("_short", trimmed)
    for key, suffix in ((name, "1"), ("_short", "2")):
        t = targets.select(F.col("name").alias(f"_n{suffix}"), F.col("target").alias(f"_t{suffix}"))
        a = known.select(F.col("alias").alias(f"_a{suffix}"), F.col("by_alias").alias(f"_b{suffix}"))
        out = out.join(small(t), F.col(key) == F.col(f"_n{suffix}"), "left").join(small(a), F.col(key) == F.col(f"_a{suffix}"), "left")
    steps = (("_t1", "exact"), ("_b1", "alias"), ("_t2", "trimmed"), ("_b2", "trimmed alias"))
    matched = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(label)) for c, label in steps])
    return out.select(name, F.coalesce(*[c for c, _ in steps]).alias("target"), matched.alias("matched_by"))


def ambiguous(df: DataFrame, name: str, target: str) -> DataFrame:
    """Names that a mapping sends to more than one target, and to how many; null targets do not count, a null name is a name."""
    return df.groupBy(F.col(name).alias("name")).agg(F.countDistinct(target).alias("n")).where("n > 1")
