"""Deterministic samples and stratified estimates with confidence intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_Z = 1.96


def _seeded(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")).cast("binary"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows by the order of a seeded digest: the same rows on every run and cluster."""
    return df.withColumn("_s", _seeded(key, seed)).orderBy("_s", key).limit(n).drop("_s")


def partition_sample(df: DataFrame, key: str, partitions: int, seed: int) -> DataFrame:
    """All rows of the keys in one of ``partitions`` digest classes, which the seed chooses. A filter alone."""
    number = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return df.where(number % partitions == seed % partitions)


def quota_sample(df: DataFrame, group: str, key: str, quota: int, seed: int) -> DataFrame:
    """Up to ``quota`` rows of each group, in the order of a seeded digest."""
    w = Window.partitionBy(group).orderBy("_s", key)
    return df.withColumn("_s", _seeded(key, seed)).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= quota).drop("_s", "_r")


def wilson(df: DataFrame, hits: str, n: str) -> DataFrame:
    """``df`` with p, low and high, the 95 % Wilson interval of hits / n; 0 and 0 without rows."""
    total = F.col(n).cast("double")
    p = F.when(total > 0, F.col(hits) / total).otherwise(F.lit(0.0))
    out = df.withColumn("p", p)
    centre, spread = F.col("p") + _Z**2 / (2 * total), _Z * F.sqrt(F.col("p") * (1 - F.col("p")) / total + _Z**2 / (4 * total * total))
    scale = 1 + _Z**2 / total
    low = F.when(total > 0, F.greatest(F.lit(0.0), (centre - spread) / scale)).otherwise(F.lit(0.0))
    high = F.when(total > 0, F.least(F.lit(1.0), (centre + spread) / scale)).otherwise(F.lit(0.0))
    return out.withColumn("low", F.round(low, 6)).withColumn("high", F.round(high, 6))


def stratified(df: DataFrame, stratum: str, candidates: str, hits: str, n: str) -> DataFrame:
    """stratum, candidates, estimate, low, high: rates of the judged rows carried over to all of a stratum's."""
    rows = wilson(df, hits, n)
    carried = lambda c: F.round(F.col(candidates) * F.col(c)).cast("long")
    return rows.select(stratum, F.col(candidates).alias("candidates"), carried("p").alias("estimate"), carried("low").alias("low"), carried("high").alias("high"))


def with_rest(estimates: DataFrame, stratum: str) -> DataFrame:
    """stratum, n, with what the strata's estimates leave of all candidates as "other", at least 0."""
    rest = estimates.agg(F.greatest(F.lit(0).cast("long"), F.sum("candidates") - F.sum("estimate")).alias("n"))
    return estimates.select(F.col(stratum).alias("stratum"), F.col("estimate").alias("n")).unionByName(rest.select(F.lit("other").alias("stratum"), "n"))


def rates(df: DataFrame, stratum: str, hit: Column) -> DataFrame:
    return df.groupBy(stratum).agg((F.count_if(hit) / F.count("*")).alias("rate"))


def daily(df: DataFrame, ts: str, stratum: str, rate: DataFrame) -> DataFrame:
    """day, n, estimate: each stratum's rows of a day times its rate."""
    by = df.groupBy(F.to_date(ts).alias("day"), stratum).agg(F.count("*").alias("n")).join(rate, stratum, "left")
    return by.groupBy("day").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.coalesce("rate", F.lit(0.0))), 4).alias("estimate"))


def allocated(df: DataFrame, ts: str, stratum: str, rate: DataFrame) -> DataFrame:
    """day, allocated: the estimate over all rows, shared out by the days' numbers of rows."""
    total = df.groupBy(stratum).agg(F.count("*").alias("n")).join(rate, stratum).agg(F.sum(F.col("n") * F.col("rate")).alias("total"), F.sum("n").alias("rows"))
    days = df.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("n")).join(F.broadcast(total))
    return days.select("day", F.round(F.col("total") * F.col("n") / F.col("rows"), 4).alias("allocated"))
