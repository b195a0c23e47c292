"""Latest values in nested histories, mixed feeds and day sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_in_history(df: DataFrame, key: str, history: str, start: str, end: str) -> DataFrame:
    """key, value, updated_at: the last entry with a value in [start, end) of a nested history (updated_at, id, value)."""
    inside = F.filter(history, lambda h: (h["updated_at"] >= F.lit(start).cast("timestamp")) & (h["updated_at"] < F.lit(end).cast("timestamp")) & (h["value"] != ""))
    last = F.array_max(inside)
    return df.select(key, last.alias("last")).where("last IS NOT NULL").select(key, "last.value", "last.updated_at")


def mixed_feed(ranked: DataFrame, by: Sequence[Column | str], followed: DataFrame, then: Sequence[Column | str], size: int, share: float) -> DataFrame:
    """A feed of ``size`` rows: ``share`` of it the best of one pool, the rest the best of another."""
    n = round(size * share)
    first = ranked.orderBy(*by).limit(n).withColumn("pool", F.lit("ranked"))
    return first.unionByName(followed.orderBy(*then).limit(size - n).withColumn("pool", F.lit("followed")))


def days_left(planned: DataFrame, done: DataFrame, ts: str) -> DataFrame:
    """Days of the planned rows on which nothing is done."""
    day = F.to_date(ts).alias("day")
    return planned.select(day).distinct().join(done.select(day), "day", "left_anti")


def latest_change(entries: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, value, updated_at of the newest entry (key, value, updated_at, id) in [start, end) that has a value; ties by id.

    Entries are filtered and reduced where they are; nothing is gathered. Keys without such an entry, and an empty table, give no row.
    """
    inside = (F.col("updated_at") >= F.lit(start).cast("timestamp")) & (F.col("updated_at") < F.lit(end).cast("timestamp")) & (F.col("value") != "")
    return entries.where(inside).groupBy(key).agg(F.max_by("value", F.struct("updated_at", "id")).alias("value"), F.max("updated_at").alias("updated_at"))
