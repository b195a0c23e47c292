"""Joins that fill, match with a fallback, and resolve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import unused


def fill_empty(df: DataFrame, profile: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with its empty ``columns`` taken from ``profile``, which has one row per key. What is not empty stays.

    Null and blank values are empty, and become null where the profile has none. Null keys match no profile. Repeated rows of
    ``df`` are filled alike, its other columns stay whatever they are called, and those of ``profile`` are ignored.
    """
    there = unused("_profile", df)
    other = profile.select(key, F.struct(*columns).alias(there))
    out = df.join(other, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.nullif(F.trim(c), F.lit("")), F.col(there)[c]))
    return out.drop(there)


def match_in_two_steps(wanted: DataFrame, items: DataFrame, key: str, line: str, value: str) -> DataFrame:
    """key, line, value, matched_by: by both keys, and for what that leaves by ``key`` alone; the smallest item wins.

    Null keys match nothing. Repeated pairs that match by both are one row; empty tables give none.
    """
    exact = wanted.join(items, [key, line]).groupBy(key, line).agg(F.min(value).alias(value)).withColumn("matched_by", F.lit("exact"))
    rest = wanted.join(exact, [key, line], "left_anti")
    first = items.groupBy(key).agg(F.min_by(value, F.struct(line, value)).alias(value))
    return exact.unionByName(rest.join(first, key).withColumn("matched_by", F.lit("key")))
