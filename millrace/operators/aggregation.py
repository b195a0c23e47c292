"""Grouped measures, rankings, gaps, consistency checks and tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.exprs import count_of
from millrace.operators.joins import small, unused
from millrace.operators.scanning import days_between


def most_common(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; ties by value, null a value like others. An empty table gives none."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each key, with their rank from 1. Spark cuts groups before the exchange (window group limit).

    A null key is a key; between rows that tie in ``order`` any may come first. A column called rank is replaced, others stay.
    """
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def _since_last(df: DataFrame, ts: str, hours: int, strict: bool) -> DataFrame:
    name = unused("_newest", df)
    newest = df.agg(F.max(ts).alias(name))
    bound = F.col(name) - F.make_dt_interval(hours=F.lit(hours))
    return df.join(F.broadcast(newest), F.col(ts) > bound if strict else F.col(ts) >= bound).drop(name)


def hot(df: DataFrame, key: str, hours: int, weights: Mapping[str, int], value_weight: float) -> DataFrame:
    """key, score over the last ``hours`` before the newest row: weighted counts by kind plus the weighted sum of values.

    Rows without a time are in no window; null values and kinds without a weight add nothing, and a key whose values are all null
    has a null score. A null key is a key, repeated rows count each, and an empty table gives none.
    """
    score = value_weight * F.sum("value")
    for kind, weight in weights.items():
        score = score + weight * F.count_if(F.col("event_type") == kind)
    return _since_last(df, "ts", hours, False).groupBy(key).agg(F.round(score, 4).alias("score"))


def trending(df: DataFrame, key: str, ts: str, value: str, hours: int, n: int) -> DataFrame:
    """key, n, total of the last ``hours``; the ``n`` of the largest total; ties by key.

    Rows with a null or empty key, or without a time, are left out. A total of null values alone is null and comes last. Repeated
    rows count each, extra columns are ignored, and an empty table gives none.
    """
    recent = _since_last(df, ts, hours, True).where(F.col(key) != "")
    out = recent.groupBy(key).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"))
    return out.orderBy(F.desc("total"), key).limit(n)


def cross_event(df: DataFrame, key: str, kind: str, high: Column) -> DataFrame:
    """key, n, mode, high, kinds for keys with more than one row. Rows are reduced by kind before a key's kinds meet."""
    by = df.groupBy(key, kind).agg(F.count("*").alias("n"), F.bool_or(high).alias("high"))
    out = by.groupBy(key).agg(
        F.sum("n").alias("n"), F.min_by(kind, F.struct(-F.col("n"), kind)).alias("mode"), F.bool_or("high").alias("high"),
        F.array_join(F.sort_array(F.collect_list(kind)), ",").alias("kinds"),
    )
    return out.where("n > 1")


def gap_days(df: DataFrame, ts: str, there: DataFrame) -> DataFrame:
    """Days between the first and last row of ``df`` that ``there`` (day) lacks."""
    return days_between(df, ts).join(there.distinct(), "day", "left_anti")


def nested_rollup(df: DataFrame, key: str, child: str, item: str, measure: str) -> DataFrame:
    """key, parts, quantity, children: distinct items by child as a map, and their sums."""
    by = df.groupBy(key, child).agg(F.countDistinct(item).alias("parts"), F.round(F.sum(measure), 2).alias("quantity"))
    children = F.map_from_entries(F.collect_list(F.struct(child, "parts")))
    return by.groupBy(key).agg(F.sum("parts").alias("parts"), F.round(F.sum("quantity"), 2).alias("quantity"), children.alias("children"))


def consistency(events: DataFrame, labels: DataFrame, documents: DataFrame) -> DataFrame:
    """problem, n: keys that repeat or change kind within a day, labels without a text, days whose sums differ."""
    by = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.countDistinct("event_type").alias("kinds"), F.count("*").alias("n"))
    keys = by.agg(count_of(F.col("n") > 1).alias("repeated keys"), count_of(F.col("kinds") > 1).alias("several kinds"))
    texts = documents.select("doc_id", "text")
    bare = labels.where("quality IS NOT NULL").join(texts, "doc_id", "left").agg(count_of(F.coalesce(F.trim("text"), F.lit("")) == "").alias("labelled without text"))
    totals = events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("c"))
    sums = by.groupBy("day").agg(F.sum("n").alias("s")).join(totals, "day").agg(count_of(F.col("s") != F.col("c")).alias("sums differ"))
    row = keys.join(bare).join(sums)
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("problem"), F.col(f"`{c}`").alias("n")) for c in row.columns])).alias("x")).select("x.problem", "x.n")


def tiers(df: DataFrame, category: str, value: str, thresholds: DataFrame, default: tuple[float, float, float]) -> DataFrame:
    """``df`` with tier S, A, B or C by its category's least values; categories without thresholds, and null ones, take the default ones.

    A null value is of tier C. Columns of ``df`` may have any names; one called tier is replaced. ``thresholds`` (category, s, a, b) has a row
    per category.
    """
    t = thresholds.select(F.col("category").alias("_category"), F.struct("s", "a", "b").alias("_least"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    joined = rows.join(small(t), F.col("_row")[category] == F.col("_category"), "left")
    least = [F.coalesce(F.col("_least")[c], F.lit(x)) for c, x in zip(("s", "a", "b"), default)]
    v = F.col("_row")[value]
    tier = F.when(v >= least[0], "S").when(v >= least[1], "A").when(v >= least[2], "B").otherwise("C")
    return joined.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != "tier"], tier.alias("tier"))


def joined_in_order(df: DataFrame, key: str, order: str, value: str, width: int = 4096) -> DataFrame:
    """key, joined: a key's values in ``order``, a whole number, with commas between; nulls are left out.

    Values are first joined in runs of ``width`` of the order, so that no task sorts all rows of a key; only the runs' texts meet.
    """
    run = F.floor(F.col(order) / width)
    listed = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"])
    runs = df.groupBy(key, run.alias("run")).agg(F.array_join(F.array_compact(listed), ",").alias("t")).where("t <> ''")
    whole = F.transform(F.sort_array(F.collect_list(F.struct("run", "t"))), lambda x: x["t"])
    return runs.groupBy(key).agg(F.array_join(whole, ",").alias("joined"))
