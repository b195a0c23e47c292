"""Joins of values with intervals, by bins that follow the intervals' lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import is_small

#: Rows of a bin that meet its intervals in one task; a bin with more is dealt over several.
BIN_ROWS = 200_000


def in_intervals(df: DataFrame, category: str, value: str, bands: DataFrame, *, bin_rows: int = BIN_ROWS, broadcast: bool | None = None) -> DataFrame:
    """``df`` with label, a row for every interval of its category that holds its value: low <= value < high.

    ``bands`` (category, low, high, label) may overlap and be any number; a null bound is open. Every interval goes to the bins of the
    least power of two that is as long as it is, of which it touches two at most. A value has one bin for each length that occurs. So
    rows meet on an equality, and what meets has a length like the bin's: no value is held against all intervals of a category.

    Values and categories that are null or not a number, and intervals that are empty, match nothing. Repeated rows and repeated
    intervals count each. Columns of ``df`` may have any names; one called label is replaced. Intervals are broadcast if their
    bytes, as counted, are few (or as ``broadcast`` says); else both sides are shuffled by bin, and bins with over ``bin_rows``
    values are dealt over several tasks with a copy of their intervals in each.
    """
    number = F.col(f"`{value}`").cast("double")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{category}`").alias("_category"), number.alias("_value"))
    rows = rows.where(F.col("_category").isNotNull() & F.col("_value").isNotNull() & ~F.isnan("_value"))
    least, most = rows.agg(F.min("_value"), F.max("_value")).first()
    if least is None:
        least = most = 0.0
    # An open bound is moved just beyond the values; what lies there cannot be told from no bound.
    low, high = F.greatest(F.coalesce(F.col("low").cast("double"), F.lit(least)), F.lit(least)), F.col("high").cast("double")
    beyond = most + max(1.0, abs(most)) / 2**20
    high = F.least(F.coalesce(high, F.lit(beyond)), F.lit(beyond))
    spans = bands.select(F.col("category").alias("_category"), low.alias("_low"), high.alias("_high"), F.col("label").alias("_label")).where("_low < _high AND _category IS NOT NULL")
    spans = spans.withColumn("_level", F.greatest(F.ceil(F.log2(F.col("_high") - F.col("_low"))), F.lit(-60)).cast("int"))
    bin_of = lambda x: F.floor(x / F.pow(F.lit(2.0), F.col("_level")))
    spans = spans.select("*", F.explode(F.sequence(bin_of(F.col("_low")), bin_of(F.col("_high")))).alias("_bin"))
    levels = sorted(r[0] for r in spans.select("_level").distinct().collect())  # whole numbers, as many as lengths differ by powers of two
    placed = rows.select("*", F.explode(F.array(*[F.lit(x) for x in levels]) if levels else F.array().cast("array<int>")).alias("_level"))
    placed = placed.withColumn("_bin", bin_of(F.col("_value")))
    place = ["_category", "_level", "_bin"]
    if is_small(spans) if broadcast is None else broadcast:
        met = placed.join(F.broadcast(spans), place)
    else:
        hot = placed.groupBy(*place).agg(F.count("*").alias("_n")).where(F.col("_n") > bin_rows)
        hot = hot.select(*place, F.ceil(F.col("_n") / bin_rows).cast("int").alias("_parts"))  # rows / bin_rows of them at most, for each level
        hot = F.broadcast(hot) if is_small(hot) else hot
        parts = F.coalesce("_parts", F.lit(1))
        numbered = placed.withColumn("_at", F.monotonically_increasing_id())
        dealt = numbered.join(hot, place, "left").withColumn("_part", F.pmod("_at", parts).cast("int")).drop("_parts", "_at")
        copies = spans.join(hot, place, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
        met = dealt.join(copies.hint("merge"), [*place, "_part"])
    met = met.where((F.col("_low") <= F.col("_value")) & (F.col("_value") < F.col("_high")))
    return met.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != "label"], F.col("_label").alias("label"))
