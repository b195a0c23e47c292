"""Field changes, histories, upserts and their plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.exprs import or_empty
from millrace.operators.joins import unused


def field_changes(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str], uptime: str | None = None) -> DataFrame:
    """id, field, before, after (and uptime): the fields in which two versions of a row differ; null and '' are equal.

    Rows of a null key, and of a key that one side lacks, have no other version and give nothing. Where a key repeats, each of
    its rows meets each of the other side's. Columns beside the fields may have any names; empty tables give no row.
    """
    given = unused("_new", old)
    right = new.select(key, F.struct(*[or_empty(F.col(f)).alias(f) for f in fields]).alias(given))
    both = old.join(right, key)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), or_empty(F.col(f)).alias("before"), F.col(given)[f].alias("after")) for f in fields])
    more = [F.col(uptime).alias("uptime")] if uptime else []
    rows = both.select(F.col(key).alias("id"), *more, F.explode(F.filter(pairs, lambda p: p["before"] != p["after"])).alias("p"))
    return rows.select("id", "p.field", "p.before", "p.after", *["uptime"] * bool(uptime))


def capped_history(df: DataFrame, key: str, value: str, order: Sequence[str], most: int) -> DataFrame:
    """key, history: the newest ``most`` changes of a value, oldest first. Runs of one value are one change, at their first row.

    A null value is no change, but the same value after it is one again. A null key is a key; between rows that tie in ``order`` any may come
    first. Extra columns are ignored whatever they are called, and an empty table gives none.
    """
    df = df.select(*dict.fromkeys([key, value, *order]))
    w = Window.partitionBy(key).orderBy(*order)
    before = F.lag(value).over(w)
    changed = df.withColumn("_before", before).where(F.col(value).isNotNull() & (F.col("_before").isNull() | (F.col("_before") != F.col(value))))
    newest = changed.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(o) for o in order]))).where(F.col("_r") <= most)
    return newest.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(value).alias("value")))).alias("history"))


def upsert(old: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """``old`` after the updates: an empty or null field leaves what there is, a new key comes in whole.

    Of several updates of a key every field takes its newest value by ``order`` that is not empty, or the largest without
    one, so that a key has one row. Updates of a null key name no row and are left out; rows of ``old`` whose key is null stay as they are.
    Empty tables and extra columns of the updates make no difference.
    """
    fields = [c for c in old.columns if c != key]
    given = lambda f: F.when(F.col(f).cast("string") != "", F.col(f))
    newest = lambda f: F.max_by(F.col(f), F.when(given(f).isNotNull(), F.col(order))) if order else F.max(given(f))
    right = updates.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.lit(True).alias("_there"), *[newest(f).alias(f"_{f}") for f in fields])
    joined = old.join(right, F.col(key) == F.col("_key"), "full")
    return joined.select(F.coalesce(key, "_key").alias(key), *[F.coalesce(f"_{f}", f).alias(f) for f in fields])


def replace(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of both with the newer one where keys are equal."""
    return new.unionByName(old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns))


def plan(old: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The updates with the action each would take, update or insert; nothing is written."""
    known = old.select(key).distinct().withColumn("_known", F.lit(True))
    return updates.join(known, key, "left").withColumn("action", F.when(F.col("_known"), "update").otherwise("insert")).drop("_known")


def valid_entries(entries: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, entries: how many entries (key, value, updated_at) with a value and a time the keys have that have one in [start, end).

    Nothing is gathered: a key's entries are counted where they are. A null key is a key.
    """
    inside = (F.col("updated_at") >= F.lit(start).cast("timestamp")) & (F.col("updated_at") < F.lit(end).cast("timestamp"))
    valid = (F.col("value") != "") & F.col("updated_at").isNotNull()
    return entries.groupBy(key).agg(F.count_if(valid).alias("entries"), F.bool_or(inside & valid).alias("_inside")).where("_inside").drop("_inside")


def with_valid_history(df: DataFrame, history: str, start: str, end: str) -> DataFrame:
    """Rows with an entry in [start, end), their histories without entries that lack a value or a time."""
    valid = F.filter(history, lambda h: (h["value"] != "") & h["updated_at"].isNotNull())
    inside = F.exists(F.col(history), lambda h: (h["updated_at"] >= F.lit(start).cast("timestamp")) & (h["updated_at"] < F.lit(end).cast("timestamp")))
    return df.withColumn(history, valid).where(inside)
