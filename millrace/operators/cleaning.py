"""Normalisers of loosely typed values and tags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined(values: Column) -> Column:
    """An array's values with blanks between; a scalar comes as an array of one."""
    return F.array_join(values, " ")


def compact(fields: Mapping[str, Column]) -> Column:
    """JSON of the fields that hold something."""
    return F.to_json(F.struct(*[F.when(F.trim(c.cast("string")) != "", c).alias(name) for name, c in fields.items()]), {"ignoreNullFields": "true"})


def clean_keys(df: DataFrame, key: str, json: str) -> DataFrame:
    """key, key, value: each row's JSON object with trimmed keys; of equal keys the last with a value wins, else the last.

    Rows are cleaned one by one, without an exchange, and rows of equal ids stay apart. A text that is null or no object gives no row.
    """
    entries = F.transform(
        F.map_entries(F.from_json(json, "map<string,string>")),
        lambda e, i: F.struct(F.trim(e["key"]).alias("key"), e["value"].alias("value"), F.struct((F.coalesce(F.trim(e["value"]), F.lit("")) != "").alias("filled"), i.alias("pos")).alias("rank")),
    )
    rows = df.select(F.col(key).alias("_id"), entries.alias("_e"))
    best = F.filter("_e", lambda e: ~F.exists("_e", lambda o: (o["key"] == e["key"]) & (o["rank"] > e["rank"])))
    return rows.select(F.col("_id").alias(key), F.explode(best).alias("_b")).select(key, F.col("_b.key").alias("key"), F.col("_b.value").alias("value"))


def standard_tags(raw: Column, mapping: Mapping[str, str], default: str = "other") -> Column:
    """Tags of a comma list mapped to standard ones, distinct and sorted."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.sort_array(F.array_distinct(F.transform(F.split(raw, ","), lambda t: F.coalesce(F.element_at(table, F.trim(t)), F.lit(default)))))


def merge_tags(df: DataFrame, group: str, raw: str) -> DataFrame:
    """Distinct sorted tags of each group, whatever separates them. Tags are reduced before they are gathered."""
    tags = df.select(group, F.explode(F.split(raw, r"[,\s，、]+")).alias("tag")).where("tag <> ''").distinct()
    return tags.groupBy(group).agg(F.array_join(F.sort_array(F.collect_list("tag")), ",").alias("tags"))


def tags_in_order(df: DataFrame, group: str, tag: str, order: str) -> DataFrame:
    """Distinct tags of each group in order of first appearance, with slashes between."""
    first = df.groupBy(group, tag).agg(F.min(order).alias("first"))
    listed = F.sort_array(F.collect_list(F.struct("first", F.col(tag).alias("tag"))))
    return first.groupBy(group).agg(F.array_join(F.transform(listed, lambda x: x["tag"]), "/").alias("tags"))
