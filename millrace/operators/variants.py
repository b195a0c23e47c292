"""Values without a schema: JSON of any shape becomes one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct paths that may become columns; a table of more is a matter for leaves().
MOST_COLUMNS = 2000


def _opened(df: DataFrame, key: str, raw: str, depth: int) -> DataFrame:
    """key, steps, kind, value: each scalar with the names that lead to it."""
    at = df.select(F.col(f"`{key}`").alias("key"), F.array().cast("array<string>").alias("steps"), F.try_parse_json(F.col(f"`{raw}`")).alias("v"))
    at = at.where("v IS NOT NULL")
    is_object = F.schema_of_variant("v").startswith("OBJECT")
    for _ in range(depth):
        # A row is opened into its members, or stays as the only member of a list of itself.
        members = F.map_entries(F.try_variant_get("v", "$", "map<string, variant>"))
        opened = F.transform(members, lambda m: F.struct(F.concat("steps", F.array(m["key"])).alias("steps"), m["value"].alias("v")))
        itself = F.array(F.struct(F.col("steps"), F.col("v")))
        at = at.select("key", F.explode(F.when(is_object, opened).otherwise(itself)).alias("m")).select("key", "m.steps", "m.v")
    kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    out = at.select("key", "steps", kind.alias("kind"), F.try_variant_get("v", "$", "string").alias("value"))
    return out.where("kind <> 'VOID' AND value IS NOT NULL AND value <> '{}'")


def leaves(df: DataFrame, key: str, raw: str, depth: int = 4) -> DataFrame:
    """key, path, kind, value: the scalars of each row's JSON, objects opened up to ``depth`` deep. Names are joined with dots, their own dots escaped.

    Lists, and objects deeper than that, are values of their own, as JSON text. kind is the value's type in Spark's words; JSON nulls, empty
    objects, and texts that are null, empty or no JSON have no row. A scalar that is the whole text has an empty path. Repeated rows, and
    rows of one key, come each. Every object is opened where its row lies; nothing is shuffled.
    """
    path = F.array_join(F.transform("steps", lambda n: F.replace(n, F.lit("."), F.lit("\\."))), ".")
    return _opened(df, key, raw, depth).select(F.col("key").alias(key), path.alias("path"), "kind", "value")


def one_table(df: DataFrame, key: str, raw: str, depth: int = 4, most_columns: int = MOST_COLUMNS) -> DataFrame:
    """key and a column for every path that occurs in any row, in the order of paths, in one scan for the paths and one for the rows.

    A path whose values are all whole numbers is a long, all numbers a double, all booleans a boolean, else a string. A row without
    a path has null there. A path called like the key has an underscore added. More than ``most_columns`` paths are an error that names their number.
    """
    kinds = _opened(df, key, raw, depth).groupBy("steps").agg(F.collect_set("kind").alias("kinds"))
    found = kinds.orderBy("steps").limit(most_columns + 1).collect()  # bounded by the columns a table may have
    if len(found) > most_columns:
        raise ValueError(f"{kinds.count()} paths are more than {most_columns} columns")
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.try_parse_json(F.col(f"`{raw}`")).alias("_v"))
    return rows.select(F.col("_key").alias(key), *[_column(r["steps"], set(r["kinds"]), key, depth) for r in found])


def _column(steps: list[str], kinds: set[str], key: str, depth: int):
    at = F.col("_v")
    for name in steps:
        at = F.try_variant_get(at, "$", "map<string, variant>")[name] if "'" in name else F.try_variant_get(at, f"$['{name}']", "variant")
    value = F.try_variant_get(at, "$", _type(kinds))
    if len(steps) < depth:  # an object here is opened, and its members have columns of their own
        value = F.when(~F.schema_of_variant(at).startswith("OBJECT"), value)
    path = ".".join(n.replace(".", "\\.") for n in steps)
    return value.alias(path + ("_" if path.lower() == key.lower() else ""))


def _type(kinds: set[str]) -> str:
    if kinds <= {"BIGINT"}:
        return "bigint"
    if kinds <= {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}:
        return "double"
    return "boolean" if kinds == {"BOOLEAN"} else "string"
