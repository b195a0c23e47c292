"""Joins with sides that are usually small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a side that may be broadcast once they have been counted, as its columns hold them.
BROADCAST_BYTES = 32 << 20


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no column of the frames is called so, in upper or lower case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 of each column, and what its strings hold; lists and structs by their JSON."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "struct", "map")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows hold at most ``limit`` bytes together. An empty table does."""
    return (df.agg(F.sum(held_bytes(df))).first()[0] or 0) <= limit


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` bytes; beyond, it is left to a shuffled join."""
    return F.broadcast(df) if is_small(df, limit) else df.hint("merge")
