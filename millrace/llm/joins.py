"""Joins whose hot keys do not meet in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a side that may be broadcast once they have been counted, as its columns hold them.
BROADCAST_BYTES = 32 << 20


def attach(big: DataFrame, small: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """``big`` with the columns of ``small``, which has one row per ``key`` of numbers or strings.

    The join is on invertible expressions of the key, so that both sides are exchanged for this join even where
    ``small`` comes from an aggregate; adaptive execution can then split a hot key's rows over many tasks. The key
    itself is not moved but made again, and stands last.
    """
    keys, kinds = [key] if isinstance(key, str) else key, dict(big.dtypes)
    names = {k: f"_join{i}" for i, k in enumerate(keys)}

    def swapped(k: str, c: str) -> Column:
        return F.col(c).bitwiseXOR(F.lit(0x5DEECE66D if kinds[k] == "bigint" else 0x2545F491).cast(kinds[k]))

    whole = {k for k in keys if kinds[k] in ("bigint", "int")}
    there = {n: swapped(k, k) if k in whole else F.concat(F.lit("k"), k) for k, n in names.items()}
    back = {k: swapped(k, n) if k in whole else F.substr(n, F.lit(2)) for k, n in names.items()}
    left, right = (df.withColumns(there).drop(*keys) for df in (big, small))
    return left.join(right, list(names.values()), how).withColumns(back).drop(*names.values())


def _held(df: DataFrame) -> Column:
    """Bytes of a row: 8 of each column, and what its strings and lists hold."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        elif kind.startswith("array"):
            size = size + 8 * F.coalesce(F.size(F.col(f"`{name}`")), F.lit(0))
    return size


def with_few(big: DataFrame, few: DataFrame, key: str | list[str], how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """A join with a narrow side that is usually far smaller: counted, and broadcast only if it has at most ``limit`` bytes."""
    if (few.agg(F.sum(_held(few))).first()[0] or 0) <= limit:
        return big.join(F.broadcast(few), key, how)
    return big.join(few.hint("merge"), key, how)
