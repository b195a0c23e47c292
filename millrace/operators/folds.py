"""Folds over each key's rows in order of time.

Every decision needs the one before, so a key's rows pass through one task in order; the task holds one batch of rows and
the state of one key, however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _in_order(df: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, ts, tie)


def _split(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all of the columns, and the others."""
    there = F.lit(True)
    for c in columns:
        there = there & F.col(c).isNotNull()
    return df.where(there), df.where(~there)


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype(np.int64)


def _new_keys(rows: pd.DataFrame, keys: Sequence[str], before: tuple | None) -> tuple[np.ndarray, tuple]:
    """Where the key is not that of the row before, and the last row's key."""
    new = np.zeros(len(rows), dtype=bool)
    for c in keys:
        values = rows[c].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    first = tuple(rows[c].iloc[0] for c in keys)
    new[0] = first != before
    return new, tuple(rows[c].iloc[-1] for c in keys)


def expiring_first(df: DataFrame, keys: Sequence[str], ts: str, tie: str, seconds: int) -> DataFrame:
    """The rows of ``df`` whose key is not held: a row that passes holds its key for ``seconds``, and then it is free again.

    Rows are taken in order of time and ``tie``. A row exactly ``seconds`` after the last that passed passes too. Rows
    with a null key or time hold nothing and always pass; repeated rows are rows like others (all but the first are held
    back). Extra columns stay; an empty table stays empty.
    """
    known, rest = _split(df, [*keys, ts])
    lifetime = seconds * 1_000_000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, last = None, 0
        for rows in batches:
            if rows.empty:
                continue
            at = _micros(rows[ts])
            new, key = _new_keys(rows, keys, key)
            passed = np.zeros(len(rows), dtype=bool)
            for i, (begins, t) in enumerate(zip(new.tolist(), at.tolist())):
                if begins or t - last >= lifetime:
                    passed[i], last = True, t
            yield rows[passed]

    return _in_order(known, keys, ts, tie).mapInPandas(run, known.schema).unionByName(rest)


def flushes(df: DataFrame, keys: Sequence[str], ts: str, tie: str, size: int, seconds: int) -> DataFrame:
    """keys, batch, first, n, reason: the batches of a buffer per key that is flushed when full or too old.

    Rows come in order of time and ``tie``. A buffer is flushed when it holds ``size`` rows ("size"), when a row comes ``seconds``
    or more after its first one ("time"; that row begins the next), or when no row is left ("end"). batch counts from 0 and first is
    the ``tie`` of its first row. Rows with a null key or time belong to no buffer and are left out; an empty table has no batch.
    Extra columns are ignored.
    """
    known, _ = _split(df.select(*keys, ts, tie), [*keys, ts])
    timeout = seconds * 1_000_000
    kinds = dict(known.dtypes)
    names = [*keys, "batch", "first", "n", "reason"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, number, first, began, n = None, 0, None, 0, 0
        for rows in batches:
            if rows.empty:
                continue
            out, held = [], key
            new, key = _new_keys(rows, keys, key)
            for i, (begins, t, mark) in enumerate(zip(new.tolist(), _micros(rows[ts]).tolist(), rows[tie].tolist())):
                if begins:
                    if n:
                        out.append((*held, number, first, n, "end"))
                    held, number, n = tuple(rows[c].iloc[i] for c in keys), 0, 0
                elif n and t - began >= timeout:
                    out.append((*held, number, first, n, "time"))
                    number, n = number + 1, 0
                if not n:
                    first, began = mark, t
                n += 1
                if n == size:
                    out.append((*held, number, first, n, "size"))
                    number, n = number + 1, 0
            yield pd.DataFrame(out, columns=names)
        if n:
            yield pd.DataFrame([(*key, number, first, n, "end")], columns=names)

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), "batch long", f"first {kinds[tie]}", "n long", "reason string"])
    return _in_order(known, keys, ts, tie).mapInPandas(run, schema)


def buffers(df: DataFrame, keys: Sequence[str], ts: str, tie: str, item: str, size: int, seconds: int) -> DataFrame:
    """keys, began, first, n, dropped, reason: the flushes of a buffer per key that holds no item twice.

    Rows come in order of time and ``tie``. A row whose item the buffer holds is dropped and counted; any other is put in. A buffer is flushed when it holds ``size``
    rows ("size"), or ``seconds`` after its first one whether or not a row comes ("time"). began and first are the time and the
    ``tie`` of its first row. Rows with a null key or time belong to no buffer and are left out, a null item is an item; an empty
    table has no flush. Extra columns are ignored.
    """
    known, _ = _split(df.select(*dict.fromkeys([*keys, ts, tie, item])), [*keys, ts])
    timeout, kinds = seconds * 1_000_000, dict(known.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, first, start, began, dropped, seen = None, None, None, 0, 0, set()
        for rows in batches:
            if rows.empty:
                continue
            out, held = [], key
            new, key = _new_keys(rows, keys, key)
            items = rows[item].astype(object).where(rows[item].notna(), None)
            for i, (begins, t, mark, what) in enumerate(zip(new.tolist(), _micros(rows[ts]).tolist(), rows[tie].tolist(), items.tolist())):
                if seen and (begins or t - began >= timeout):
                    out.append((*held, start, first, len(seen), dropped, "time"))
                    seen = set()
                if begins:
                    held = tuple(rows[c].iloc[i] for c in keys)
                if what in seen:
                    dropped += 1
                    continue
                if not seen:
                    first, start, began, dropped = mark, rows[ts].iloc[i], t, 0
                seen.add(what)
                if len(seen) == size:
                    out.append((*held, start, first, size, dropped, "size"))
                    seen = set()
            yield pd.DataFrame(out, columns=names)
        if seen:
            yield pd.DataFrame([(*key, start, first, len(seen), dropped, "time")], columns=names)

    names = [*keys, "began", "first", "n", "dropped", "reason"]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), f"began {kinds[ts]}, first {kinds[tie]}, n long, dropped long, reason string"])
    return _in_order(known, keys, ts, tie).mapInPandas(run, schema)
