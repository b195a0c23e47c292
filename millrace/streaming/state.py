"""Streams whose decisions need a key's earlier rows: state per key in RocksDB, woken by timers on event time.

Rows may come in any order and any batches. A key's rows wait until the watermark, which is ``delay`` behind the latest time seen, has
passed them, and are then taken in order of time, so that results do not depend on how the stream was cut. Rows that come after the
watermark has passed their time are dropped, as Spark does. What a key waits for is bounded by its rate times ``delay``, and a key
that has nothing more to wait for leaves no state behind. Each call goes on where the last one with the same ``out`` ended.

Every access to the state is a message between Python and the JVM, and so is every timer. Keys are therefore dealt over ``buckets`` by
their hash, and a bucket's rows and states are read, written and woken together: a number of messages for each bucket and batch, not for
each key. A task holds one bucket's waiting rows.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import islice
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from millrace.streaming import jobs as J

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Rows that one value of a bucket's list of waiting rows holds.
_LOT = 5000


class InOrder(StatefulProcessor):
    """Hands each key's rows to ``take`` in order of ``at`` and ``tie`` once the watermark has passed them; state and timers are a bucket's.

    ``columns`` are ``at``, the ``keys`` and the rest. ``held`` is the fold's state, a tuple or None; ``take`` returns it after a row and adds to ``out``. ``wake`` tells
    what becomes of it when nothing has come up to the watermark, and the time (microseconds) at which it should be asked again.
    """

    columns: Sequence[str] = ()
    keys: Sequence[str] = ()
    tie = 0

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.held = handle.getValueState("held", "states binary")

    def _timer(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def _wait(self, rows: Iterator[tuple]) -> int | None:
        """Add rows to those that wait; the time of the first of them."""
        first = None
        while lot := list(islice(rows, _LOT)):
            self.waiting.appendList([(pickle.dumps(lot),)])
            first = min(first or lot[0], min(lot, key=itemgetter(0)), key=itemgetter(0))
        return first and first[0]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        def data() -> Iterator[tuple]:
            places = None
            for r in rows:
                places = places or [r.__fields__.index(c) for c in (*self.columns, "_data")]
                *row, there = map(tuple(r).__getitem__, places)
                if there:
                    yield tuple(row)

        first = self._wait(data())
        if first is not None:
            self._timer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, out, due, rest = timerValues.getCurrentWatermarkInMs() * 1000, [], defaultdict(list), []
        until = 1 + len(self.keys)
        for (lot,) in self.waiting.get():
            for row in pickle.loads(lot):
                (due[row[1:until]] if row[0] <= now else rest).append(row)
        known = self.held.get()
        states = pickle.loads(known[0]) if known else {}
        for k, rows in due.items():
            held = states.get(k)
            for row in sorted(rows, key=lambda r: (r[0], r[self.tie])):
                held = self.take(k, held, row, out)
            states[k] = held
        after, wakes = {}, [min(r[0] for r in rest)] if rest else []
        for k, held in states.items():
            held, wake = self.wake(k, held, now, out)
            if held is not None:
                after[k] = held
            if wake is not None:
                wakes.append(wake)
        if after:
            self.held.update((pickle.dumps(after),))
        elif known:
            self.held.clear()
        if due:
            self.waiting.clear()
            self._wait(iter(rest))
        if wakes:
            self._timer(min(wakes))
        return iter(out)

    def take(self, key, held: tuple | None, row: tuple, out: list[Row]) -> tuple | None:
        raise NotImplementedError

    def wake(self, key, held: tuple | None, now: int, out: list[Row]) -> tuple[tuple | None, int | None]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class Expiring(InOrder):
    """A row that passes holds its key for ``lifetime`` microseconds; the timer lets go of it."""

    def __init__(self, keys: Sequence[str], columns: Sequence[str], tie: str, lifetime: int) -> None:
        self.keys, self.columns, self.tie, self.lifetime = keys, columns, columns.index(tie), lifetime

    def take(self, key, held, row, out):
        if held is not None and row[0] - held[0] < self.lifetime:
            return held
        out.append(Row(**dict(zip(self.columns, row))))
        return (row[0],)

    def wake(self, key, held, now, out):
        if held is None or now >= held[0] + self.lifetime:
            return None, None
        return held, held[0] + self.lifetime


class Buffers(InOrder):
    """A buffer without repeated items that is flushed when full or ``timeout`` microseconds after its first row."""

    def __init__(self, keys: Sequence[str], columns: Sequence[str], tie: str, item: str, size: int, timeout: int) -> None:
        self.keys, self.columns, self.tie = keys, columns, columns.index(tie)
        self.item, self.size, self.timeout = columns.index(item), size, timeout

    def _flush(self, key, held, reason, out):
        began, first, n, dropped, _ = held
        out.append(Row(**dict(zip(self.keys, key)), at=began, first=first, n=n, dropped=dropped, reason=reason))

    def take(self, key, held, row, out):
        if held is not None and row[0] - held[0] >= self.timeout:
            self._flush(key, held, "time", out)
            held = None
        began, first, n, dropped, seen = held or (row[0], str(row[self.tie]), 0, 0, [])
        item = row[self.item]
        if item in seen:
            return began, first, n, dropped + 1, seen
        held = (began, first, n + 1, dropped, [*seen, item])
        if n + 1 < self.size:
            return held
        self._flush(key, held, "size", out)
        return None

    def wake(self, key, held, now, out):
        if held is not None and now >= held[0] + self.timeout:
            self._flush(key, held, "time", out)
            held = None
        return held, None if held is None else held[0] + self.timeout


def _run(spark: SparkSession, path: str, keys: Sequence[str], ts: str, columns: Sequence[str], delay: str, out: str, files: int, closing: str | None, processor: InOrder, result: str, buckets: int) -> DataFrame:
    """Run ``processor`` over the rows of the table at ``path`` that have all of ``keys`` and ``ts``.

    Their time is the long ``at``. With ``closing``, an interval, the input counts as complete: a row that is no data, ``closing`` after the last
    one, moves the watermark over everything that waits.
    """
    end = f"{out}/end"
    stream = J.events(spark, path, files).select(F.col(ts).cast("timestamp").alias(ts), *columns)
    if not J.exists(spark, end):
        spark.createDataFrame([], stream.schema).write.parquet(end)
    marks = spark.readStream.schema(stream.schema).parquet(end)
    rows = stream.withColumn("_data", F.lit(True)).unionByName(marks.withColumn("_data", F.lit(False))).withWatermark(ts, delay)
    there = F.col(ts).isNotNull()
    for k in keys:
        there = there & F.col(k).isNotNull()
    # a mark goes as far as the processor: a filter would be moved in front of the watermark
    rows = rows.where(there | ~F.col("_data")).withColumn("at", F.unix_micros(ts))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    folded = rows.groupBy("_bucket").transformWithState(processor, result, "append", "eventTime")
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        found = J.run(folded, out=out)
        if closing:
            last = spark.read.parquet(path).agg(F.max(ts).cast("timestamp").alias(ts)).where(F.col(ts).isNotNull())
            mark = last.select((F.col(ts) + F.expr(f"INTERVAL {delay}") + F.expr(f"INTERVAL {closing}")).alias(ts), *[F.lit(None).cast(stream.schema[c].dataType).alias(c) for c in columns])
            mark.write.mode("append").parquet(end)
            found = J.run(folded, out=out)
        return found
    finally:
        spark.conf.set(_STORE, before)


def expiring_first(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, tie: str, seconds: int, out: str, *, columns: Sequence[str] = (), delay: str = "0 seconds", files: int = 64, complete: bool = False, buckets: int = 1024
) -> DataFrame:
    """ts, keys, tie and columns of the rows whose key is not held, over a stream; see folds.expiring_first() for the rule.

    Rows with a null key or time hold nothing and always pass; repeated rows are held back by the first. An empty table gives no row. Rows that are
    later than ``delay`` allows are dropped. With ``complete`` the input has ended and nothing waits any longer; rows that come afterwards are late.
    ``buckets`` must stay the same for an ``out``.
    """
    kept = list(dict.fromkeys([*keys, tie, *columns]))
    kinds = dict(spark.read.parquet(path).dtypes)
    schema = ", ".join(["at long", *(f"`{c}` {kinds[c]}" for c in kept)])
    processor = Expiring(keys, ["at", *kept], tie, seconds * 1_000_000)
    found = _run(spark, path, keys, ts, kept, delay, f"{out}/known", files, "1 second" if complete else None, processor, schema, buckets)
    some = F.col(ts).isNull()
    for k in keys:
        some = some | F.col(k).isNull()
    rest = J.run(J.events(spark, path, files).select(ts, *kept).where(some), out=f"{out}/rest")
    return found.select(F.timestamp_micros("at").cast(kinds[ts]).alias(ts), *kept).unionByName(rest)


def buffers(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, tie: str, item: str, size: int, seconds: int, out: str, *, delay: str = "0 seconds", files: int = 64, complete: bool = False, buckets: int = 1024
) -> DataFrame:
    """keys, began, first, n, dropped, reason: the flushes of a buffer per key over a stream; see folds.buffers() for the rule.

    A buffer is flushed by its timer even if no row comes. Rows with a null key or time belong to none, a null item is an item. With ``complete`` the
    input has ended and all buffers run out. ``buckets`` must stay the same for an ``out``.
    """
    kept = list(dict.fromkeys([*keys, tie, item]))
    kinds = dict(spark.read.parquet(path).dtypes)
    result = ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), "at long, first string, n long, dropped long, reason string"])
    processor = Buffers(keys, ["at", *kept], tie, item, size, seconds * 1_000_000)
    found = _run(spark, path, keys, ts, kept, delay, out, files, f"{seconds + 1} seconds" if complete else None, processor, result, buckets)
    return found.select(*keys, F.timestamp_micros("at").cast(kinds[ts]).alias("began"), F.col("first").cast(kinds[tie]).alias("first"), "n", "dropped", "reason")
