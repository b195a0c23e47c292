"""Operator 7: removal of repeated passages with a suffix array over many texts.

The suffixes of a collection are put in order column by column: each round puts one more symbol of every string
in front of its suffix; sorting the symbols stably (the transform's column) gives the new order, and the common
prefixes of neighbours are carried along. Where neighbours share ``span`` bytes or more, the passage repeats.

A round for every byte of the longest text would be too many, and one transform of the whole corpus belongs to
one machine. So texts are cut into overlapping strings in places that their content decides: every
passage of ``span`` bytes has one anchor, its window's least hash, and equal passages have equal anchors. Strings around
equal anchors meet in one bucket and are lined up by them, so equal passages stand in one column; the
transform is kept for the column at hand, and at most about 1.7 ``span`` rounds build it. Strings that are
equal as a whole are first reduced to the earliest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm.common import cut, no_tables, shuffle_width, small_batches

#: Grams are counted in so many buckets, to find out which are hot.
_HOT_BITS = 16


@dataclass(frozen=True)
class Layout:
    """span: bytes of a passage that counts; gram: bytes of an anchor; the limits bound buckets and do not change results.

    A gram with more than ``hot_strings`` strings in the corpus, or ``hot_in_batch`` in one batch of rows, is dealt by string as well.
    """

    span: int = 100
    gram: int = 32
    hot_strings: int = 20_000
    hot_in_batch: int = 200
    bucket_strings: int = 4_000

    def __post_init__(self) -> None:
        if not 0 < self.gram <= self.span < 1 << 20:
            raise ValueError("an anchor has at least one byte and lies in a passage of less than 2^20 bytes")


@dataclass
class _Anchors:
    """Anchors in order of place: document, first and last passage start that belong to it, its place, hashes of it and of its string."""

    doc: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    at: np.ndarray
    gram: np.ndarray
    string: np.ndarray


def _anchors(data: np.ndarray, offs: np.ndarray, lay: Layout) -> _Anchors:
    n, window = len(data), lay.span - lay.gram + 1
    none = np.zeros(0, np.int64)
    if n < lay.span:
        return _Anchors(none, none, none, none, none, none)
    prefix = tn.prefix_hash(data, tn.BASE)
    at = np.arange(n - lay.gram + 1)
    grams = tn.span_hash(prefix, tn.BASE, at, at + lay.gram)
    place_bits = np.uint64(max(1, int(n).bit_length()))
    keyed = ((grams >> place_bits) << place_bits) | at.astype(np.uint64)  # least hash first, then leftmost
    blocks = -(-len(keyed) // window)
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keyed)] = keyed
    rows = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = n - lay.span + 1
    least = np.minimum(behind[:starts], ahead[window - 1 : window - 1 + starts])
    anchor = (least & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
    room = np.zeros(n + 1, dtype=np.int32)  # 1 where a passage can start without leaving its document
    long_enough = offs[1:] - offs[:-1] >= lay.span
    room[offs[:-1][long_enough]] += 1
    room[offs[1:][long_enough] - lay.span + 1] -= 1
    valid = np.cumsum(room[:starts]) > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    # neighbouring documents never share an anchor: the passages that would are not valid
    lo = np.flatnonzero(new)
    last = valid.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
    hi = np.flatnonzero(last)
    p = anchor[lo]
    prefix2 = tn.prefix_hash(data, tn.BASE2)
    shape = ((p - lo) << 20 | (hi - lo)).astype(np.uint64)
    string = tn.mix(tn.span_hash(prefix2, tn.BASE2, lo, hi + lay.span) ^ tn.mix(shape))
    doc = np.searchsorted(offs, lo, "right") - 1
    return _Anchors(doc, lo - offs[doc], hi - offs[doc], p - offs[doc], grams[p].view(np.int64), string.view(np.int64))


def _slot(gram: np.ndarray) -> np.ndarray:
    # mixed once more: an anchor is the least hash of its window, so anchors' own high bits are mostly 0
    return (tn.mix(gram.view(np.uint64)) >> np.uint64(64 - _HOT_BITS)).astype(np.int64)


def _count_anchors(lay: Layout):
    """slot, n: where a task has over 32 strings and over twice as many as slots have on average; and the sum of all as slot -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tables()
        counts = np.zeros(1 << _HOT_BITS, dtype=np.int64)
        for batch in batches:
            found = [_anchors(*tn.buffers(batch["text"].slice(i, j - i)), lay) for i, j in tn.slices(batch["text"])]
            if found:  # copies are told apart from many strings: a batch counts equal strings once
                gram, string = (np.concatenate(x) for x in zip(*((a.gram, a.string) for a in found)))
                _, first = np.unique(gram ^ tn.mix(string.view(np.uint64)).view(np.int64), return_index=True)
                counts += np.bincount(_slot(gram[first]), minlength=len(counts))
        many = np.flatnonzero(counts > max(2 * counts.mean(), 32))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(many, -1)), pa.array(np.append(counts[many], counts.sum()))], ["slot", "n"])

    return run


def hot_slots(texts: DataFrame, lay: Layout) -> list[int]:
    """The slots with over four times their share of all strings, and over ``hot_strings``: at most a quarter of 2^16.

    What a task does not report is at most twice a slot's share, or 32, so the sum of the reports tells. A gram outside
    these slots has at most four shares, or ``hot_strings`` and 32 for each task.
    """
    found = texts.select("text").mapInArrow(_count_anchors(lay), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    total = found.where("slot < 0").agg(F.sum("n").alias("n")).select(F.coalesce("n", F.lit(0)).alias("total"))
    least = F.greatest(F.lit(lay.hot_strings), 2 * F.col("total") / F.lit(1 << _HOT_BITS))
    return [r["slot"] for r in found.where("slot >= 0").join(F.broadcast(total)).where(F.col("n") > least).select("slot").collect()]


def _emit_anchors(lay: Layout, hot_at: list[int]):
    """Distinct strings of a batch: route, gram, string, rid, lo, hot; the earliest document of the batch stands for equal ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tables()
        slots = np.zeros(1 << _HOT_BITS, dtype=bool)
        slots[hot_at] = True
        for batch in batches:
            ids = batch["rid"].to_numpy()
            parts = []
            for i, j in tn.slices(batch["text"]):
                a = _anchors(*tn.buffers(batch["text"].slice(i, j - i)), lay)
                parts.append((ids[i:j][a.doc], a.lo, a.gram, a.string))
            if not parts:
                continue
            rid, lo, gram, string = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((lo, rid, string, gram))
            rid, lo, gram, string = rid[order], lo[order], gram[order], string[order]
            first = np.ones(len(gram), dtype=bool)
            first[1:] = (gram[1:] != gram[:-1]) | (string[1:] != string[:-1])
            rid, lo, gram, string = rid[first], lo[first], gram[first], string[first]
            _, which, count = np.unique(gram, return_inverse=True, return_counts=True)
            everywhere = slots[_slot(gram)]
            hot = (count[which] > lay.hot_in_batch) | everywhere if len(gram) else np.zeros(0, bool)
            # a gram with very many strings is dealt by string as well; where only this batch knows, one row tells its other strings
            route = np.where(hot, gram ^ (string & np.int64(0xFFF)) ^ np.int64(0x5555), gram)
            told = np.unique(gram[hot & ~everywhere])
            nothing = pa.nulls(len(told), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(x), y]) for x, y in ((route, pa.array(told)), (gram, pa.array(told)), (string, nothing), (rid, nothing), (lo, nothing))]
                + [pa.array(np.concatenate([hot, np.ones(len(told), bool)]))],
                ["route", "gram", "string", "rid", "lo", "hot"],
            )

    return run


def _emit_strings(lay: Layout, buckets: int):
    """The strings that share their anchor with others: bucket, rid, lo, at (the anchor's place in the string), hot, string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tables()
        for whole in batches:
            marks = whole["marks"].to_pylist()
            some = [i for i, m in enumerate(marks) if m and any(x & 6 for x in m)]
            marks, batch = [marks[i] for i in some], whole.take(pa.array(some, pa.int64()))
            ids = batch["rid"].to_numpy()
            for i, j in tn.slices(batch["text"]):
                data, offs = tn.buffers(batch["text"].slice(i, j - i))
                a = _anchors(data, offs, lay)
                flags = _marked(marks[i:j], a)
                take = np.flatnonzero(flags > 1)  # bit 0: a first string, bit 1: with others beside it, bit 2: with very many
                raw = data.tobytes()
                begin = offs[a.doc[take]] + a.lo[take]
                end = offs[a.doc[take]] + a.hi[take] + lay.span
                hot = flags[take] > 3
                salt = np.where(hot, a.string[take] & np.int64(0xFFF), 0).astype(np.uint64)
                bucket = tn.mix(a.gram[take].view(np.uint64) + tn.mix(salt)) % np.uint64(buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket.astype(np.int64)), pa.array(ids[i:j][a.doc[take]]), pa.array(a.lo[take]), pa.array(a.at[take] - a.lo[take]),
                        pa.array(hot), pa.array([raw[b:e] for b, e in zip(begin.tolist(), end.tolist())], pa.binary()),
                    ],
                    ["bucket", "rid", "lo", "at", "hot", "string"],
                )

    return run


def _marked(marks: list, a: _Anchors) -> np.ndarray:
    """The flags of each anchor, 0 where the document's marks do not name it."""
    flags = np.zeros(len(a.doc), dtype=np.int64)
    sizes = [len(m or ()) for m in marks]
    if sum(sizes):
        named = np.concatenate([np.array(m or (), dtype=np.int64) for m in marks])
        doc = np.repeat(np.arange(len(marks)), sizes)
        width = np.int64(40)
        have = (a.doc << width) | a.lo
        at = np.searchsorted(have, (doc << width) | (named >> 3))
        flags[at] = named & 7
    return flags


def column_order(data: np.ndarray, offs: np.ndarray, at: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every column, from the last to the first: strings in the order of their suffixes there, the place in the string
    where these begin, and the prefix each shares with the one before, up to ``most``.

    ``at`` is the place in each string that is lined up. A string joins where it ends, with an empty suffix, ahead of the others.
    """
    kind = np.uint8 if most < 255 else np.int32
    column = at.max() - at  # of each string's first symbol
    ends = column + np.diff(offs)
    joining = np.argsort(ends, kind="stable")[::-1]
    order, shared, joined = np.zeros(0, np.int64), np.zeros(0, kind), 0
    for c in range(int(ends.max()) - 1, -1, -1):
        until = joined
        while until < len(joining) and ends[joining[until]] == c + 1:
            until += 1
        order = np.concatenate([joining[joined:until], order])
        shared = np.concatenate([np.zeros(until - joined, kind), shared])
        joined = until
        stays = column[order] <= c
        if not stays.all():  # strings that have been read to their first symbol leave
            gone = np.flatnonzero(~stays)
            for g in gone.tolist():
                if g + 1 < len(shared):
                    shared[g + 1] = min(shared[g], shared[g + 1])
            order, shared = order[stays], shared[stays]
        if not len(order):
            continue
        transform = data[offs[order] + c - column[order]]
        step = np.argsort(transform, kind="stable")
        symbols = transform[step]
        same = np.flatnonzero(symbols[1:] == symbols[:-1])
        grown = np.zeros(len(step), dtype=kind)
        if len(same):
            grown[same + 1] = np.minimum(_least(shared, step[same] + 1, step[same + 1]) + 1, most)
        order, shared = order[step], grown
        yield order, c - column[order], shared


def _least(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """min(values[i:j + 1]) for each pair."""
    length = j - i + 1
    level = np.frexp(length)[1] - 1
    table = [values]
    for k in range(int(level.max())):
        above = values.copy()
        half = 1 << k
        np.minimum(table[k][:-half], table[k][half:], out=above[:-half])
        table.append(above)
    flat, n = np.concatenate(table), len(values)
    row = level * n
    return np.minimum(flat[row + i], flat[row + j - (1 << level) + 1])


def _bucket(lay: Layout):
    """Passages that start earlier too: rid, lo, hi; and for hot anchors the bucket's first ones with two hashes."""

    def run(table: pa.Table) -> pa.Table:
        strings = table["string"].combine_chunks()
        data = np.frombuffer(strings.buffers()[2], np.uint8) if strings.buffers()[2] else np.zeros(0, np.uint8)
        offs = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
        data, offs = data[offs[0] : offs[-1]], offs - offs[0]
        rid, lo, hot = table["rid"].to_numpy(), table["lo"].to_numpy(), np.array(table["hot"].to_pylist(), dtype=bool)
        size = np.diff(offs)
        parts, groups = [], 0
        for strings_, place, shared in column_order(data, offs, table["at"].to_numpy(), lay.span):
            full = size[strings_] - place >= lay.span
            group = np.cumsum(shared < lay.span) + groups
            groups = int(group[-1]) + 1
            parts.append((strings_[full], place[full], group[full]))
        sid, place, group = (np.concatenate(x) for x in zip(*parts))
        inner, start = offs[sid] + place, lo[sid] + place
        order = np.lexsort((start, rid[sid], group))
        sid, group, start, inner = sid[order], group[order], start[order], inner[order]
        first = np.ones(len(group), dtype=bool)
        first[1:] = group[1:] != group[:-1]
        # later ones, as runs of starts
        r, s = rid[sid[~first]], start[~first]
        order = np.lexsort((s, r))
        r, s = r[order], s[order]
        edge = np.ones(len(r), dtype=bool)
        edge[1:] = (r[1:] != r[:-1]) | (s[1:] > s[:-1] + 1)
        begin = np.flatnonzero(edge)
        until = (np.append(begin[1:], len(r)) - 1)[: len(begin)]
        tell = np.flatnonzero(first & hot[sid])
        hashes = [tn.span_hash(tn.prefix_hash(data, b), b, inner[tell], inner[tell] + lay.span).view(np.int64) for b in (tn.BASE, tn.BASE2)]
        columns = [
            np.concatenate([r[begin], rid[sid[tell]]]), np.concatenate([s[begin], start[tell]]), np.concatenate([s[until], start[tell]]),
            np.concatenate([np.zeros(len(begin), bool), np.ones(len(tell), bool)]), *(np.concatenate([np.zeros(len(begin), np.int64), h]) for h in hashes),
        ]
        return pa.table([pa.array(c) for c in columns], ["rid", "lo", "hi", "first", "hash1", "hash2"])

    return run


def _judge(lay: Layout, output: list[str]):
    """The removed runs and what is left of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tables()
        for whole in batches:
            for i, j in tn.slices(whole["text"]):
                batch = whole.slice(i, j - i)
                data, offs = tn.buffers(batch["text"])
                n = len(offs) - 1
                a = _anchors(data, offs, lay)
                repeats = _marked(batch["marks"].to_pylist(), a) == 0
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                base = offs[a.doc[repeats]]
                np.add.at(edge, base + a.lo[repeats], 1)
                np.add.at(edge, base + a.hi[repeats] + lay.span, -1)
                runs = batch["runs"].to_pylist()
                sizes = [len(x or ()) for x in runs]
                if sum(sizes):
                    packed = np.concatenate([np.array(x or (), dtype=np.int64) for x in runs])
                    base = np.repeat(offs[:-1], sizes)
                    np.add.at(edge, base + (packed >> 32), 1)
                    np.add.at(edge, base + (packed & 0xFFFFFFFF) + lay.span, -1)
                removed = np.cumsum(edge[:-1]) > 0
                before = np.zeros(len(data), dtype=bool)
                before[1:] = removed[:-1]
                before[offs[:-1][offs[1:] > offs[:-1]]] = False
                begin = removed & ~before
                starts = np.flatnonzero(begin)
                after = np.zeros(len(data), dtype=bool)
                after[:-1] = removed[1:]
                after[offs[1:][offs[1:] > offs[:-1]] - 1] = False
                stops = np.flatnonzero(removed & ~after) + 1
                per = tn.per_document(begin, offs)
                doc = np.repeat(np.arange(n), per)
                kept = data[~removed].tobytes()
                left = np.concatenate([[0], np.cumsum(np.diff(offs) - tn.per_document(removed, offs))]).tolist()
                pieces = [kept[x:y] for x, y in zip(left[:-1], left[1:])]
                made = {
                    "n_bytes": pa.array(np.diff(offs)), "n_removed": pa.array(tn.per_document(removed, offs)), "n_spans": pa.array(per),
                    "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in pieces], pa.string()),
                    "kept_text": pa.array([x.decode("utf-8", "ignore") for x in pieces], pa.string()),
                    "spans": pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()),
                        pa.StructArray.from_arrays([pa.array(starts - offs[doc]), pa.array(stops - offs[doc])], ["start", "end"]),
                    ),
                }
                yield pa.RecordBatch.from_arrays([made[c] if c in made else batch[c] for c in output], output)

    return run


def repeated_passages(df: DataFrame, *, key: str = "doc_id", text: str = "text", layout: Layout = Layout(), with_row: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans; one row per row of ``df``.

    With ``with_row`` also kept_text, and row, a struct of the columns of ``df`` other than the text.

    A byte is removed if a passage of ``layout.span`` bytes that covers it also starts earlier, in a document of a smaller
    key or before in the same one. spans are the maximal removed runs (byte offsets). kept_text is the rest as
    text; bytes of characters that were cut are dropped from it, and kept_sha256 is of the rest as bytes. A null or
    empty text has no bytes. Rows of a null key come after all others; rows of equal keys are ordered by
    text. ``key`` must be a long. An empty table gives an empty result; other columns are ignored.
    """
    small_batches(df.sparkSession)
    lay, spark = layout, df.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text]).alias("row")
    docs = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), *[row] * with_row)
    carried = ["row"] * with_row
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if ids.limit(1).count():
        ordered = docs.orderBy(F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())
        docs = cut(ordered.withColumn("rid", F.monotonically_increasing_id()))
    else:
        docs = docs.withColumn("rid", F.col("doc_id"))
    width = shuffle_width(spark)
    found = docs.select("rid", "text").mapInArrow(_emit_anchors(lay, hot_slots(docs, lay)), "route long, gram long, string long, rid long, lo long, hot boolean")
    dealt = found.repartition(width, "route")
    strings = dealt.groupBy("route", "string").agg(F.min("rid").alias("rid"), F.min_by("lo", "rid").alias("lo"), F.max("hot").alias("hot"))
    beside = Window.partitionBy("route")
    strings = strings.withColumn("beside", F.count("string").over(beside)).withColumn("hot", F.max("hot").over(beside) | (F.col("beside") > lay.hot_strings))
    mark = F.shiftleft("lo", 3) + 1 + F.when(F.col("hot"), 6).when(F.col("beside") > 1, 2).otherwise(0)
    marks = strings.where("rid IS NOT NULL").select("rid", mark.alias("mark"))
    marks = cut(marks.repartition(width, "rid").groupBy("rid").agg(F.collect_list("mark").alias("marks")))
    shared = marks.select(F.sum(F.size(F.filter("marks", lambda x: x.bitwiseAND(2) > 0))).alias("n")).first()["n"] or 0
    buckets = max(width, -(-shared // lay.bucket_strings))
    # both uses of the texts take the same columns, so that Spark moves the texts once
    texts = docs.select("rid", "doc_id", "text", *carried).repartition(width, "rid").join(marks, "rid", "left")
    pieces = texts.select("rid", "doc_id", "text", "marks", *carried).mapInArrow(
        _emit_strings(lay, buckets), "bucket long, rid long, lo long, at long, hot boolean, string binary"
    )
    runs = pieces.groupBy("bucket").applyInArrow(_bucket(lay), "rid long, lo long, hi long, first boolean, hash1 long, hash2 long")
    # first ones of salted buckets are compared once more; a passage has at most one in each bucket. The other rows pass.
    runs = runs.withColumn("route", F.when(F.col("first"), F.col("hash1")).otherwise(F.col("rid")))
    rank = F.row_number().over(Window.partitionBy("route", "first", "hash1", "hash2").orderBy("rid", "lo"))
    runs = runs.withColumn("rank", rank).where("NOT first OR rank > 1")
    runs = runs.groupBy("rid").agg(F.collect_list(F.shiftleft("lo", 32) + F.col("hi")).alias("runs"))
    output = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept_text", "row"] * with_row
    kinds = {"row": docs.schema["row"].dataType.simpleString() if with_row else "", "spans": "array<struct<start: long, end: long>>", "kept_sha256": "string", "kept_text": "string"}
    schema = ", ".join(f"{c} {kinds.get(c, 'long')}" for c in output)
    return texts.join(runs, "rid", "left").select("rid", "doc_id", "text", "marks", "runs", *carried).mapInArrow(_judge(lay, output), schema)


def remove(df: DataFrame, *, key: str = "doc_id", text: str = "text", layout: Layout = Layout()) -> DataFrame:
    """``df`` with what repeats removed from its texts. No row goes, and a null text becomes an empty one."""
    out = repeated_passages(df, key=key, text=text, layout=layout, with_row=True)
    return out.select(*[F.col("kept_text").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns])
