"""Operator 13: which sources of a language diverge, and by which terms.

Tasks count terms where the texts lie; a document lies in one row, so counts of occurrences and of documents both add up. A term's
score depends on two counts alone, so terms are grouped by (count in the group, count in the language), the score is evaluated once
for each such cell, cells of equal score are merged, and the running number of their terms tells which scores reach the first ranks; only
these cells are expanded into terms again.

Pairs of sources are summed from cells as well. If f(a, b) is the divergence of one term with counts a and b in two sources, the sum
over all terms is the sum over the first source's cells of f(a, 0), that over the second's of f(0, b), f(0, 0) for the others, and a
correction f(a, b) - f(a, 0) - f(0, b) + f(0, 0) for the terms that both have. The correction is summed by tasks that hold whole terms,
pairs of sources at a time, so that rows of pairs never leave them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm.common import small_batches, stored
from millrace.llm.joins import with_few

#: What a term is made of: letters of ASCII and all bytes of other characters.
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

#: Rows that a task gathers before it merges equal ones.
_HELD = 1 << 20
#: Rows of whole terms that are compared at a time.
_BLOCK = 1 << 16


def terms_of(data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in ``data`` in order, A-Z in lower case, and the text of each."""
    inside = _INSIDE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offs[:-1][offs[1:] > offs[:-1]]
    begins[first] = inside[first]
    start, bytes_ = np.flatnonzero(begins), _LOWER[data[inside]]
    ends = np.append(np.cumsum(inside)[start] - 1, len(bytes_)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.tobytes()), pa.py_buffer(bytes_.tobytes()))
    return words, np.searchsorted(offs, start, "right") - 1


def _count(texts: pa.Array, group: np.ndarray) -> pa.Table:
    """group, term, n, docs of some whole texts."""
    words, doc = terms_of(*tn.buffers(texts))
    coded = words.dictionary_encode()
    codes, size = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
    in_doc, n = np.unique(doc * size + codes, return_counts=True)
    key, place = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
    summed = np.bincount(place, n, len(key)).astype(np.int64)  # far under 2**53
    docs = np.bincount(place, minlength=len(key))
    return pa.table({"group": key // size, "term": coded.dictionary.take(pa.array(key % size)), "n": summed, "docs": docs})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        table = pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return table.rename_columns(["group", "term", "n", "docs"])

    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = list(codes)
        group = table["group"].combine_chunks()
        lang, source = (pa.array([x[k] for x in names], pa.string()).take(group) for k in (0, 1))
        columns = [lang, source, table["term"].combine_chunks().cast(pa.string()), table["n"].combine_chunks(), table["docs"].combine_chunks()]
        yield from pa.table(columns, ["lang", "source", "term", "n", "docs"]).to_batches(1 << 16)

    for batch in batches:
        pairs = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
        group = np.array([codes.setdefault(p, len(codes)) for p in pairs], dtype=np.int64)
        for i, j in tn.slices(batch["text"], 1 << 22):
            held.append(_count(batch["text"].slice(i, j - i), group[i:j]))
            if sum(t.num_rows for t in held) > _HELD:
                held = [merged()]
                if held[0].num_rows > _HELD // 2:
                    yield from rows(held[0])
                    held = []
    if held:
        yield from rows(merged())


def _reduced(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values, in whole numbers."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(value, first)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def corrections(group: np.ndarray, run: np.ndarray, p: np.ndarray, p0: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of groups, as a * ``groups`` + b, and what their common terms add to the sum of their cells.

    Rows are a group's count of one term, as shares ``p`` and, for no occurrence, ``p0``; rows of one term have one ``run`` and stand together.
    """
    keys, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    shift = 1
    while True:
        i = np.flatnonzero(run[shift:] == run[:-shift])
        if not len(i):
            break
        j = i + shift
        extra = _f(p[i], p[j]) - _f(p[i], p0[j]) - _f(p0[i], p[j]) + _f(p0[i], p0[j])
        k, s = _reduced(group[i] * groups + group[j], extra)
        keys.append(k)
        sums.append(s)
        shift += 1
    return _reduced(np.concatenate(keys), np.concatenate(sums))


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes: dict[tuple[str, str], int] = {}
    sums: dict[tuple[int, int], int] = {}
    held: pa.Table | None = None

    def add(table: pa.Table) -> None:
        columns = [table[c].combine_chunks() for c in ("lang", "source", "term")]
        group = np.array([codes.setdefault(x, len(codes)) for x in zip(columns[0].to_pylist(), columns[1].to_pylist())], dtype=np.int64)
        lang, term = (columns[k].dictionary_encode().indices.to_numpy().astype(np.int64) for k in (0, 2))
        new = np.append(True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1]))
        size = len(codes)
        for key, value in zip(*(x.tolist() for x in corrections(group, np.cumsum(new), table["p"].to_numpy(), table["p0"].to_numpy(), size))):
            pair = divmod(key, size)
            sums[pair] = sums.get(pair, 0) + value

    def rows() -> pa.RecordBatch:
        names = list(codes)
        a, b = ([names[pair[side]] for pair in sums] for side in (0, 1))
        columns = [pa.array([x[0] for x in a], pa.string()), pa.array([x[1] for x in a], pa.string()), pa.array([x[1] for x in b], pa.string()), pa.array(list(sums.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "value"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < _BLOCK:
            continue
        last = held.slice(held.num_rows - 1)
        same = pc.and_(pc.equal(held["lang"], last["lang"][0]), pc.equal(held["term"], last["term"][0]))
        whole = held.num_rows - pc.sum(same).as_py()  # a term's rows stand together, and the last term may go on
        if whole:
            add(held.slice(0, whole))
            held = held.slice(whole)
        if len(sums) > _HELD:
            yield rows()
            sums.clear()
    if held is not None and held.num_rows:
        add(held)
    yield rows()


def _share(count: Column, total: Column, terms: Column, scale: int) -> Column:
    """1 + floor(scale * (count + 2) / (total + 2 * terms)) in exact decimals; null without terms."""
    top = (count + 2).cast("decimal(20,0)") * F.lit(scale).cast("decimal(11,0)")
    return F.when(terms > 0, 1 + F.call_function("div", top, (total + 2 * terms).cast("decimal(20,0)")))


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 10, top: int = 10, scale: int = 1_000_000_000
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from the others, and its most telling terms.

    A term is a run of letters of ASCII and of characters beyond it, A-Z in lower case. A language keeps the terms of at least ``least_docs``
    of its documents. The share of a term with ``count`` occurrences is 1 + floor(scale * (count + 2) / (N + 2 V)), and the divergence of shares p
    and q is floor((p - q)^2 / (p + q)). Part "pair" sums it over all kept terms for every other source of the language; part "term" ranks the kept terms that
    the source has more of than its language and returns the first ``top``. Ranks count from 1 by value downwards and item.

    Null text, language and source are read as empty; every row is a document, repeated ones too. A group without terms has shares like any
    other, and where a language keeps none its pairs have the value 0. Equal values are ordered by the bytes of their items. An empty table
    gives no row and other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counts = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    counts = counts.select("*", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"), (F.min("source").over(term) == F.col("source")).alias("first"))
    kept = stored(counts.where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", "first"))

    sums = stored(kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"), F.count_if("first").alias("firsts")))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("lang_terms"))
    groups = rows.select("lang", "source").distinct().join(sums.drop("firsts"), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms", "lang_total", "lang_terms"])
    groups = stored(groups.withColumn("p0", _share(F.lit(0), F.col("total"), F.col("lang_terms"), scale)))

    # the cells of each group, whose number grows far slower than that of its terms
    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("m"))
    p, q = _share(F.col("n"), F.col("total"), F.col("lang_terms"), scale), _share(F.col("lang_n"), F.col("lang_total"), F.col("lang_terms"), scale)
    cells = stored(with_few(cells, groups, ["lang", "source"]).select("lang", "source", "n", "lang_n", "m", p.alias("p"), q.alias("q"), "p0"))

    group = Window.partitionBy("lang", "source")
    scored = cells.where("p > q").select("lang", "source", "n", "lang_n", "m", _divergence(F.col("p"), F.col("q")).alias("value"))
    values = scored.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    down = group.orderBy(F.desc("value"))
    values = values.withColumn("k", F.row_number().over(down)).where(F.col("k") <= top)  # each value has a term at least
    before = F.coalesce(F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value")
    wanted = with_few(scored, values, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value")
    terms = with_few(kept.drop("first"), wanted, ["lang", "source", "n", "lang_n"]).select("lang", "source", F.col("term").alias("item"), "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    ones = with_few(kept.select("lang", "source", "term", "n"), groups.select("lang", "source", "total", "lang_terms", "p0"), ["lang", "source"])
    ones = ones.select("lang", "source", "term", p.alias("p"), "p0").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    common = ones.mapInArrow(_corrected, "lang string, source string, item string, value long")
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("other_p0"), F.col("terms").alias("other_terms"))
    apart = F.col("source") != F.col("item")
    by_count = cells.groupBy("lang", "source", "p").agg(F.sum("m").alias("m"))
    sides = with_few(by_count, others, "lang").where(apart).groupBy("lang", "source", "item").agg(F.sum(F.col("m") * _divergence(F.col("p"), F.col("other_p0"))).alias("value"))
    neither = _divergence(F.col("p0"), F.col("other_p0")) * (F.col("lang_terms") - F.col("terms") - F.col("other_terms"))
    rest = with_few(groups, others, "lang").where(apart).select("lang", "source", "item", F.coalesce(neither, F.lit(0)).alias("value"))
    turned = [x.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value") for x in (common, sides)]
    pairs = common.unionByName(sides).unionByName(turned[0]).unionByName(turned[1]).unionByName(rest)
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(ranked))

    out = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for x, part in ((pairs, "pair"), (terms, "term"))]
    return out[0].unionByName(out[1])
