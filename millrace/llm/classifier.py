"""Operator 6: quality classifier, an interpolated modified Kneser-Ney n-gram model over characters.

The model is trained on all trusted text. Counts, continuation counts, discounts and back-off weights are tables
that are joined by n-gram, sharded by Spark; no n-gram table is gathered on the driver, and tables of single symbols are
broadcast only where they have been found to be small. Documents are dealt into blocks of text; each block asks for its
distinct n-grams, gets their probabilities by joins, and scores its documents. Symbols are code points, 21 bits each: an
n-gram is its context, a long, and its last symbol, an int. A document is kept if its
perplexity is at most a quantile of the trusted documents of its language. For that quantile trusted documents are
scored by models without their own counts: they are dealt into folds by their keys, and beside the model of all trusted
text there is one for each fold, of the trusted text outside it. All models are rows of the same tables.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm.common import cut, no_tables, shuffle_width, small_batches
from millrace.llm.joins import attach, with_few

ORDER = 4
_BITS = 21
_BEGIN, _STOP, _FIRST = 1, 2, 3  # then come the code points
_MASK = [(1 << (_BITS * n)) - 1 for n in range(ORDER)]
#: Trusted documents are dealt into so many folds, 7 at most: the bits above an n-gram's last symbol tell its model, 0
#: for that of all trusted text, k for that of the text outside fold k.
FOLDS = 5
#: Perplexities are ranked on a scale of this many steps to a factor of e.
_STEPS = 1000
#: An n-gram of a text with more symbols than short numbers can tell apart.
_WIDE = np.dtype([("context", "<i8"), ("last", "<i4")])


class _Symbols:
    """Numbers of 16 bits for the symbols met so far, so that an n-gram of four fits one machine word inside a task."""

    most = 1 << 16

    def __init__(self) -> None:
        self.number = np.zeros(0x110000 + _FIRST, dtype=np.uint16)
        self.known = np.array([0, _BEGIN, _STOP], dtype=np.int64)
        self.number[[_BEGIN, _STOP]] = 1, 2

    def learn(self, symbols: np.ndarray) -> bool:
        """Whether there are numbers for all of the symbols."""
        new = symbols[self.number[symbols] == 0]
        new = np.unique(new[new > 0])
        if len(self.known) + len(new) > self.most:
            return False
        self.number[new] = np.arange(len(self.known), len(self.known) + len(new))
        self.known = np.concatenate([self.known, new])
        return True

    def pack(self, line: np.ndarray) -> np.ndarray:
        """The n-gram that ends in each symbol of a line that has been learnt."""
        numbers = self.number[line].astype(np.uint64)
        grams = numbers.copy()
        for back in range(1, ORDER):
            grams[back:] |= numbers[:-back] << np.uint64(16 * back)
        return grams

    def spell(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and last symbols."""
        if grams.dtype == _WIDE:
            return grams["context"].copy(), grams["last"].copy()
        parts = [self.known[((grams >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)] for k in range(ORDER)]
        return parts[3] << 2 * _BITS | parts[2] << _BITS | parts[1], parts[0].astype(np.int32)

    def pack_spelt(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The inverse of spell()."""
        out = self.number[last].astype(np.uint64)
        for k in range(1, ORDER):
            out |= self.number[(context >> (k - 1) * _BITS) & _MASK[1]].astype(np.uint64) << np.uint64(16 * k)
        return out


def _wide(line: np.ndarray) -> np.ndarray:
    out = np.zeros(len(line), dtype=_WIDE)
    out["last"] = line
    for back in range(1, ORDER):
        out["context"][back:] |= line[:-back] << (_BITS * (back - 1))
    return out


def _line(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all documents with beginnings and ends between them, where n-grams end, and documents' offsets there."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    ends = lead[offs]  # in characters
    n = len(offs) - 1
    pad = ORDER - 1
    size = np.diff(ends) + pad + 1
    at = np.concatenate([[0], np.cumsum(size)])
    line = np.full(at[-1], _BEGIN, dtype=np.int64)
    doc = np.repeat(np.arange(n), np.diff(ends))
    line[np.arange(len(points)) - ends[doc] + at[doc] + pad] = points + _FIRST
    line[at[1:] - 1] = _STOP
    take = np.ones(len(line), dtype=bool)
    take[(at[:-1, None] + np.arange(pad)).reshape(-1)] = False
    return line, take, np.concatenate([[0], np.cumsum(size - pad)])


def _table(context: np.ndarray, last: np.ndarray, tag: int, **more: np.ndarray) -> pa.RecordBatch:
    columns = {"context": context, "last": last | np.int32(tag << _BITS), **more}
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], list(columns))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams, tagged with their text's fold, summed over as many texts as a task can hold together."""
    no_tables()
    symbols, held, room = _Symbols(), {}, 0

    def merged() -> Iterator[pa.RecordBatch]:
        for fold, parts in held.items():
            g, c = (np.concatenate(x) for x in zip(*parts))
            grams, which = np.unique(g, return_inverse=True)
            yield _table(*symbols.spell(grams), fold, c=np.bincount(which, c, minlength=len(grams)).astype(np.int64))

    for batch in batches:
        folds = batch["fold"].to_numpy()
        for fold in np.unique(folds).tolist():
            texts = batch["text"].filter(pa.array(folds == fold))
            for i, j in tn.slices(texts):
                line, take, _ = _line(*tn.buffers(texts.slice(i, j - i)))
                if not symbols.learn(line):
                    yield from merged()
                    symbols, held, room = _Symbols(), {}, 0
                    if not symbols.learn(line):
                        grams, c = np.unique(_wide(line)[take], return_counts=True)
                        yield _table(*symbols.spell(grams), fold, c=c)
                        continue
                held.setdefault(fold, []).append(np.unique(symbols.pack(line)[take], return_counts=True))
                room += len(held[fold][-1][0])
                if room > 4_000_000:
                    yield from merged()
                    held, room = {}, 0
    yield from merged()


def fold_of(key: str) -> Column:
    """The fold, from 1, of a row's key."""
    return F.pmod(F.xxhash64(key), F.lit(FOLDS)) + 1


def count_grams(texts: DataFrame) -> DataFrame:
    """(context, last, c) of the column ``text`` for every model; ``fold`` tells whose counts a text is left out of."""
    found = texts.select("fold", "text").where("text IS NOT NULL").mapInArrow(_counts, "context long, last int, c long")
    folds = found.groupBy("context", "last").agg(F.sum("c").alias("c"))
    fits = F.filter(F.array(*map(F.lit, range(FOLDS + 1))), lambda k: k != _model(F.col("last")))
    tagged = F.col("last").bitwiseAND(F.lit(_MASK[1])).bitwiseOR(F.shiftleft("model", _BITS))
    return folds.select("context", "last", "c", F.explode(fits).alias("model")).groupBy("context", tagged.alias("last")).agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[list[float]]:
    """By model: modified Kneser-Ney discounts of counts of 0, 1, 2, and 3 or more; plain ones where counts of counts are missing."""
    seen: list[dict[int, int]] = [{} for _ in range(FOLDS + 1)]
    for r in counts.where("c <= 4").groupBy(_model(F.col("last")).alias("model"), "c").agg(F.count("*").alias("n")).collect():
        seen[r["model"]][r["c"]] = r["n"]
    out = []
    for n in seen:
        if any(not n.get(k) for k in (1, 2, 3, 4)):
            out.append([0.0, 0.5, 1.0, 1.5])
        else:
            y = n[1] / (n[1] + 2 * n[2])
            out.append([0.0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), float(k)) for k in (1, 2, 3)])
    return out


def _model(last: Column) -> Column:
    return F.shiftright(last, _BITS)


def _of_model(values: list, model: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (model + 1).cast("int"))


def _shorter(context: Column, n: int) -> Column:
    """The context of the n-gram of order ``n``."""
    return context.bitwiseAND(F.lit(_MASK[n - 1]).cast("long"))


def _kinds(single: DataFrame) -> list[int]:
    """By model: the number of symbols, and one for what is unknown."""
    n = {r["model"]: r["n"] for r in single.groupBy(_model(F.col("last")).alias("model")).agg(F.count("*").alias("n")).collect()}
    return [n.get(k, 0) + 1 for k in range(FOLDS + 1)]


def train(texts: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """By order n: (context, last, p) for every n-gram seen, and (context, model, gamma) for every context seen."""
    counts = {ORDER: cut(count_grams(texts))}
    for n in range(ORDER - 1, 0, -1):  # in how many distinct symbols' company an n-gram was seen
        counts[n] = cut(counts[n + 1].groupBy(_shorter(F.col("context"), n).alias("context"), "last").agg(F.count("*").alias("c")))
    kinds = _kinds(counts[1])
    which = _model(F.col("last"))
    model: dict[int, tuple[DataFrame, DataFrame]] = {}
    for n in range(1, ORDER + 1):
        discounts = _discounts(counts[n])
        d = lambda k, model: _of_model([x[k] for x in discounts], model)  # noqa: B023, E731
        off = F.when(F.col("c") == 1, d(1, which)).when(F.col("c") == 2, d(2, which)).otherwise(d(3, which))
        rows = counts[n].select("context", "last", "c", off.alias("off"), which.alias("model"))
        by = rows.groupBy("context", "model").agg(F.sum("c").alias("total"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"), F.count_if(F.col("c") > 2).alias("n3"))
        # sums of whole numbers, so that the order in which rows arrive cannot change a digit
        of = F.col("model")
        gamma = (d(1, of) * F.col("n1") + d(2, of) * F.col("n2") + d(3, of) * F.col("n3")) / F.col("total")
        contexts = cut(by.select("context", "model", "total", gamma.alias("gamma")))
        rows = attach(rows, contexts, ["context", "model"])
        if n == 1:
            below = _of_model([1.0 / k for k in kinds], which)
        else:
            lower = model[n - 1][0].select(F.col("context").alias("lower"), "last", F.col("p").alias("below"))
            rows = attach(rows.withColumn("lower", _shorter(F.col("context"), n - 1)), lower, ["lower", "last"])
            below = F.col("below")
        p = F.greatest(F.col("c") - F.col("off"), F.lit(0.0)) / F.col("total") + F.col("gamma") * below
        model[n] = (cut(rows.select("context", "last", p.alias("p"))), contexts.select("context", "model", "gamma"))
    return model


def probabilities(grams: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(context, last, logp) for n-grams of the highest order, tagged with their model, seen or not: back off where one is unseen."""
    q = grams.select("context", "last", _model(F.col("last")).alias("model"))
    single, start = model[1]
    unknown = start.select("model", F.col("gamma").alias("_start"))
    q = q.join(F.broadcast(unknown), "model", "left")  # one row of a model: that of the empty context
    p = F.coalesce("_start", F.lit(1.0)) / _of_model(_kinds(single), F.col("model"))
    for n in range(1, ORDER + 1):
        seen, contexts = model[n]
        seen = seen.select(F.col("context").alias("_key"), "last", F.col("p").alias("_seen"))
        contexts = contexts.select(F.col("context").alias("_key"), "model", "gamma")
        q = q.withColumn("_key", _shorter(F.col("context"), n))
        q = with_few(q, seen.drop("_key"), "last", "left") if n == 1 else attach(q, seen, ["_key", "last"], "left")
        value = F.coalesce("_seen", p)
        if n > 1:
            q = with_few(q, contexts, ["_key", "model"], "left") if n == 2 else attach(q, contexts, ["_key", "model"], "left")
            value = F.coalesce("_seen", F.coalesce("gamma", F.lit(1.0)) * F.col("_p"))
        q = q.withColumn("_p2", value).drop("_p", "_seen", "gamma", "_key").withColumnRenamed("_p2", "_p")
        p = F.col("_p")
    return q.select("context", "last", F.log("_p").alias("logp"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batch's texts by block, each once and compressed: they move between machines at a third of their size."""
    no_tables()
    for batch in batches:
        table = pa.Table.from_batches([batch])
        block = batch["block"].to_numpy()
        named = np.stack([block, batch["text_hash"].to_numpy()], axis=1)
        _, order = np.unique(named, axis=0, return_index=True)  # a text's hash and model decide its block
        edges = np.flatnonzero(np.diff(block[order], prepend=-1))
        out = []
        for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
            sink = io.BytesIO()
            part = table.take(pa.array(order[i:j])).drop_columns(["block"])
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(part)
            out.append(sink.getvalue())
        yield pa.RecordBatch.from_arrays([pa.array(block[order][edges]), pa.array(out, pa.binary())], ["block", "rows"])


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of each block, tagged with its model; the input is sorted by block. One may come twice."""
    symbols, held, current, tag = _Symbols(), [], None, 0

    def asked(grams: np.ndarray) -> pa.RecordBatch:
        return _table(*symbols.spell(grams), tag, block=np.full(len(grams), current))

    for batch in batches:
        for block, rows in zip(batch["block"].to_pylist(), batch["rows"]):
            if block != current:
                if held:
                    yield asked(np.unique(np.concatenate(held)))
                symbols, held, current = _Symbols(), [], block
            table = pa.ipc.open_stream(rows.as_buffer()).read_all()
            texts, tag = table["text"].combine_chunks(), table["model"][0].as_py()
            for i, j in tn.slices(texts):
                line, take, _ = _line(*tn.buffers(texts.slice(i, j - i)))
                if not symbols.learn(line):
                    if held:
                        yield asked(np.unique(np.concatenate(held)))
                    symbols, held = _Symbols(), []
                    if not symbols.learn(line):
                        yield asked(np.unique(_wide(line)[take]))
                        continue
                held.append(np.unique(symbols.pack(line)[take]))
                if len(held) > 16:
                    held = [np.unique(np.concatenate(held))]
    if held:
        yield asked(np.unique(np.concatenate(held)))


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    context, last, logp = (right[c].to_numpy() for c in ("context", "last", "logp"))
    last = last & _MASK[1]
    symbols = _Symbols()
    fits = symbols.learn(np.unique(last).astype(np.int64)) and all(symbols.learn(np.unique((context >> k * _BITS) & _MASK[1])) for k in range(ORDER - 1))
    if fits:
        grams = symbols.pack_spelt(context, last)
    else:
        grams = np.zeros(len(last), dtype=_WIDE)
        grams["context"], grams["last"] = context, last
    order = np.argsort(grams)
    grams, logp = grams[order], logp[order]
    out, seen = [], np.zeros(0, np.int64)
    for rows in left["rows"].combine_chunks():
        table = pa.ipc.open_stream(rows.as_buffer()).read_all()
        new = ~np.isin(table["text_hash"].to_numpy(), seen)  # all copies of a text are in this block
        table, seen = table.filter(pa.array(new)), np.concatenate([seen, table["text_hash"].to_numpy()[new]])
        texts = table["text"].combine_chunks()
        counts, sums = [], []
        for i, j in tn.slices(texts):
            line, take, offs = _line(*tn.buffers(texts.slice(i, j - i)))
            distinct, which = np.unique((symbols.pack(line) if fits else _wide(line))[take], return_inverse=True)
            values = logp[np.searchsorted(grams, distinct)][which]
            counts.append(np.diff(offs))
            sums.append(np.add.reduceat(values, offs[:-1]))
        join = lambda x: np.concatenate(x) if x else np.zeros(0)
        n = join(counts).astype(np.int64)
        out.append(table.drop_columns(["text"]).append_column("n_symbols", pa.array(n)).append_column("log_perplexity", pa.array(-join(sums) / np.maximum(n, 1))))
    return pa.concat_tables(out)


def perplexities(docs: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]], block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, lang, mark, held, n_symbols, log_perplexity for rows (doc_id, lang, text, mark, model, held) that have a text.

    Equal texts are scored once for each model, and their rows, however many, take the result in a join. Texts are told by 64-bit hashes.
    """
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    size = {r["model"]: r["size"] for r in docs.groupBy("model").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    blocks = [max(1, -(-size.get(k, 0) // block_bytes)) for k in range(FOLDS + 1)]
    first = np.cumsum([0, *blocks]).tolist()[:-1]
    # a block holds texts for one model
    block = _of_model(first, F.col("model")) + F.pmod(F.xxhash64("text_hash"), _of_model(blocks, F.col("model")))
    placed = hashed.select("text_hash", "text", "model", block.cast("long").alias("block"))
    packed = placed.mapInArrow(_pack, "block long, rows binary").repartition(shuffle_width(docs.sparkSession), "block")
    asked = packed.sortWithinPartitions("block").mapInArrow(_ask, "context long, last int, block long")
    answers = probabilities(asked.select("context", "last").distinct(), model)
    answered = attach(asked, answers, ["context", "last"]).select("block", "context", "last", "logp")
    scored = packed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(_score, "text_hash long, model long, n_symbols long, log_perplexity double")
    rows = hashed.select("doc_id", "lang", "mark", "held", "text_hash", "model")
    return attach(rows, scored, ["text_hash", "model"]).select("doc_id", "lang", "mark", "held", "n_symbols", "log_perplexity")


def limits(scored: DataFrame, quantile: float) -> DataFrame:
    """(lang, limit): the least log perplexity, in steps, that a share ``quantile`` of the language's held-out rows does not exceed.

    The row of a null lang is over all languages. The histogram bounds what a group holds.
    """
    step = F.ceil(F.col("log_perplexity") * _STEPS).cast("long")
    bins = scored.where("held").groupBy("lang", step.alias("step")).agg(F.sum(F.lit(1)).alias("n"))
    every = bins.groupBy("step").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(None).cast("string"))
    both = bins.where("lang IS NOT NULL").unionByName(every)
    w = Window.partitionBy("lang")
    running = both.withColumn("upto", F.sum("n").over(w.orderBy("step"))).withColumn("all", F.sum("n").over(w))
    return running.where(F.col("upto") >= quantile * F.col("all")).groupBy("lang").agg((F.min("step") / _STEPS).alias("limit"))


def classify(
    df: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label_key: str = "doc_id",
    trusted: str = "quality = 1 AND toxic = 0",
    quantile: float = 0.99,
) -> DataFrame:
    """doc_id, lang, n_symbols, log_perplexity, limit, kept; one row per row of ``df``.

    n_symbols counts the text's code points and its end.

    Trusted documents are those whose key has a label row for which ``trusted`` holds; all of them train. A row is kept if
    its perplexity is at most the quantile of its language's trusted rows, each scored by a model of the trusted rows
    outside its fold; if one fold holds all of them, by the model of all. A language without trusted rows, or a null one,
    is held against all trusted rows. A null or empty text has no perplexity and is not kept. Without any
    trusted text there is nothing to compare with, and every other row is kept. Repeated rows are scored alike; null keys
    have no label. An empty table gives an empty result. Other columns are ignored.
    """
    out = _classified(df, labels, key, text, lang, label_key, trusted, quantile)
    return out.select("doc_id", "lang", "n_symbols", "log_perplexity", "limit", "kept")


def _mark(key: str, text: str, lang: str) -> Column:
    """What a row's decision depends on, as a number."""
    return F.xxhash64(F.col(f"`{text}`"), F.coalesce(F.col(f"`{lang}`"), F.lit("")), F.col(f"`{key}`").isNull(), F.col(f"`{key}`"))


def _classified(df: DataFrame, labels: DataFrame, key: str, text: str, lang: str, label_key: str, trusted: str, quantile: float) -> DataFrame:
    small_batches(df.sparkSession)
    docs = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), _mark(key, text, lang).alias("mark"))
    good = cut(labels.where(trusted).select(F.col(f"`{label_key}`").alias("doc_id")).where("doc_id IS NOT NULL").distinct())
    marked = with_few(docs, good.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    marked = marked.select("doc_id", "lang", "text", "mark", "trusted", fold_of("doc_id").alias("fold"))
    blank = F.coalesce(F.length("text"), F.lit(0)) == 0
    model = train(marked.where("trusted"))
    known = [k if kinds > 1 else 0 for k, kinds in enumerate(_kinds(model[1][0]))]
    whole = F.struct(F.lit(0).cast("long").alias("model"), F.lit(False).alias("held"))
    without = F.struct(_of_model(known, F.col("fold")).cast("long").alias("model"), F.lit(True).alias("held"))
    asked = marked.where(~blank).select("doc_id", "lang", "text", "mark", F.explode(F.when(F.col("trusted"), F.array(whole, without)).otherwise(F.array(whole))).alias("by"))
    scored = cut(perplexities(asked.select("doc_id", "lang", "text", "mark", "by.model", "by.held"), model))
    bound = cut(limits(scored, quantile))
    pooled = bound.where("lang IS NULL").select(F.col("limit").alias("_pooled"))
    own = bound.where("lang IS NOT NULL")
    empty = marked.where(blank).select("doc_id", "lang", "mark", F.lit(0).cast("long").alias("n_symbols"), F.lit(None).cast("double").alias("log_perplexity"))
    rows = scored.where("NOT held").drop("held").unionByName(empty)
    rows = with_few(rows, own, "lang", "left")
    rows = rows.join(F.broadcast(pooled.groupBy().agg(F.max("_pooled").alias("_pooled"))))
    limit = F.coalesce("limit", "_pooled")
    kept = F.coalesce(F.col("log_perplexity") <= limit, F.col("log_perplexity").isNotNull())
    return rows.select("doc_id", "lang", "mark", "n_symbols", "log_perplexity", limit.alias("limit"), kept.alias("kept"))


def keep(
    df: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label_key: str = "doc_id",
    trusted: str = "quality = 1 AND toxic = 0",
    quantile: float = 0.99,
) -> DataFrame:
    """The rows of ``df`` that are kept, with its columns.

    Every row goes or stays by its own text and language, also where its key is null or that of another row; rows that
    agree in all three go or stay together. Options are those of classify(); an empty table stays empty.
    """
    out = _classified(df, labels, key, text, lang, label_key, trusted, quantile)
    place = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rejected = out.where("NOT kept").select(F.col("mark").alias("_mark"), place.alias("_place")).distinct()
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), _mark(key, text, lang).alias("_mark"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_place"))
    left = with_few(rows, cut(rejected), ["_mark", "_place"], "left_anti")
    return left.select(*[F.col("_row")[c].alias(c) for c in df.columns])
