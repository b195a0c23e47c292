"""Operator 8: near-duplicates by circulant MinHash.

Two permutations of the 64-bit space make every signature coordinate: the first scatters a text's word
shingles, the second, shifted circularly by k, gives coordinate k. Bands of coordinates bucket the texts, the
buckets' links make families, and every link is confirmed on the full shingle sets: with the family's centre, and where
that is not alike with the mates in each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm.common import cut, no_tables, small_batches
from millrace.llm.components import components
from millrace.llm.joins import attach, with_few

#: Texts of one family that one task compares.
_CHUNK, _QUERIES = 1000, 500

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(array: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of the texts: sorted distinct shingle hashes of all documents, and each document's offsets there."""
    for i, j in tn.slices(array):
        data, offs = tn.buffers(array.slice(i, j - i))
        data = _LOWER[data]
        n = len(offs) - 1
        start, end, doc = tn.words(data, offs)
        word = tn.span_hash(tn.prefix_hash(data, tn.BASE), tn.BASE, start, end)
        first = np.searchsorted(doc, np.arange(n))
        count = np.bincount(doc, minlength=n)
        begin = np.flatnonzero(doc[width - 1 :] == doc[: len(doc) - width + 1]) if len(doc) >= width else np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < width))
        begin, until = np.concatenate([begin, first[short]]), np.concatenate([begin + width, first[short] + count[short]])
        over = tn.prefix_hash(word, tn.BASE2)
        h, d = tn.span_hash(over, tn.BASE2, begin, until), doc[begin] if len(begin) else np.zeros(0, np.int64)
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, d = h[new], d[new]
        yield h, np.searchsorted(d, np.arange(n + 1))


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def _features(width: int, bands: int, rows: int, seed: int):
    @F.arrow_udf("struct<n: long, set_hi: long, set_lo: long, bands: array<long>>")
    def features(text: pa.Array) -> pa.Array:
        no_tables()
        sizes, his, los, keys = [], [], [], []
        for h, offs in shingle_hashes(text, width):
            n = np.diff(offs)
            full = np.flatnonzero(n)
            scattered = tn.mix(h ^ np.uint64(seed))  # the first permutation
            out = np.zeros((len(n), bands), dtype=np.uint64)
            for k in range(bands * rows if len(full) else 0):
                shifted = tn.mix(scattered - np.uint64(k))  # the second, shifted by k
                least = np.minimum.reduceat(shifted, offs[:-1][full])
                out[full, k // rows] = tn.mix(out[full, k // rows] * np.uint64(31) + least + np.uint64(k))
            sizes.append(n)
            his.append(_sums(tn.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), offs))
            los.append(_sums(tn.mix(h + np.uint64(0x1234567)), offs))
            keys.append(out)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        flat = np.concatenate(keys).reshape(-1).view(np.int64) if keys else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), pa.array(flat, pa.int64()))
        cols = [pa.array(join(sizes), pa.int64()), *(pa.array(join(x).astype(np.uint64).view(np.int64), pa.int64()) for x in (his, los)), lists]
        return pa.StructArray.from_arrays(cols, ["n", "set_hi", "set_lo", "bands"])

    return features


def _full_sets(width: int):
    @F.arrow_udf("binary")
    def full_sets(text: pa.Array) -> pa.Array:
        no_tables()
        out = []
        for h, offs in shingle_hashes(text, width):
            raw = h.tobytes()
            out += [raw[8 * i : 8 * j] for i, j in zip(offs[:-1].tolist(), offs[1:].tolist())]
        return pa.array(out, pa.binary())

    return full_sets


def _sets(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
    return sets, np.array([len(s) for s in sets], dtype=np.int64)


def _alike(common: np.ndarray, a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def _star(percent: int):
    """Which members of a chunk link with the family's centre."""

    def run(table: pa.Table) -> pa.Table:
        no_tables()
        centre = np.array(table["centre"].to_pylist(), dtype=bool)
        sets, n = _sets(table)
        c = sets[int(np.flatnonzero(centre)[0])]
        owner = np.repeat(np.arange(len(n)), n)
        hit = np.isin(np.concatenate(sets), c, assume_unique=False)
        linked = _alike(np.bincount(owner[hit], minlength=len(n)), len(c), n, percent)
        t = table.select(["family", "rep"]).append_column("linked", pa.array(linked))
        return t.filter(pa.array(~centre))

    return run


def _against(percent: int):
    """Links of a chunk's members with texts that are not linked with their centre, thinned to a forest."""

    def run(table: pa.Table) -> pa.Table:
        no_tables()
        asks = np.array(table["asks"].to_pylist(), dtype=bool)
        sets, n = _sets(table)
        reps = table["rep"].to_numpy()
        base = np.flatnonzero(~asks)
        owner = np.repeat(np.arange(len(base)), n[base])
        values = np.concatenate([sets[i] for i in base])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        parent = {}

        def top(x):
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        found = []
        for q in np.flatnonzero(asks):
            lo, hi = np.searchsorted(values, sets[q], "left"), np.searchsorted(values, sets[q], "right")
            many = hi - lo
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - lo, many)
            common = np.bincount(owner[at], minlength=len(base))
            for b in base[_alike(common, int(n[q]), n[base], percent)]:
                x, y = top(int(reps[q])), top(int(reps[b]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((int(reps[q]), int(reps[b])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def _bucket_mates(buckets: DataFrame, apart: DataFrame) -> DataFrame:
    """Blocks in which the texts of ``apart`` meet all that share a bucket with them; of buckets that hold the same texts one is taken."""
    stuck = attach(buckets, apart, "rep")
    asking = stuck.groupBy("bucket").agg(F.count("*").alias("asking"))
    held = attach(buckets, asking, "bucket").groupBy("bucket", "asking")
    held = held.agg(F.count("*").alias("mates"), F.bit_xor(F.xxhash64("rep")).alias("mix"), F.min("rep").alias("low"), F.max("rep").alias("high")).where("mates > 1")
    one = held.groupBy("asking", "mates", "mix", "low", "high").agg(F.min("bucket").alias("bucket"))
    groups, chunks = F.ceil(F.col("asking") / _QUERIES).cast("int"), F.ceil(F.col("mates") / _CHUNK).cast("int")
    one = cut(one.select("bucket", groups.alias("groups"), chunks.alias("chunks")))
    seat, all_of = F.xxhash64("rep"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = attach(buckets, one, "bucket").select("bucket", all_of("groups").alias("part"), F.pmod(seat, F.col("chunks")).cast("int").alias("chunk"), "rep", F.lit(False).alias("asks"))
    asks = attach(stuck, one, "bucket").select("bucket", F.pmod(seat, F.col("groups")).cast("int").alias("part"), all_of("chunks").alias("chunk"), "rep", F.lit(True).alias("asks"))
    return base.unionByName(asks)


def bands_for(percent: int, rows: int) -> int:
    """The least number of bands with which a pair alike in ``percent`` shares none with probability 1e-6 at most."""
    agree = (percent / 100) ** rows
    return 1 if agree >= 1 else math.ceil(math.log(1e-6) / math.log1p(-agree))


def near_duplicates(
    df: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, bands: int | None = None, rows: int = 6, seed: int = 11
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; texts link when their Jaccard similarity is ``percent`` or more.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered. A text with fewer words than ``width`` has its whole sequence
    as its one shingle. Null, empty and wordless texts have no shingles and link with nothing. Rows that share an
    id count as one document for links. A row whose key is null links with nothing: its component is null
    and it is kept. ``key`` must be a long. An empty table gives an empty result; other columns are ignored.

    Equal sets are grouped first and one of each represents them; then every representative with a bucket mate
    goes to its family, in chunks that bound what a task holds. There it is compared with the family's
    centre. What does not link with the centre is compared with its mates in every bucket, in blocks; that rule holds for
    families of any size. Unless ``bands`` is given, a pair at ``percent`` shares no bucket with probability 1e-6 at most: 30
    bands of 6 at 85, 46 at 80.
    """
    small_batches(df.sparkSession)
    bands = bands or bands_for(percent, rows)
    docs = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    f = F.col("f")
    whole = F.concat_ws(":", f["set_hi"], f["set_lo"], f["n"])
    features = cut(
        docs.select("doc_id", _features(width, bands, rows, seed)("text").alias("f")).select(
            "doc_id", f["n"].alias("n_shingles"), F.when((f["n"] > 0) & F.col("doc_id").isNotNull(), whole).alias("same"), f["bands"].alias("bands")
        )
    )
    first = features.where("same IS NOT NULL").groupBy("same").agg(F.min(F.struct("doc_id", "bands")).alias("m"))
    sets = cut(first.select("same", F.col("m.doc_id").alias("rep"), F.col("m.bands").alias("bands")))
    buckets = sets.select("rep", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("mates"), F.min("rep").alias("least")).where("mates > 1")
    placed = cut(attach(buckets, shared, "bucket").groupBy("rep").agg(F.sum("mates").alias("score"), F.collect_set("least").alias("leasts")))
    families = components(placed.select(F.col("rep").alias("a"), F.explode("leasts").alias("b")))
    members = cut(attach(placed.select("rep", "score"), families.select(F.col("node").alias("rep"), F.col("component").alias("family")), "rep"))
    centres = members.groupBy("family").agg(F.count("*").alias("size"), F.max(F.struct("score", -F.col("rep"))).alias("best"))
    centres = cut(centres.select("family", F.ceil(F.col("size") / _CHUNK).cast("int").alias("chunks"), (-F.col("best.col2")).alias("centre")))
    spot = attach(members.select("rep", "family"), centres, "family")
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("chunk")
    seats = spot.select("family", chunk, "rep", F.lit(False).alias("centre"))
    middle = centres.select("family", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("centre").alias("rep"), F.lit(True).alias("centre"))
    shingles = _full_sets(width)("text").alias("shingles")

    def with_sets(seats: DataFrame) -> DataFrame:
        """The seats with their texts' shingles, which are made once for each text however many seats it has."""
        places = [c for c in seats.columns if c != "rep"]
        by_text = cut(seats.groupBy(F.col("rep").alias("doc_id")).agg(F.collect_list(F.struct(*places)).alias("seats")))
        made = with_few(docs, by_text, "doc_id").select(F.col("doc_id").alias("rep"), "seats", shingles)
        return made.select("rep", F.explode("seats").alias("seat"), "shingles").select("rep", "seat.*", "shingles")

    star = with_sets(seats.unionByName(middle)).groupBy("family", "chunk").applyInArrow(_star(percent), "family long, rep long, linked boolean")
    star = cut(star)
    direct = attach(star.where("linked"), centres.select("family", "centre"), "family").select(F.col("centre").alias("a"), F.col("rep").alias("b"))
    asked = _bucket_mates(buckets, cut(star.where("NOT linked").select("rep")))
    rest = with_sets(asked).groupBy("bucket", "part", "chunk").applyInArrow(_against(percent), "a long, b long")
    classes = components(cut(direct.unionByName(rest)))
    named = sets.select("same", "rep").join(classes.withColumnRenamed("node", "rep"), "rep", "left").select("same", F.coalesce("component", "rep").alias("component"))
    out = attach(features.drop("bands"), named, "same", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep(df: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay, with its columns: one of each class of texts, that of the smallest key.

    Every row is judged by its own text: where keys are null or repeat, rows are numbered in the order of key (null last)
    and text, so that repeated rows leave one and a row without a copy stays whatever its key. Options are those of
    near_duplicates(); an empty table stays empty.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    docs = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), row)
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count():
        docs = docs.orderBy(F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()).withColumn("doc_id", F.monotonically_increasing_id())
        docs = cut(docs)
    copies = near_duplicates(docs.select("doc_id", "text"), **options).where("NOT kept").select("doc_id")
    left = with_few(docs.select("doc_id", "row"), cut(copies), "doc_id", "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in df.columns])
