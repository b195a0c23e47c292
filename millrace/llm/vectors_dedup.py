"""Operator 3: near-duplicate vectors by p-stable hashing.

Vectors are normalised; in every table a few random projections, shifted and quantised, make a vector's bucket.
Vectors that share a bucket are compared exactly. A pair that meets in several tables counts in the first of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm.common import cut
from millrace.llm.components import components
from millrace.llm.joins import attach, with_few

#: Vectors of one bucket that are compared in one block, and rows that share a task's call.
_BLOCK, _TOGETHER = 1024, 4096


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of label and vector where the vector can link, and the vector's components as they are stored, floats or doubles."""
    for batch in batches:
        lists, label = batch["vector"], batch["label"].cast(pa.string())
        offs = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]] + lists.type.value_type.to_pandas_dtype()(0)  # a null is not a number; -0.0 equals 0.0
        offs = offs - offs[0]
        odd, some = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(flat), flat != 0))
        known = lists.is_valid().to_numpy(zero_copy_only=False) & label.is_valid().to_numpy(zero_copy_only=False) & batch["vec_id"].is_valid().to_numpy(zero_copy_only=False)
        links = known & (odd[offs[1:]] == odd[offs[:-1]]) & (some[offs[1:]] > some[offs[:-1]])
        data, at = memoryview(flat.tobytes()), (offs * flat.itemsize).tolist()
        raw = [data[at[i] : at[i + 1]] if x else None for i, x in enumerate(links.tolist())]
        same = [None if v is None else hashlib.sha1(f"{name}:{len(v)}:".encode() + v).hexdigest() for name, v in zip(label.to_pylist(), raw)]
        vectors = pa.array([None if v is None else v.tobytes() for v in raw], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["vec_id"], label, pa.array(same, pa.string()), vectors], ["vec_id", "label", "same", "vector"])


def _hashed(tables: int, projections: int, width: float, seed: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            vectors = [np.frombuffer(v, kind) for v in batch["vector"].to_pylist()]
            names = batch["label"].dictionary_encode()
            known = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names.dictionary.to_pylist()]
            labels = np.array(known, dtype=np.uint64)[names.indices.to_numpy()]
            sizes = np.array([len(v) for v in vectors])
            keys = np.zeros((len(vectors), tables), dtype=np.uint64)
            for d in np.unique(sizes).tolist():
                if d not in drawn:
                    rng = np.random.default_rng([seed, d])
                    drawn[d] = rng.standard_normal((d, tables * projections)), rng.uniform(0, width, tables * projections)
                direction, shift = drawn[d]
                at = np.flatnonzero(sizes == d)
                x = np.stack([vectors[i] for i in at]).astype(np.float64)
                x = x / np.abs(x).max(axis=1)[:, None]  # so that squares neither vanish nor overflow
                x /= np.linalg.norm(x, axis=1)[:, None]
                cells = np.floor((x @ direction + shift) / width).astype(np.int64).view(np.uint64).reshape(len(at), tables, projections)
                h = tn.mix(labels[at, None] + np.arange(tables, dtype=np.uint64) * np.uint64(1000) + np.uint64(d))
                for k in range(projections):
                    h = tn.mix(h * np.uint64(31) + cells[:, :, k])
                keys[at] = h
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch["rep"], batch["weight"], batch["vector"], lists], ["rep", "weight", "vector", "keys"])

    return run


def _compare(threshold: float, kind: type):
    """Links of the buckets in a group: the number of vectors each one links with, and a forest of the links."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bucket, table_no, side = table["bucket"].to_numpy(), table["place"].to_numpy(), table["side"].to_numpy()
        rep, weight = table["rep"].to_numpy(), table["weight"].to_numpy()
        raw = table["vector"].to_pylist()
        before = table["keys"].combine_chunks()  # a row's buckets in the tables ahead of its own
        keys, at = before.values.to_numpy(), before.offsets.to_numpy().astype(np.int64)
        order = np.lexsort((side, bucket))
        edges = np.flatnonzero(np.diff(bucket[order])) + 1
        links = np.zeros(len(rep), dtype=np.int64)
        parent: dict[int, int] = {}
        forest = []

        def top(x):
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        for rows in np.split(order, edges):
            if len(rows) < 2:
                continue
            left, right = rows[side[rows] < 2], rows[side[rows] > 0]  # side 1: both
            x = np.stack([np.frombuffer(raw[i], kind) for i in left]).astype(np.float64)
            y = np.stack([np.frombuffer(raw[i], kind) for i in right]).astype(np.float64)
            x, y = x / np.abs(x).max(axis=1)[:, None], y / np.abs(y).max(axis=1)[:, None]
            cosine = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1))
            one, two = np.nonzero(cosine >= threshold)
            a, b = left[one], right[two]
            fresh = (a != b) if side[rows[0]] != 1 else (a < b)
            a, b = a[fresh], b[fresh]
            ahead = np.arange(int(table_no[rows[0]]))
            for i in range(0, len(a), 100_000):
                p, q = a[i : i + 100_000], b[i : i + 100_000]
                first = ~(keys[at[p, None] + ahead] == keys[at[q, None] + ahead]).any(axis=1)
                p, q = p[first], q[first]
                np.add.at(links, p, weight[q])
                np.add.at(links, q, weight[p])
                for u, v in zip(rep[p].tolist(), rep[q].tolist()):
                    ru, rv = top(u), top(v)
                    if ru != rv:
                        parent[max(ru, rv)] = min(ru, rv)
                        forest.append((u, v))
        some = np.flatnonzero(links)
        count = len(some)
        return pa.table(
            {
                "a": pa.array(np.concatenate([rep[some], np.array([u for u, _ in forest], np.int64)])),
                "b": pa.concat_arrays([pa.nulls(count, pa.int64()), pa.array([v for _, v in forest], pa.int64())]),
                "n": pa.concat_arrays([pa.array(links[some]), pa.nulls(len(forest), pa.int64())]),
            }
        )

    return run


def _cell(distance: float, width: float) -> float:
    """The probability that two vectors at a distance share a projection's cell."""
    if distance == 0:
        return 1.0
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def settings(largest: int, threshold: float, width: float, mates: int = _BLOCK, least: int = 6) -> tuple[int, int]:
    """Tables and projections for a label of ``largest`` different vectors.

    As many projections, ``least`` or more, as leave at most ``mates`` unrelated (orthogonal) ones in a vector's bucket on average, and as
    many tables as leave a pair at ``threshold`` unseen with probability 1e-4 at most.
    """
    projections = max(least, math.ceil(math.log(max(1, largest) / mates) / -math.log(_cell(math.sqrt(2), width))))
    meet = _cell(math.sqrt(2 - 2 * threshold), width) ** projections
    return 1 if meet >= 1 else math.ceil(math.log(1e-4) / math.log1p(-meet)), projections


def near_vectors(
    df: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    tables: int | None = None,
    projections: int | None = None,
    width: float = 2.0,
    seed: int = 5,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row; rows of equal labels link if their cosine is ``threshold`` or more.

    Rows whose label, key or vector is null, or whose vector is empty, zero, or holds a null or a component that is not
    finite, link with nothing (component_id is the row's own key). Vectors of different lengths never link. Equal
    vectors are represented by one of them and link with each other; rows that repeat a key count as vectors of
    their own, but where one key has several different vectors, n_links of its rows adds up over them. ``key`` must be a long. An empty table gives an empty result; other columns are ignored.

    At distance c two vectors share a projection's cell with probability p(c / width); p is 0.85 at a cosine of 0.93 and 0.49 for
    unrelated vectors. Unless given, projections and tables follow the largest label, see settings(): 6 and 20 up to 77,000 vectors, 10 and
    42 at a million. So what unrelated vectors cost grows with about the 1.2th power of a label, not with its square. Large buckets are
    compared in blocks. Vectors move as they are stored, floats or doubles, and are compared in double precision.
    """
    kind = np.float32 if df.select(f"`{vector}`").dtypes[0][1] == "array<float>" else np.float64
    values = F.col(f"`{vector}`").cast("array<float>" if kind is np.float32 else "array<double>")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), values.alias("vector"))
    checked = cut(rows.mapInArrow(_checked, "vec_id long, label string, same string, vector binary"))
    alike = checked.where("same IS NOT NULL").groupBy("same")
    sets = cut(alike.agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.min("label").alias("label"), F.min("vector").alias("vector")))
    total, largest = sets.groupBy("label").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    by_size = settings(largest or 0, threshold, width) if projections is None else settings(0, threshold, width, least=projections)
    tables, projections = tables or by_size[0], by_size[1]
    hashed = sets.select("rep", "weight", "label", "vector").mapInArrow(_hashed(tables, projections, width, seed, kind), "rep long, weight long, vector binary, keys array<long>")
    hashed = cut(hashed)
    sizes = hashed.select(F.explode("keys").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("size"))
    large = cut(sizes.where(F.col("size") > _BLOCK).select("bucket", F.ceil(F.col("size") / _BLOCK).cast("int").alias("blocks")))
    groups = max(1, -(-(total or 0) * tables // _TOGETHER))
    placed = hashed.select("rep", "weight", "vector", "keys", F.posexplode("keys").alias("place", "bucket"))
    placed = placed.withColumn("keys", F.slice("keys", F.lit(1), F.col("place")))
    placed = with_few(placed, large, "bucket", "left")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    # a block meets itself (side 1) and, as the left or right side (0, 2), every other block of its bucket
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j"), F.when(o == mine, 1).when(o > mine, 0).otherwise(2).alias("side")),
    )
    alone = F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(1).alias("side")))
    dealt = placed.withColumn("m", F.explode(F.coalesce(meets, alone)))
    group = F.when(F.col("blocks").isNull(), F.pmod(F.col("bucket"), F.lit(groups))).otherwise(F.col("bucket"))
    dealt = dealt.select("rep", "weight", "vector", "keys", "place", "bucket", group.alias("group"), "m.i", "m.j", "m.side")
    found = cut(dealt.groupBy("group", "i", "j").applyInArrow(_compare(threshold, kind), "a long, b long, n long"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    classes = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "rep")
    named = sets.select("same", "rep", "weight").join(links, "rep", "left").join(classes, "rep", "left")
    named = named.select("same", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = attach(checked.select("vec_id", "same"), named, "same", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
