"""Exact vector search by blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import is_small


def _unit(values: pd.Series) -> np.ndarray:
    x = np.array(values.tolist(), dtype=np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def top_k(queries: DataFrame, base: DataFrame, key: str, vector: str, k: int, query_block: int = 512, base_block: int = 8192) -> DataFrame:
    """query_id, key, rank, score: for every query the ``k`` rows of the largest cosine, itself apart.

    Queries and rows meet block by block; a block yields its k best for each query, and the final ranking reads
    only those; a block has about ``query_block`` queries and ``base_block`` rows, however many there are. Null vectors and those
    without length are skipped. Scores are rounded to 5 digits, ties go by key. Repeated keys are rows of their own, and all of
    them count as the query itself. Empty tables give no row; extra columns are ignored.
    """
    usable = F.exists(vector, lambda x: x != 0)
    parts, base_blocks = max(1, -(-queries.count() // query_block)), max(1, -(-base.count() // base_block))
    q = queries.where(usable).select(F.col(key).alias("id"), F.col(vector).alias("v"), F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("q"))
    q = q.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(base_blocks - 1)))).withColumn("asks", F.lit(True))
    b = base.where(usable).select(F.col(key).alias("id"), F.col(vector).alias("v"), F.pmod(F.xxhash64(key), F.lit(base_blocks)).cast("int").alias("b"))
    b = b.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("asks", F.lit(False))

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        ask, have = rows[rows["asks"]], rows[~rows["asks"]]
        if ask.empty or have.empty:
            return pd.DataFrame({"query_id": [], key: [], "score": []})
        ids = have["id"].to_numpy()
        order = np.argsort(ids)
        ids, base_vectors = ids[order], _unit(have["v"].iloc[order])
        score = np.round(_unit(ask["v"]) @ base_vectors.T, 5)
        score[ask["id"].to_numpy()[:, None] == ids] = -np.inf
        best = np.argsort(-score, axis=1, kind="stable")[:, :k]
        out = pd.DataFrame({"query_id": np.repeat(ask["id"].to_numpy(), best.shape[1]), key: ids[best].reshape(-1), "score": np.take_along_axis(score, best, 1).reshape(-1)})
        return out[np.isfinite(out["score"])]

    found = q.unionByName(b).groupBy("q", "b").applyInPandas(block, f"query_id long, {key} long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), key))
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).select("query_id", key, "rank", "score")


def nearest_prototype(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, label, score: the label whose mean unit vector is nearest; ties by label. There is one prototype per label.

    Null vectors and those without length have none. The prototypes are listed beside every row if they are small; beyond
    that rows and prototypes meet block by block, as in top_k().
    """
    usable = df.where(F.exists(vector, lambda x: x != 0))
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    units = usable.select(key, label, F.transform(vector, lambda x: F.try_divide(x.cast("double"), norm)).alias("u"))
    means = units.select(label, F.posexplode("u").alias("i", "x")).groupBy(label, "i").agg(F.avg("x").alias("x"))
    prototypes = means.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("p"))
    if not is_small(prototypes):
        numbered = prototypes.select(F.row_number().over(Window.orderBy(label)).cast("long").alias("_n"), label, "p")  # one row per label
        rows = units.select(F.monotonically_increasing_id().alias("_n"), key, "u")
        found = top_k(rows.select((-1 - F.col("_n")).alias("_n"), "u"), numbered.select("_n", F.col("p").alias("u")), "_n", "u", 1)
        named = found.join(numbered.select("_n", label), "_n").select((-1 - F.col("query_id")).alias("_n"), F.col(label).alias("label"), "score")
        return rows.select("_n", key).join(named, "_n").select(key, "label", "score")
    listed = prototypes.agg(F.collect_list(F.struct(F.col(label).alias("label"), F.col("p"))).alias("prototypes"))

    def cosine(p):
        dot = F.aggregate(F.zip_with("u", p, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
        return F.round(dot / F.sqrt(F.aggregate(p, F.lit(0.0), lambda a, x: a + x * x)), 5)

    scores = F.transform("prototypes", lambda s: F.struct((-cosine(s["p"])).alias("minus"), s["label"].alias("label")))
    best = units.join(F.broadcast(listed)).select(key, F.array_min(scores).alias("best"))
    return best.select(key, F.col("best.label").alias("label"), (-F.col("best.minus")).alias("score"))
