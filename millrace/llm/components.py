"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.joins import attach


def _chase(parents: DataFrame) -> DataFrame:
    """Follow parents (node, parent) to the end of every chain; the distance doubles each time."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parents = stored(attach(parents, above, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")))
        if not parents.where("moved").limit(1).count():
            return parents.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest node reachable.

    Each round hooks every node onto its smallest lower neighbour, follows the chains, and replaces the
    edges by those between the chains' ends. Self-loops, repeated and reversed edges and nulls do no harm (a
    null end drops the edge). All work is in joins and aggregates; only emptiness is looked up on the driver.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL")
    nodes = e.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    left = stored(e.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    rounds = []
    while left.limit(1).count():
        parents = _chase(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("parent")))
        rounds.append(parents)
        a = attach(left, parents.withColumnRenamed("node", "lo").withColumnRenamed("parent", "_lo"), "lo", "left")
        both = attach(a, parents.withColumnRenamed("node", "hi").withColumnRenamed("parent", "_hi"), "hi")
        ends = both.select(F.coalesce("_lo", "lo").alias("x"), F.col("_hi").alias("y")).where("x <> y")
        left = stored(ends.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct())
    out = nodes.withColumn("component", F.col("node"))
    for parents in rounds:
        step = parents.withColumnRenamed("node", "component")
        out = attach(out, step, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
    return out
