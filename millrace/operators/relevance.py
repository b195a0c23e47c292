"""A stored inverted index over several fields, and relevance with weights that the corpus decides (BM25)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import small

#: Folders over which an index deals its terms.
PARTS = 64

_TOKEN = "[0-9A-Za-z]+"


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits in lower case."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0)), lambda t: F.lower(t))


def _counted(terms: Column) -> Column:
    """A struct (term, tf) for each distinct one of sorted terms: places where a run begins, and the distance to the next."""

    def runs(t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i) != F.get(t, i - 1)))
        ends = lambda s: F.concat(F.slice(s, 2, F.size(s)), F.array(F.size(t)))
        of = lambda s: F.zip_with(s, ends(s), lambda i, j: F.struct(F.get(t, i).alias("term"), (j - i).alias("tf")))
        return F.flatten(F.transform(F.array(starts), of))

    return F.flatten(F.transform(F.array(F.array_sort(terms)), lambda t: F.when(F.size(t) > 0, runs(t))))


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def postings(df: DataFrame, key: str, fields: Sequence[str], parts: int = PARTS) -> DataFrame:
    """field, term, key, tf, length, part: a row for each field of a row and each of its terms.

    The length is taken beside the counts, before these become rows; taken after, every row would carry all tokens of its text.
    """
    each = [df.select(F.col(f"`{key}`").alias("key"), F.lit(f).alias("field"), tokens(F.col(f"`{f}`")).alias("t")) for f in fields]
    rows = reduce(DataFrame.unionByName, each).where("key IS NOT NULL")
    rows = rows.select("key", "field", F.size("t").alias("length"), "t")
    rows = rows.select("key", "field", "length", F.explode(_counted(F.col("t"))).alias("p"))  # of a column Spark would count twice, to drop empty ones
    return rows.select("field", "p.term", "key", "p.tf", "length", _part(F.col("p.term"), parts).alias("part"))


def build(df: DataFrame, key: str, fields: Sequence[str], path: str, parts: int = PARTS) -> None:
    """Write an index of the fields: postings (field, term, key, tf, length) in folders by term, and the fields' sizes.

    Every row is a document. A text's terms are counted in its own row, so that postings move once, to their folder; folders with a hot
    term are written by several tasks. Rows of a null key, and null or wordless fields, have no postings and do not count. Extra
    columns are ignored, and an empty table makes an index that finds nothing.
    """
    postings(df, key, fields, parts).hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/postings")
    many = lambda f: F.coalesce(F.regexp_count(F.col(f"`{f}`"), F.lit(_TOKEN)), F.lit(0))
    each = [df.select(F.col(f"`{key}`").alias("key"), F.lit(f).alias("field"), many(f).alias("length")) for f in fields]
    sizes = reduce(DataFrame.unionByName, each).where("key IS NOT NULL AND length > 0")
    sizes = sizes.groupBy("field").agg(F.count("*").alias("docs"), F.avg("length").alias("mean"), F.min("key").alias("first_key"))
    sizes.coalesce(1).write.parquet(f"{path}/sizes")  # a row for each field


def search(
    spark: SparkSession, path: str, queries: Mapping[str, str], weights: Mapping[str, float], *, parts: int = PARTS, k1: float = 1.2, b: float = 0.75
) -> DataFrame:
    """query, key, score of every document that has a term of a query in one of the weighted fields; fields not indexed add nothing.

    A field's score is BM25 with its own document frequencies, sizes and mean size, and a document's the weighted sum over fields and
    the query's distinct terms. Rows that share a key add up under it. Only the folders of the queries' terms are read.
    """
    asked = spark.createDataFrame(list(queries.items()), "query string, q string")
    asked = asked.select("query", F.explode(F.array_distinct(tokens(F.col("q")))).alias("term"))  # as long as the caller's queries
    folders = [r[0] for r in asked.select(_part(F.col("term"), parts)).distinct().collect()]
    sizes = spark.read.parquet(f"{path}/sizes")
    key = sizes.schema["first_key"].dataType.simpleString()  # an index of no rows has no postings to tell it
    schema = f"field string, term string, key {key}, tf int, length int, part int"
    postings = spark.read.schema(schema).parquet(f"{path}/postings").where(F.col("part").isin(folders) & F.col("field").isin(list(weights)))
    wanted = postings.join(small(asked.select("term").distinct()), "term", "left_semi")
    found = wanted.groupBy("field", "term").agg(F.count("*").alias("df"))  # one row for each field and asked term
    weight = F.create_map(*[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))])
    rarity = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = small(found.join(F.broadcast(sizes), "field").select("field", "term", "mean", (weight[F.col("field")] * rarity).alias("w")))
    asked = small(asked)
    tf = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    return wanted.join(terms, ["field", "term"]).join(asked, "term").groupBy("query", "key").agg(F.sum(F.col("w") * tf).alias("score"))
