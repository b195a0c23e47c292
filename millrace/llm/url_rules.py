"""Operator 11: URLs judged by rules given by hand and by rules mined from labels.

A URL is a set of tokens: the words of its host, path and query, each with the part it stands in; numbers are none. FP-growth over
the labelled URLs finds the token sets that go with bad labels often enough (support) and mostly (confidence). A rule that contains
another one's tokens adds nothing and goes. Where a URL has many tokens FP-growth would list all their subsets; the sets are then grown
level by level, of which only those are kept that can be part of such a smallest rule. The rules are indexed by their rarest token: a URL asks the index for its tokens and
compares what it finds with its whole set, and equal token sets ask once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import shuffle_width, stored
from millrace.llm.joins import attach, with_few

#: The item that stands for a bad label; tokens begin with a letter and a colon.
_BAD = "!bad"
_WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


@dataclass(frozen=True)
class HostRule:
    """A verdict on a host with its subdomains, for paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _lower(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and what follows from ``?`` or ``#`` on; all are empty for null and where ``://`` does not occur.

    The host is what stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, with A-Z in lower case.
    """
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host, path, rest = (F.regexp_extract(after, r"(?s)^([^/?#]*)([^?#]*)(.*)$", k) for k in (1, 2, 3))
    return _lower(host), path, rest


def tokens(host: Column, path: Column, rest: Column) -> Column:
    """The distinct tokens in order: h:word, p:word and q:word, of letters, digits and all beyond ASCII; numbers are left out."""

    def words(kind: str, part: Column) -> Column:
        found = F.regexp_extract_all(_lower(part), F.lit(_WORD), F.lit(1))
        return F.transform(F.filter(found, lambda w: ~w.rlike("^[0-9]+$")), lambda w: F.concat(F.lit(kind + ":"), w))

    return F.array_sort(F.array_distinct(F.concat(words("h", host), words("p", path), words("q", rest))))


def by_host(host: Column, path: Column, rules: Sequence[HostRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls. Rules are a short list of configuration."""
    fits, longest = [], sorted(rules, key=lambda r: (-len(r.name), r.name))
    for r in longest:
        fits.append(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)))
    return tuple(F.coalesce(*[F.when(fit, F.lit(v)) for fit, v in zip(fits, values)], F.lit(None).cast("string")) for values in ([r.name for r in longest], [r.verdict for r in longest]))


def _tokens_of(shape: str) -> Column:
    """A token set from its shape, the tokens joined by blanks, which no token holds."""
    return F.filter(F.split(shape, " "), lambda t: t != "")


def _matches(shapes: DataFrame, index: DataFrame) -> DataFrame:
    """shape, antecedent: the rules whose tokens a shape has all."""
    asked = shapes.select("shape", _tokens_of("shape").alias("has")).select("shape", "has", F.explode("has").alias("token"))
    return with_few(asked, index, "token").where(F.size(F.array_except("antecedent", "has")) == 0).select("shape", "antecedent")


def _grown(kept: DataFrame, total: int, floor: int, confidence: float) -> DataFrame:
    """antecedent, n_bad, confidence: the smallest rules over ``kept`` (shape, n, n_bad, items), level by level.

    A set goes on while it is no rule, has ``floor`` bad URLs, and each of its tokens makes it rarer: a set as frequent as one of its
    subsets has that one's confidence, and so has what holds either, so that no smallest rule holds it. All subsets of a set that goes on
    go on themselves. A shape's sets of one level meet by their common tokens; a level is a table.
    """
    sums = [F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")]
    is_rule = F.col("n_bad") / F.col("n") >= confidence
    holds = kept.select("shape", "n", "n_bad", F.lit("").alias("head"), F.explode("items").alias("last"))
    sets = stored(holds.groupBy("head", "last").agg(*sums).where(F.col("n_bad") >= floor))
    rules = sets.where(is_rule)
    sets = sets.where(~is_rule & (F.col("n") < total))
    name = F.concat_ws(" ", "head", "last")
    while sets.limit(2).count() > 1:
        holds = stored(with_few(holds, sets.select("head", "last"), ["head", "last"]))
        after = holds.select("shape", "head", F.col("last").alias("next"))
        pairs = holds.join(after, ["shape", "head"]).where(F.col("last") < F.col("next"))
        holds = pairs.select("shape", "n", "n_bad", F.ltrim(name).alias("head"), F.col("next").alias("last"))
        found = stored(holds.groupBy("head", "last").agg(*sums).where(F.col("n_bad") >= floor))
        tokens_of = _tokens_of(name)
        one_less = F.transform(tokens_of, lambda t: F.array_join(F.array_remove(tokens_of, t), " "))
        parts = found.select("head", "last", F.col("n").alias("of_all"), F.size(tokens_of).alias("size"), F.explode(one_less).alias("part"))
        known = sets.select(F.ltrim(name).alias("part"), F.col("n").alias("of_part"))
        free = with_few(parts, known, "part").where("of_part > of_all").groupBy("head", "last", "size").agg(F.count("*").alias("parts")).where("parts = size")
        sets = stored(found.join(free.select("head", "last"), ["head", "last"]))
        rules = rules.unionByName(sets.where(is_rule))
        sets = sets.where(~is_rule)
    return stored(rules.select(F.array_sort(_tokens_of(name)).alias("antecedent"), "n_bad", (F.col("n_bad") / F.col("n")).alias("confidence")))


def _by_growth(labelled: DataFrame, kept: DataFrame, count: int, floor: int, confidence: float) -> DataFrame:
    """antecedent, n_bad, confidence: the rules over ``kept`` by FP-growth."""
    spark = labelled.sparkSession
    rows = attach(labelled, kept.select("shape", "items"), "shape")
    rows = rows.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(_BAD)))).otherwise(F.col("items")).alias("items"))
    # half a row less than the floor, so that rounding cannot move it
    model = FPGrowth(itemsCol="items", minSupport=(floor - 0.5) / count, minConfidence=confidence, numPartitions=shuffle_width(spark)).fit(rows)
    rules = model.associationRules.where(F.element_at("consequent", 1) == _BAD)
    return rules.select(F.array_sort("antecedent").alias("antecedent"), F.round(F.col("support") * count).cast("long").alias("n_bad"), "confidence")


def mine(labelled: DataFrame, *, support: float, least: int, confidence: float, longest: int) -> DataFrame:
    """antecedent, n_bad, confidence, token: the rules, each under its rarest token.

    ``labelled`` has shape and bad. A rule's tokens occur together in at least ``least`` bad URLs and in at least a share ``support`` of
    all labelled ones, and of the URLs that have them at least a share ``confidence`` is bad. Tokens that are not in that many bad
    URLs are in no such rule and are left out before. FP-growth lists all subsets of what is left, 2**n of n tokens; so it is taken where
    no URL has more than ``longest`` of them, and else the sets are grown level by level, which finds the same smallest rules. Without
    labelled URLs there is no rule.
    """
    spark = labelled.sparkSession
    shapes = stored(labelled.groupBy("shape").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad")))
    total = shapes.agg(F.sum("n")).first()[0] or 0
    floor = max(least, math.ceil(support * total))
    each = shapes.select("shape", "n", "n_bad", F.explode(_tokens_of("shape")).alias("token"))
    known = stored(each.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")).where(F.col("n_bad") >= floor))
    kept = stored(with_few(each, known.select("token"), "token").groupBy("shape", "n", "n_bad").agg(F.collect_list("token").alias("items")))
    count, widest = kept.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max(F.size("items"))).first()
    schema = "antecedent array<string>, n_bad long, confidence double, token string"
    if not count:
        return spark.createDataFrame([], schema)
    rules = _by_growth(labelled, kept, count, floor, confidence) if widest <= longest else _grown(kept, total, floor, confidence)
    rules = rules.withColumn("shape", F.array_join("antecedent", " "))
    rarest = with_few(rules.select("shape", F.explode("antecedent").alias("token")), known.select("token", "n"), "token")
    rules = stored(rules.join(rarest.groupBy("shape").agg(F.min(F.struct("n", "token"))["token"].alias("token")), "shape"))
    inner = _matches(rules, rules.select("token", "antecedent")).where(F.array_join("antecedent", " ") != F.col("shape"))
    return rules.join(inner.select("shape").distinct(), "shape", "left_anti").select("antecedent", "n_bad", "confidence", "token")


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[HostRule], *, key: str = "page_id", url: str = "url", support: float = 0.002, least: int = 5, confidence: float = 0.5, longest: int = 16
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    ``labels`` has doc_id and bad; the page of a URL whose path ends in a number is made of the document of that number, which is how a
    page comes by its label (the number may be followed by a suffix or a slash). The longest of ``rules`` that fits decides; where none does, a page is
    blocked if a mined rule's tokens are all in its URL, and else allowed. A URL that is null or without ``://`` has an empty host and
    path, no token and is allowed. Null keys, repeated rows and repeated URLs are judged each; documents with several
    labels are bad if one of these is; null labels are not bad. Empty tables give no row and no mined rule; other columns are ignored.
    """
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"))
    host, path, rest = split_url(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), F.array_join(tokens(host, path, rest), " ").alias("shape"))
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:/|\.[^/]*)?$", 1)
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    numbered = rows.where(number != "").select("shape", number.cast("long").alias("doc_id"))
    mined = mine(attach(numbered, marks, "doc_id").select("shape", "bad"), support=support, least=least, confidence=confidence, longest=longest)
    blocked = _matches(rows.select("shape").distinct(), mined.select("token", "antecedent")).select("shape").distinct().withColumn("mined", F.lit(True))
    named, said = by_host(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(said, F.when(F.col("mined"), "block").otherwise("allow"))
    return attach(rows, blocked, "shape", "left").select("page_id", "host", "path", named.alias("rule"), verdict.alias("verdict"))
