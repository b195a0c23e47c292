"""Keyword and rule matching. Word and rule lists are configuration: they are part of the plan, not tables of unknown size."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.automaton import dealt, text_bytes
from millrace.operators.joins import small


def any_of(text: str, words: Sequence[str]) -> Column:
    """Whether a text holds one of a short list of words; null for a null text. any_of_many() is for long lists."""
    return F.col(text).rlike("|".join(re.escape(w) for w in words))


def matched(text: str, words: Sequence[str]) -> Column:
    """The words that a text holds, in the order of the list; none for a null text."""
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words]))


def hits(text: str, words: Sequence[str]) -> Column:
    """How many of the words a text holds, each counted once; null for a null text."""
    total = F.lit(0)
    for w in words:
        total = total + F.contains(text, F.lit(w)).cast("int")
    return total


def fan_out(df: DataFrame, key: str, text: str, tasks: Iterable[tuple[str, str]]) -> DataFrame:
    """One row for each task (task, term) of which a text holds a term."""
    terms: dict[str, list[str]] = {}
    for task, term in tasks:
        terms.setdefault(task, []).append(term)
    routes = F.array_compact(F.array(*[F.when(hits(text, words) > 0, F.lit(task)) for task, words in terms.items()]))
    return df.select(key, F.explode(routes).alias("task"))


def blocked(df: DataFrame, key: str, fields: Sequence[str], categories: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """The blocked categories of each row, in order: those whose field holds one of their words, in lower case."""
    lowered = df.select(key, *[F.lower(f).alias(f) for f in fields])
    found = F.array_compact(F.array(*[F.when(hits(field, words) > 0, F.lit(name)) for name, (field, words) in categories.items()]))
    return lowered.select(key, F.array_join(F.array_distinct(found), ",").alias("blocked"))


def ordered_filter(df: DataFrame, value: str, steps: Sequence[tuple[Column, Column]]) -> DataFrame:
    """``df`` with passed: the outcome of the first step whose condition holds, else the value."""
    out = F.when(F.lit(False), F.lit(""))
    for condition, outcome in steps:
        out = out.when(condition, outcome)
    return df.withColumn("passed", out.otherwise(F.col(value)))


def gates(df: DataFrame, key: str, text: str, rules: Iterable[tuple[str, str, str, int]]) -> DataFrame:
    """key, category, reason, passed for every category of the rules (category, kind, term, priority).

    In order: a veto or reject term fails, so does the lack of a required one, so does an ambiguous term without a concrete one.
    """
    by: dict[str, dict[str, list[str]]] = {}
    for category, kind, term, _ in sorted(rules, key=lambda r: r[3]):
        by.setdefault(category, {}).setdefault(kind, []).append(term)
    verdicts = []
    for category, kinds in by.items():
        has = lambda kind, kinds=kinds: hits(text, kinds.get(kind, ())) > 0
        reason = F.when(has("veto"), "veto").when(has("reject"), "reject")
        if "require" in kinds:
            reason = reason.when(~has("require"), "require")
        reason = reason.when(has("ambiguous") & ~has("concrete"), "ambiguous")
        verdicts.append(F.struct(F.lit(category).alias("category"), reason.alias("reason")))
    rows = df.select(key, F.explode(F.array(*verdicts)).alias("v"))
    return rows.select(key, "v.category", "v.reason", F.isnull("v.reason").alias("passed"))


def normalised(text: Column) -> Column:
    """Lower case, with ideographs, ASCII letters, digits and # alone."""
    return F.lower(F.regexp_replace(text, r"[^0-9A-Za-z#一-鿿]", ""))


def _gram_hashes(texts: list[str | None], sizes: Sequence[int], wanted: np.ndarray | None) -> list[np.ndarray]:
    """Hashes of each text's distinct grams of the given sizes; only ``wanted`` ones, if that is not None."""
    points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    offs = np.cumsum([0, *(len(t or "") for t in texts)])
    doc = np.repeat(np.arange(len(texts)), np.diff(offs))
    found, owner = [], []
    for n in sizes:
        if len(points) < n:
            continue
        starts = len(points) - n + 1
        h = np.full(starts, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ points[k : k + starts]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = doc[:starts] == doc[n - 1 :]
        if wanted is not None:
            inside &= wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
        found.append(h[inside])
        owner.append(doc[:starts][inside])
    if not found:
        return [np.zeros(0, np.uint64)] * len(texts)
    pairs = np.unique(np.stack([np.concatenate(owner).astype(np.uint64), np.concatenate(found)], axis=1), axis=0)
    return np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, len(texts)).astype(np.uint64)))


def _grams(sizes: Sequence[int], wanted: np.ndarray | None):
    @F.pandas_udf("array<long>")
    def grams(texts: pd.Series) -> pd.Series:
        return pd.Series([h.view(np.int64).tolist() for h in _gram_hashes(texts.tolist(), sizes, wanted)])

    return grams


#: Distinct gram hashes of items that are sent along with the plan: 8 bytes each.
_WANTED = 1_000_000


def grounded(docs: DataFrame, evidence: DataFrame, head: int = 8) -> DataFrame:
    """item_id, grounded: in how many documents each item's normalised text stands; items that stand in none have no row.

    Items of up to 8 MB are found all at once by an automaton, in one pass over the texts. Of more, items and documents meet on the hash of an item's first ``head`` characters (of fewer, if it has no more) and are then checked in full; nothing
    is compared pairwise. Where items have up to a million distinct heads, documents look them up while they are read, and only hits
    leave the scan; beyond that all of a text's gram hashes are joined. Null and empty items and texts match nothing; repeated
    documents count each, repeated items add up under their id.
    """
    items = evidence.select("item_id", normalised(F.col("text")).alias("e")).where("e <> ''").withColumn("n", F.least(F.length("e"), F.lit(head)))
    texts = docs.select(normalised(F.col("text")).alias("t"))
    if (items.agg(F.sum(F.octet_length("e"))).first()[0] or 0) <= _LIST_BYTES:
        standing = listed(texts.select(F.lit(0).alias("one"), "t"), "one", "t", items, "e").groupBy("word").agg(F.count("*").alias("n"))
        return items.select("item_id", "e").join(standing, F.col("e") == F.col("word")).groupBy("item_id").agg(F.sum("n").alias("grounded"))
    sizes = sorted(r[0] for r in items.select("n").distinct().collect())  # at most ``head`` numbers
    of_head = lambda n: F.get(_grams([n], None)(F.substring("e", 1, n)), F.lit(0))
    key = F.coalesce(*[F.when(F.col("n") == n, of_head(n)) for n in sizes]) if sizes else F.lit(None).cast("long")
    items = items.withColumn("g", key).select("item_id", "e", "g")
    heads = items.select("g").distinct()
    few = heads.limit(_WANTED + 1).count() <= _WANTED
    wanted = np.sort(np.array([r[0] for r in heads.collect()], dtype=np.int64).view(np.uint64)) if few else None
    if not sizes:
        return items.groupBy("item_id").agg(F.count("*").alias("grounded"))
    hits = texts.select("t", _grams(sizes, wanted)("t").alias("hits")).where(F.size("hits") > 0)
    found = hits.select("t", F.explode("hits").alias("g")).join(small(items), "g").where(F.contains("t", F.col("e")))
    return found.groupBy("item_id").agg(F.count("*").alias("grounded"))


def grounded_in(source: Column, evidence: Column, least: int = 4) -> Column:
    """Whether an evidence is grounded in its own source: both normalised, contained in it, or with ``least`` characters in a row in common.

    An empty or null evidence is not grounded. A common run of ``least`` characters is a common gram of that size, so texts are not
    compared place by place.
    """
    s, e = F.coalesce(normalised(source), F.lit("")), F.coalesce(normalised(evidence), F.lit(""))
    grams = lambda t: F.regexp_extract_all(t, F.lit(f"(?=(.{{{least}}}))"), F.lit(1))
    return (e != "") & (F.contains(s, e) | F.coalesce(F.arrays_overlap(grams(e), grams(s)), F.lit(False)))


#: Bytes of a word list that tasks may look through at once; longer lists are dealt over several passes.
_LIST_BYTES = 8 << 20

_automata: dict[str, list] = {}


def _automata_of(name: str, words: Sequence[str]) -> list:
    """The automata of a list, built once in each Python worker; only the last list's are kept."""
    if name not in _automata:
        _automata.clear()
        _automata[name] = list(dealt(words))
    return _automata[name]


def _finder(words: Sequence[str], most_bytes: int = 1 << 22):
    name = uuid.uuid4().hex

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        machines, offsets, values = _automata_of(name, words), [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
        i, n = 0, len(texts)
        while i < n:  # as many texts at a time as fit into ``most_bytes``, and one at least
            data, offs = text_bytes(texts.slice(i))
            j = max(1, int(np.searchsorted(offs, most_bytes, "right")) - 1)
            pairs = [(owner, first + word) for first, m in machines for owner, word in [m.find(data[: offs[j]], offs[: j + 1])]]
            owner, word = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, np.int64)]) for k in (0, 1))
            order = np.lexsort((word, owner))
            values.append(word[order])
            offsets.append(offsets[-1][-1] + np.searchsorted(owner[order], np.arange(1, j + 1)))
            i += j
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(words, pa.string()).take(pa.array(np.concatenate(values))))

    return found


def listed(df: DataFrame, key: str, text: str, words: DataFrame, word: str) -> DataFrame:
    """key, word: the words of a list of any length that each text holds, each once; words may be of any script and hold blanks.

    The list is part of the plan, 8 MB of it at a time, as an automaton that tasks build once and walk over their texts; a longer
    list takes a pass over the texts for every 8 MB. Upper and lower case differ, as do repeated rows, which are searched each; null texts and
    null or empty words match nothing. An empty table or list gives no row and extra columns are ignored.
    """
    rows = words.select(F.col(word).alias("word")).where("word <> ''").distinct()
    parts, size = [[]], 0
    for batch in rows.toArrow().to_batches():  # the list is part of the plan, so the driver holds it
        for w in batch["word"].to_pylist():
            if size > _LIST_BYTES:
                parts.append([])
                size = 0
            parts[-1].append(w)
            size += len(w.encode())
    passes = [df.select(F.col(key).alias("_key"), F.explode(_finder(part)(F.col(text))).alias("word")) for part in parts]
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("_key", key)


def any_of_many(df: DataFrame, key: str, text: str, words: DataFrame, word: str) -> DataFrame:
    """The keys whose text has one of the words, for lists of any length: tokens are joined with the list, not tried one by one.

    Tokens are runs of ASCII letters in lower case, as the words must be. A key comes once; null texts and words match nothing.
    """
    tokens = df.select(key, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0)))).alias("_token"))
    listed = words.select(F.col(word).alias("_token")).where("_token <> ''").distinct()
    return tokens.join(small(listed), "_token", "left_semi").select(key).distinct()


class SuffixAutomaton:
    """All substrings of a text in at most twice as many states as it has characters."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in text:
            state = self._state({}, self.length[last] + 1)
            at = last
            while at >= 0 and c not in self.next[at]:
                self.next[at][c] = state
                at = self.link[at]
            self.link[state] = 0 if at < 0 else self._split(at, c)
            last = state

    def _state(self, follows: dict[str, int], length: int) -> int:
        self.next.append(follows)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, c: str) -> int:
        """The state of the longest suffix that ends at ``at`` and goes on with ``c``, which gets one of its own if it shares one with longer ones."""
        old = self.next[at][c]
        if self.length[old] == self.length[at] + 1:
            return old
        own = self._state(dict(self.next[old]), self.length[at] + 1)
        self.link[own], self.link[old] = self.link[old], own
        while at >= 0 and self.next[at].get(c) == old:
            self.next[at][c] = own
            at = self.link[at]
        return own

    def longest_in(self, source: str) -> int:
        """Length of the longest run of ``source`` that stands in the text; each character is read once."""
        best = state = size = 0
        for c in source:
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.next[state]:
                state, size = self.next[state][c], size + 1
                best = max(best, size)
        return best


def longest_common_substring(a: str, b: str) -> int:
    short, long = sorted((a, b), key=len)
    return SuffixAutomaton(short).longest_in(long)


@F.pandas_udf(T.IntegerType())
def common_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common substring of two texts of any length, in characters; 0 for a null or empty one."""
    return pd.Series([0 if x is None or y is None else longest_common_substring(x, y) for x, y in zip(a, b)])


@F.pandas_udf(T.StringType())
def _mended(raw: pd.Series) -> pd.Series:
    def mend(text):
        span = re.search(r"\{.*\}|\[.*\]", text or "", re.S)
        if not span:
            return None
        fixed = re.sub(r",\s*([}\]])", r"\1", span[0])
        try:
            json.loads(fixed)
        except ValueError:
            return None
        return fixed

    return raw.map(mend)


def tolerant_json(df: DataFrame, raw: str, schema: str) -> DataFrame:
    """``df`` with parsed: the text as JSON, else its outermost braces, else those without trailing commas.

    Only what both built-in steps leave unparsed goes through Python.
    """
    plain = F.from_json(raw, schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})
    span = F.regexp_extract(raw, r"(?s)(\{.*\})", 1)
    inner = F.from_json(span, schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})
    first = df.withColumn("_1", plain).withColumn("_2", inner)
    good = first.withColumn("_ok", F.when(F.isnull("_1._bad") & F.col("_1").isNotNull(), F.col("_1")).when(F.isnull("_2._bad") & F.col("_2").isNotNull(), F.col("_2")))
    names = [x.strip().split()[0] for x in schema.split(",")]
    shape = lambda c: F.struct(*[F.col(f"{c}.{n}").alias(n) for n in names])
    done = good.where("_ok IS NOT NULL").select(*df.columns, shape("_ok").alias("parsed"))
    rest = good.where("_ok IS NULL").withColumn("_3", F.from_json(_mended(F.col(raw)), schema))
    return done.unionByName(rest.select(*df.columns, F.when(F.col("_3").isNotNull(), shape("_3")).alias("parsed")))
