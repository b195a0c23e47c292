"""Sketches, interval joins, relevance, values without a schema and counts on the way, against plain versions."""

import collections
import datetime
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import intervals, relevance, scanning, sketches, variants
from millrace.sources.tables import scratch, table
from tests.oracle import DATA


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sketches_of_every_range_are_near(spark):
    r = random.Random(3)
    day = lambda k: datetime.date(2024, 1, 1) + datetime.timedelta(days=k)
    rows = [(k, "a" if r.random() < 0.9 else None, f"u{r.randrange(6000)}") for k in range(8) for _ in range(3000)]
    df = spark.createDataFrame([(day(k), kind, u) for k, kind, u in rows] + [(day(0), "a", None), (None, "a", "x")], "d date, kind string, u string")
    path = scratch(spark, "sketches")
    sketches.store(sketches.day_sketches(df, ["kind"], F.col("d"), F.col("u")), path)
    for i in range(8):
        for j in range(i, 8):
            exact = collections.defaultdict(set)
            for k, kind, u in rows:
                if i <= k <= j:
                    exact[kind].add(u)
            found = {x.kind: x.entities for x in sketches.united(spark, path, ["kind"], day(i), day(j)).collect()}
            assert found.keys() == exact.keys()
            assert all(abs(found[k] - len(exact[k])) <= 1 + 4 * sketches.STANDARD_ERROR * len(exact[k]) for k in exact)


def test_a_day_done_anew_replaces_itself(spark):
    path, d1, d2 = scratch(spark, "sketches"), datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    make = lambda rows: sketches.day_sketches(spark.createDataFrame(rows, "k int, d date, u string"), ["k"], F.col("d"), F.col("u"))
    sketches.store(make([(1, d1, "a"), (1, d2, "b")]), path)
    sketches.store(make([(1, d2, "c"), (1, d2, "a")]), path)
    assert [r.entities for r in sketches.united(spark, path, ["k"], d1, d2).collect()] == [2]
    assert [r.entities for r in sketches.united(spark, path, ["k"], d1, d1).collect()] == [1]
    assert [(r.day, r.entities) for r in sketches.trailing(spark.read.parquet(path), ["k"], 2).orderBy("day").collect()] == [(d1, 1), (d2, 2)]
    assert sketches.trailing(make([]), ["k"], 3).count() == 0


@pytest.mark.parametrize("broadcast,bin_rows", [(True, 100), (False, 7), (None, 100)])
def test_intervals_equal_the_plain_join(spark, broadcast, bin_rows):
    r = random.Random(5)
    values = [("a", r.choice([r.uniform(-50, 50), 3.0, 0.0, -8.0])) for _ in range(300)] + [("b", 1e9), ("b", -1e-9), (None, 1.0), ("a", None), ("a", float("nan")), ("c", 1.0)]
    ends = [None, -8.0, 0.0, 3.0, 3.5, 50.0, 1e-7, 2e9]
    bands = [(r.choice("ab"), r.choice(ends), r.choice(ends), k) for k in range(120)] + [("a", 3.0, 3.0, 900), (None, 0.0, 9.0, 901), ("b", None, None, 902), ("a", 0.0, 4.0, 903), ("a", 0.0, 4.0, 903)]
    df = spark.createDataFrame([(c, v, "x") for c, v in values], "_level string, v double, label string")
    out = intervals.in_intervals(df, "_level", "v", spark.createDataFrame(bands, "category string, low double, high double, label int"), bin_rows=bin_rows, broadcast=broadcast)
    good = [(c, v) for c, v in values if c is not None and v is not None and v == v]
    want = [(c, v, k) for c, v in good for b, lo, hi, k in bands if b == c and (lo is None or lo <= v) and (hi is None or v < hi) and (lo is None or hi is None or lo < hi)]
    assert out.columns == ["_level", "v", "label"]
    assert rows_of(out) == sorted(want, key=repr)


def test_intervals_of_empty_tables(spark):
    df, bands = spark.createDataFrame([], "c string, v double"), spark.createDataFrame([("a", 0.0, 1.0, 1)], "category string, low double, high double, label int")
    assert intervals.in_intervals(df, "c", "v", bands).count() == 0
    assert intervals.in_intervals(spark.createDataFrame([("a", 0.5)], df.schema), "c", "v", bands.where("false")).count() == 0


def test_relevance_equals_the_formula(spark):
    r = random.Random(7)
    words = ["Red", "red", "blue", "x1", "green", "über"]
    docs = [(k, " ".join(r.choice(words) for _ in range(r.randrange(12))), r.choice(["red", "", None, "blue x1"])) for k in range(60)]
    docs += [(7, "red blue", "red"), (None, "red", "red"), (100, None, None), (101, "", "   ")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "k long, a string, b string, term int")
    path = scratch(spark, "index")
    relevance.build(df, "k", ["a", "b"], path, parts=4)
    found = {(x.query, x.key): x.score for x in relevance.search(spark, path, {"q": "RED red Blue", "none": "zzz"}, {"a": 1.0, "b": 3.0, "c": 1.0}, parts=4).collect()}
    want = collections.defaultdict(float)
    for at, weight in ((1, 1.0), (2, 3.0)):
        lists = [(d[0], [t.lower() for t in re.findall("[0-9A-Za-z]+", d[at] or "")]) for d in docs if d[0] is not None]
        lists = [(k, t) for k, t in lists if t]
        mean = sum(len(t) for _, t in lists) / len(lists)
        for term in ("red", "blue"):
            n = sum(term in t for _, t in lists)
            for k, t in lists:
                if tf := t.count(term):
                    want["q", k] += weight * math.log(1 + (len(lists) - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_search_reads_the_folders_of_its_terms(spark):
    path = scratch(spark, "index")
    relevance.build(spark.createDataFrame([(k, f"w{k}") for k in range(200)], "k int, t string"), "k", ["t"], path, parts=16)
    out = relevance.search(spark, path, {"q": "w5"}, {"t": 1.0}, parts=16)
    assert [r.key for r in out.collect()] == [5] and {f.split("/part=")[1].split("/")[0] for f in out.inputFiles() if "/part=" in f} != set()
    scan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(part" in scan or "PartitionFilters: [part" in scan or "PartitionFilters: [isnotnull(part" in scan
    empty = scratch(spark, "index")
    relevance.build(spark.createDataFrame([], "k int, t string"), "k", ["t"], empty)
    assert relevance.search(spark, empty, {"q": "w5"}, {"t": 1.0}).count() == 0


SHAPES = ['{"k":1,"u":{"id":5,"b":{"c":true}}}', "[1,2]", "7", "bad{", None, "", '{"k":null,"e":{}}', '{"k":1.5,"a b":"x"}', '{"k":3,"u":"flat"}', '{"d.e":1,"d":{"e":2},"q\'s":2,"id":"4"}']


def plain_leaves(value, depth, names=()):
    if isinstance(value, dict) and len(names) < depth:
        for n, v in value.items():
            yield from plain_leaves(v, depth, (*names, n.replace(".", "\\.")))
    elif value is not None and value != {}:
        text = json.dumps(value, separators=(",", ":"), sort_keys=True) if isinstance(value, (dict, list, bool)) else str(value)
        yield ".".join(names), text


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_leaves_equal_a_plain_walk(spark, depth):
    df = spark.createDataFrame([(k, s, "x") for k, s in enumerate(SHAPES)], "id int, j string, steps string")
    want = []
    for k, s in enumerate(SHAPES):
        try:
            want += [(k, *x) for x in plain_leaves(json.loads(s or ""), depth)]
        except ValueError:
            pass
    assert rows_of(variants.leaves(df, "id", "j", depth).select("id", "path", "value")) == sorted(want, key=repr)


def test_shapes_make_one_table(spark):
    df = spark.createDataFrame(list(enumerate(SHAPES)), "id int, j string")
    out = variants.one_table(df, "id", "j")
    assert dict(out.dtypes) == {"id": "int", "": "string", "k": "double", "u": "string", "u.id": "bigint", "u.b.c": "boolean", "a b": "string", "d\\.e": "bigint", "d.e": "bigint", "q's": "bigint", "id_": "string"}
    rows = {r["id"]: {c: v for c, v in r.asDict().items() if v is not None and c != "id"} for r in out.collect()}
    assert rows[0] == {"k": 1.0, "u.id": 5, "u.b.c": True} and rows[8] == {"k": 3.0, "u": "flat"} and rows[1] == {"": "[1,2]"}
    assert rows[9] == {"d\\.e": 1, "d.e": 2, "q's": 2, "id_": "4"} and rows[3] == rows[4] == rows[5] == rows[6] == {}
    with pytest.raises(ValueError, match="10 paths"):
        variants.one_table(df, "id", "j", most_columns=3)
    assert variants.one_table(df.where("false"), "id", "j").columns == ["id"]


def test_counts_are_taken_in_the_pass_that_writes(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "bcd")], "k int, t string")
    path = scratch(spark, "used")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or [])
    counts = scanning.written_with_counts(df, path, {"n": F.count("*")}, F.col("t") != "", {"left": F.count("*"), "chars": F.sum(F.length("t"))})
    assert counts == {"n": 4, "left": 2, "chars": 4}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before + 1
    assert rows_of(spark.read.parquet(path)) == [(1, "a"), (4, "bcd")]
    assert scanning.written_with_counts(df.where("false"), scratch(spark, "used"), {"n": F.count("*")}, F.col("t") != "", {"m": F.count("*")}) == {"n": 0, "m": 0}


def test_postings_count_every_token(spark):
    docs, path = table(spark, DATA, "documents"), scratch(spark, "index")
    relevance.build(docs, "doc_id", ["text"], path)
    found = spark.read.parquet(f"{path}/postings").agg(F.sum("tf"), F.countDistinct("key")).first()
    texts = [re.findall("[0-9A-Za-z]+", r.text or "") for r in docs.select("text").collect()]
    assert tuple(found) == (sum(map(len, texts)), sum(map(bool, texts)))


def test_postings_do_not_carry_the_tokens_of_their_text(spark):
    df = spark.createDataFrame([(1, "b A a"), (2, None), (None, "c")], "k int, t string")
    out = relevance.postings(df, "k", ["t"], parts=4)
    assert rows_of(out.drop("part")) == [("t", "a", 1, 2, 3), ("t", "b", 1, 1, 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    generate = next(line for line in plan.split("\n") if "Generate explode" in line)
    assert re.search(r"\[key#\d+, length#\d+\], false, \[p#\d+\]$", generate.strip()) and plan.count("array_sort") == 1
