import datetime
import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import exprs as X
from millrace.operators import aggregation, changes, enrichment, estimation, matching, scanning, text


def test_shard_is_md5_modulo(spark):
    keys = ["a", " a ", "", "Customer#1", "é☃", "x" * 500]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", X.md5_bucket(F.col("k"), 1000).alias("s")).collect()
    assert all(r.s == int(hashlib.md5(r.k.strip(" ").encode()).hexdigest(), 16) % 1000 for r in rows)


def test_messy_numbers(spark):
    raw = ["1,234", "null", "-5", "3.9", "", None, " 7 ", "1.2万"]
    rows = spark.createDataFrame([(r,) for r in raw], "r string").select(X.safe_int(F.col("r")).alias("i"), X.first_digits(F.col("r")).alias("d")).collect()
    assert [r.i for r in rows] == [1234, 0, 0, 3, 0, 0, 7, 0]
    assert [r.d for r in rows] == [1, None, 5, 3, None, None, 7, 1]


def test_composite_key_needs_both_parts(spark):
    rows = spark.createDataFrame([("a", "b"), ("", "b"), ("a", None), ("None", "b")], "x string, y string")
    assert [r.k for r in rows.select(X.composite_key(F.col("x"), F.col("y")).alias("k")).collect()] == ["a|b", None, None, None]


def test_tags(spark):
    raw = ['["b", "a", " b "]', "x, y ,x,,", "", None]
    rows = spark.createDataFrame([(r,) for r in raw], "r string").select(X.distinct_tags(F.col("r")).alias("t")).collect()
    assert [r.t for r in rows] == [["b", "a"], ["x", "y"], [], None]


def test_days_and_slices_cover_without_overlap(spark):
    start = datetime.datetime(2024, 1, 30, 22)
    df = spark.createDataFrame([(start + datetime.timedelta(hours=5 * i),) for i in range(20)], "ts timestamp")
    days = [r.day for r in scanning.days_between(df, "ts").orderBy("day").collect()]
    assert days[0] == datetime.date(2024, 1, 30) and all((b - a).days == 1 for a, b in zip(days, days[1:]))
    assert scanning.time_slices(df, "ts", 6).count() == 20
    assert scanning.days_between(df.limit(0), "ts").count() == 0


def test_retention_keeps_the_boundary(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, d),) for d in range(1, 11)], "ts timestamp")
    assert scanning.retain(df, "ts", 3).count() == 4


def test_upsert_is_idempotent_and_keeps_what_is_empty(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k long, p string, q string")
    new = spark.createDataFrame([(1, "", "y"), (3, "c", "z")], "k long, p string, q string")
    once = changes.upsert(old, new, "k")
    twice = changes.upsert(once, new, "k")
    assert sorted(map(tuple, once.collect())) == [(1, "a", "y"), (2, "b", None), (3, "c", "z")] == sorted(map(tuple, twice.collect()))


def test_history_is_capped(spark):
    df = spark.createDataFrame([(1, t, t, str(t // 2)) for t in range(40)], "k long, ts long, id long, v string")
    history = changes.capped_history(df, "k", "v", ["ts", "id"], 10).first().history
    assert [h.value for h in history] == [str(v) for v in range(10, 20)]


def test_wilson_bounds(spark):
    rows = estimation.wilson(spark.createDataFrame([(0, 0), (0, 5), (5, 5), (3, 10)], "k long, n long"), "k", "n").collect()
    assert (rows[0].low, rows[0].high) == (0.0, 0.0)
    assert all(0 <= r.low <= r.high <= 1 for r in rows) and rows[2].high == 1.0


def test_tolerant_json(spark):
    raw = ['{"k": 1}', 'so: {"k": 2} ok', '{"k": 3,}', "nothing", None]
    rows = matching.tolerant_json(spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i long, raw string"), "raw", "k long").collect()
    assert {r.i: r.parsed and r.parsed.k for r in rows} == {0: 1, 1: 2, 2: 3, 3: None, 4: None}


def test_common_substring():
    assert matching.longest_common_substring("abcdef", "zabcy") == 3
    assert matching.longest_common_substring("", "a") == 0


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=300), st.integers(2, 40))
def test_chunks_add_up(value, size):
    pieces = text.split_text(value, size)
    assert "".join(pieces) == value and all(0 < len(p) <= size for p in pieces)


def test_sentences_table_function(spark):
    spark.udtf.register("sentences", text.Sentences)
    rows = spark.sql("SELECT * FROM sentences('One. Two! Three')").collect()
    assert [r.sentence for r in rows] == ["One.", "Two!", "Three"]


def test_columns_with_the_names_of_helpers_stay(spark):
    t = datetime.datetime(2024, 1, 2)
    rows = [(1, "a", t, 1.0, "x", "y", "p"), (1, "a", t, 2.0, "x", "y", "p"), (2, None, None, None, None, None, None), (None, "", t - datetime.timedelta(days=9), 5.0, "x", "y", "p")]
    df = spark.createDataFrame(rows, "k int, f string, ts timestamp, value double, _newest string, _NEW string, _profile string")
    kept = scanning.retain(df, "ts", 3)
    assert kept.columns == df.columns and [(r.k, r["_newest"]) for r in kept.collect()] == [(1, "x"), (1, "x")]
    assert [tuple(r) for r in aggregation.trending(df, "f", "ts", "value", 24, 5).collect()] == [("a", 2, 3.0)]
    assert aggregation.trending(df.where("false"), "f", "ts", "value", 24, 5).count() == 0
    new = spark.createDataFrame([(1, "b", "z"), (2, "", "z"), (3, "c", "z"), (None, "c", "z")], "k int, f string, _f string")
    assert [tuple(r) for r in changes.field_changes(df, new, "k", ["f"]).collect()] == [(1, "f", "a", "b")] * 2
    filled = enrichment.fill_empty(df, new, "k", ["f"])
    assert filled.columns == df.columns and sorted(((r.k or 0, r.f, r["_profile"]) for r in filled.collect()), key=str) == [(0, None, "p"), (1, "a", "p"), (1, "a", "p"), (2, "", None)]


def test_history_of_nulls_and_ties(spark):
    rows = [(1, "a", 1), (1, None, 2), (1, "a", 3), (1, "a", 4), (1, "b", 5), (None, None, 1), (None, "c", 2)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "k int, v string, o int, _before string, _r string")
    out = {r.k: [(h.o, h.value) for h in r.history] for r in changes.capped_history(df, "k", "v", ["o"], 2).collect()}
    assert out == {1: [(3, "a"), (5, "b")], None: [(2, "c")]}
    assert changes.capped_history(df.where("false"), "k", "v", ["o"], 2).count() == 0


def test_pieces_of_a_batch_come_in_small_batches():
    texts = ["one two. " * 400, None, "", "x" * 2500, "a\n\nb " * 300] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["key", "text"])
    found = list(text._pieces(iter([batch]), 500, held=5000))
    assert max(sum(map(len, b["chunk_text"].to_pylist())) for b in found) <= 5000 + 3600 and len(found) > 10
    rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert rows == [(k, i, piece) for k, t in enumerate(texts) for i, piece in enumerate(text.split_text(t or "", 500), 1)]


def test_chunks_hold_small_arrow_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.createDataFrame([(1, "a b " * 300), (None, "c"), (2, None), (1, "")], "doc_id long, text string")
    found = text.chunks(df, "doc_id", "text", 500)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    want = [(k, i, p) for k, t in ((1, "a b " * 300), (None, "c")) for i, p in enumerate(text.split_text(t, 500), 1)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
