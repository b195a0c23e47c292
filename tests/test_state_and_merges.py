import datetime
import os
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.operators import automaton, changes, folds, matching, scanning
from millrace.streaming import jobs, merges, state

T0 = datetime.datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp, user_id long, event_type string"


def events(n=300, seed=3, users=20):
    rng = random.Random(seed)
    rows = [(i, T0 + datetime.timedelta(microseconds=rng.randrange(40_000 * 10**6)), rng.randrange(users), rng.choice("abc")) for i in range(n)]
    return rows + [(1000, None, 1, "a"), (1001, T0, None, "a"), (1002, T0, None, "a"), (1003, rows[0][1], rows[0][2], None)]


def spool(spark, rows, path):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("cuts", [[304], [40, 41, 304]])
def test_keyed_state_is_that_of_the_fold_for_any_cut(spark, tmp_path, cuts):
    rows, source, out = events(), f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    random.Random(9).shuffle(rows)
    begin, found = 0, None
    for end in cuts:  # a run for each, which goes on from the state of the one before
        spool(spark, rows[begin:end], source)
        begin = end
        for name, kind in (("expiring", state.expiring_first), ("buffers", state.buffers)):
            more = (["user_id"], "ts", "event_id", 3000) if name == "expiring" else (["user_id"], "ts", "event_id", "event_type", 3, 5000)
            found = (found or {}) | {name: kind(spark, source, *more, f"{out}/{name}", delay="2 days", files=1, complete=end == cuts[-1])}
    df = spark.createDataFrame(rows, EVENTS)
    want = folds.expiring_first(df.select("ts", "user_id", "event_id"), ["user_id"], "ts", "event_id", 3000)
    assert sorted(map(tuple, found["expiring"].collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    want = folds.buffers(df, ["user_id"], "ts", "event_id", "event_type", 3, 5000).collect()
    assert sorted(map(tuple, found["buffers"].collect())) == sorted(map(tuple, want)) and {r.reason for r in want} == {"size", "time"} and any(r.dropped for r in want)


def test_a_timer_flushes_a_buffer_to_which_no_row_comes(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    spool(spark, [(1, T0, 1, "a"), (2, T0 + datetime.timedelta(seconds=5), 1, "b")], source)
    args = (["user_id"], "ts", "event_id", "event_type", 9, 60, out)
    assert state.buffers(spark, source, *args, delay="10 seconds").count() == 0
    spool(spark, [(3, T0 + datetime.timedelta(seconds=100), 2, "a")], source)
    assert [tuple(r) for r in state.buffers(spark, source, *args, delay="10 seconds").collect()] == [(1, T0, 1, 2, 0, "time")]
    spool(spark, [(4, T0 + datetime.timedelta(seconds=50), 1, "a")], source)  # behind the watermark
    assert state.buffers(spark, source, *args, delay="10 seconds", complete=True).count() == 2


def test_buffers_against_a_plain_one(spark):
    rows = events(200, 5, 3)
    want = []
    for u in range(3):
        held, dropped = [], 0
        for i, t, _, k in sorted((r for r in rows if r[2] == u and r[1] is not None), key=lambda r: (r[1], r[0])):
            if held and t - held[0][1] >= datetime.timedelta(seconds=900):
                want.append((u, held[0][1], held[0][0], len(held), dropped, "time"))
                held = []
            if k in [h[2] for h in held]:
                dropped += 1
                continue
            dropped = dropped if held else 0
            held.append((i, t, k))
            if len(held) == 3:
                want.append((u, held[0][1], held[0][0], 3, dropped, "size"))
                held = []
        if held:
            want.append((u, held[0][1], held[0][0], len(held), dropped, "time"))
    df = spark.createDataFrame(rows, EVENTS).withColumn("n", F.lit("x")).repartition(3)
    assert sorted(map(tuple, folds.buffers(df, ["user_id"], "ts", "event_id", "event_type", 3, 900).collect())) == sorted(want)
    assert folds.buffers(df.limit(0), ["user_id"], "ts", "event_id", "event_type", 3, 900).count() == 0


@pytest.mark.parametrize("expected", [1, 100_000])
def test_known_keys_are_looked_up_in_their_parts_only(spark, tmp_path, expected):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    rng, seen = random.Random(2), set()
    for turn in range(3):
        rows = [(k, T0, rng.choice([None, rng.randrange(200)]), rng.choice(["a", "b", None, f"t{turn}"])) for k in range(150)]
        seen |= {(r[2], r[3]) for r in rows}
        spool(spark, rows, source)
        found = jobs.stream_distinct(spark, source, ["user_id", "event_type"], out, parts=5, expected=expected, files=1).collect()
        assert len(found) == len(seen) and {tuple(r) for r in found} == seen
    schema = spark.read.schema("user_id long, event_type string, batch int, _part int").parquet(f"{out}/rows").schema
    files = jobs._keys_of(spark, out, schema, [1, 4]).inputFiles()
    assert len(files) == 6 and all("_part=1/" in f or "_part=4/" in f for f in files)  # of 15
    assert jobs._keys_of(spark, out, schema, []).inputFiles() == []
    filters = spark.read.parquet(f"{out}/filters/batch=2")
    assert sorted(r.part for r in filters.collect()) == list(range(5))
    # new keys are told without a look at the known ones
    new = jobs._hashed(spark.range(5000).select((F.col("id") + 10**6).alias("user_id"), F.lit("z").alias("event_type")), ["user_id", "event_type"], 5, max(1, -(-expected * 10 // (32768 * 5))))
    bloom = spark.read.schema("_block int, bitmap binary, batch int, _part int").parquet(f"{out}/bloom").where("batch = 2").drop("batch")
    assert new.join(bloom, ["_part", "_block"]).where(jobs._all_set("bitmap", "_bits")).count() < 50


def test_windows_close_as_under_sparks_watermark_and_late_rows_are_kept(spark, tmp_path):
    rng = random.Random(4)
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for k in range(4):
        rows = [(k * 100 + i, T0 + datetime.timedelta(seconds=k * 9000 + rng.randrange(12_000) - (20_000 if i % 10 == 0 else 0)), 1, rng.choice(["a", "b", None])) for i in range(100)]
        spool(spark, [*rows, (k, None, 1, "a")], source)
        if k == 1:
            jobs.closed_windows(spark, source, "ts", ["event_type"], "1 hour", "30 minutes", out, files=1)
        native = jobs.events(spark, source, 1).withWatermark("ts", "30 minutes").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
        native = jobs.run(native.select(F.col("w.start").alias("start"), "event_type", "n"), out=f"file://{tmp_path}/native")  # its watermark moves after each file
    closed = jobs.closed_windows(spark, source, "ts", ["event_type"], "1 hour", "30 minutes", out, files=1)
    assert sorted(map(tuple, closed.collect()), key=str) == sorted(map(tuple, native.collect()), key=str) and closed.count()
    late = spark.read.parquet(f"{out}/late")
    every = jobs.closed_windows(spark, source, "ts", ["event_type"], "1 hour", "30 minutes", out, files=1, complete=True)
    assert late.count() > 5 and late.count() + every.agg(F.sum("n")).first()[0] == 400


def test_what_a_real_sink_raises_is_tried_again(spark, tmp_path):
    source, blocked, calls = f"file://{tmp_path}/in", tmp_path / "file", []
    spool(spark, events(), source)
    blocked.write_text("no folder")

    def save(rows, path):
        calls.append(path)
        jobs._save(rows, f"file://{blocked}/below" if len(calls) < 3 else path)

    out = jobs.shard_writes(spark, source, "user_id", 2, f"file://{tmp_path}/x", save=save, wait=0.01).collect()
    assert len(calls) == 3 and sum(r.written for r in out) == 304 and {r.attempts for r in out} == {3}
    out = jobs.shard_writes(spark, source, "user_id", 2, f"file://{tmp_path}/y", save=lambda r, p: jobs._save(r, f"file://{blocked}/below"), attempts=2, wait=0.01).collect()
    assert sum(r.failed for r in out) == 304 and sum(r.written for r in out) == 0
    assert spark.read.parquet(f"file://{tmp_path}/y/failed").count() == 304


def test_streams_over_a_folder_without_rows(spark, tmp_path):
    source, base = f"file://{tmp_path}/in", f"file://{tmp_path}/o"
    spark.createDataFrame([], EVENTS).write.parquet(source)
    assert jobs.stream_distinct(spark, source, ["user_id"], f"{base}1").count() == 0
    assert jobs.micro_batches(spark, source, ["event_id"], f"{base}2").count() == 0
    assert jobs.shard_writes(spark, source, "user_id", 2, f"{base}3").count() == 0
    assert jobs.hour_windows(spark, source, f"{base}4").count() == 0
    assert jobs.closed_windows(spark, source, "ts", [], "1 hour", "1 hour", f"{base}5", complete=True).count() == 0
    assert jobs.routed(spark, source, "event_type", [("t", "a")], f"{base}6").count() == 0
    assert state.expiring_first(spark, source, ["user_id"], "ts", "event_id", 9, f"{base}7", complete=True).count() == 0
    assert state.buffers(spark, source, ["user_id"], "ts", "event_id", "event_type", 2, 9, f"{base}8", complete=True).count() == 0


def test_routing_and_decoding_go_on_where_they_ended(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for turn in (1, 2):
        spool(spark, [(turn, T0, 1, "a"), (turn + 10, T0, 1, None)], source)
        assert jobs.routed(spark, source, "event_type", [("t", "a")], f"{out}/r").count() == turn
        spark.createDataFrame([('{"k": 1}',), ("{",)], "value string").write.mode("append").text(f"{source}-lines")
        assert jobs.decoded(spark, f"{source}-lines", "k long", ["k"], f"{out}/d").count() == turn


def data_files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_a_merge_touches_the_buckets_of_its_keys_only(spark, tmp_path):
    target, folder = f"file://{tmp_path}/t", str(tmp_path / "t")
    old = spark.createDataFrame([(k, f"p{k}", "q") for k in range(200)] + [(None, "n", "n")], "k long, p string, q string")
    merges.create(old, target, "k", 8)
    before = data_files(folder)
    updates = spark.createDataFrame([(3, "new", "", 1), (3, "newer", None, 2), (1000, "in", "", 1), (None, "x", "x", 1)], "k long, p string, q string, at long")
    counts = merges.merge(spark, target, updates, "k", 8, f"file://{tmp_path}/aside", "at")
    assert {r.action: r.n for r in counts.collect()} == {"update": 1, "insert": 1}
    after = data_files(folder)
    buckets = lambda files: {f.split("_bucket=")[1].split("/")[0] for f in files}
    assert len(buckets(before - after)) <= 2 and len(before & after) >= 6
    want = sorted(map(tuple, changes.upsert(old, updates, "k", "at").collect()), key=str)
    assert sorted(map(tuple, merges.read(spark, target).collect()), key=str) == want
    # interrupted when a bucket had been removed: the merge is repeated from what lies aside
    for f in after - before:
        os.remove(f)
    merges.merge(spark, target, updates, "k", 8, f"file://{tmp_path}/aside", "at")
    assert sorted(map(tuple, merges.read(spark, target).collect()), key=str) == want
    now = data_files(folder)
    assert merges.merge(spark, target, updates.limit(0), "k", 8, f"file://{tmp_path}/none").count() == 0 and data_files(folder) == now


def test_a_stream_of_merges_counts_each_batch_once(spark, tmp_path):
    target, source, out = f"file://{tmp_path}/t", f"file://{tmp_path}/u", f"file://{tmp_path}/o"
    merges.create(spark.createDataFrame([(1, "a")], "k long, p string"), target, "k", 4)
    for rows, want in (([(1, "b"), (2, "c")], {"update": 1, "insert": 1}), ([(2, "d"), (3, "")], {"update": 2, "insert": 2})):
        spark.createDataFrame(rows, "k long, p string").coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            assert {r.action: r.n for r in merges.merge_stream(spark, source, target, "k", 4, out).collect()} == want
    assert sorted(map(tuple, merges.read(spark, target).collect())) == [(1, "b"), (2, "d"), (3, None)]


LETTERS = "abé漢 字"


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet=LETTERS, min_size=1, max_size=6), min_size=1, max_size=25), st.lists(st.one_of(st.none(), st.text(alphabet=LETTERS + "c", max_size=60)), max_size=8), st.sampled_from([4, 512]), st.sampled_from([60, 1 << 20]))
def test_the_automaton_finds_what_contains_finds(words, texts, lane, cells):
    words, kept = sorted(words), (automaton._LANE, automaton._CELLS)
    automaton._LANE, automaton._CELLS = lane, cells
    try:
        found = [(int(t), words[first + int(w)]) for first, m in automaton.dealt(words) for t, w in zip(*m.find(*automaton.text_bytes(pa.array(texts, pa.string()))))]
    finally:
        automaton._LANE, automaton._CELLS = kept
    assert sorted(found) == sorted((k, w) for k, t in enumerate(texts) for w in words if t and w in t)


@pytest.mark.parametrize("limit", [8 << 20, 10])
def test_word_lists_of_any_script(spark, monkeypatch, limit):
    monkeypatch.setattr(matching, "_LIST_BYTES", limit)
    texts = ["漢字 と かな", "red, GREEN", None, "", "redder red" * 3000, "漢字 と かな", "🎉 red"]
    words = ["漢字 と", "red", "Red", "d r", "🎉", "", None, "red", "かな", "字 と か"]
    docs = spark.createDataFrame([(k if k else None, t, 0) for k, t in enumerate(texts)], "doc_id long, t string, word int").repartition(3)
    out = matching.listed(docs, "doc_id", "t", spark.createDataFrame([(w,) for w in words], "w string"), "w").collect()
    assert sorted(map(tuple, out), key=str) == sorted([(k if k else None, w) for k, t in enumerate(texts) for w in {w for w in words if w} if t and w in t], key=str)
    assert matching.listed(docs, "doc_id", "t", spark.createDataFrame([], "w string"), "w").count() == 0
    assert matching.listed(docs.limit(0), "doc_id", "t", spark.createDataFrame([("a",)], "w string"), "w").count() == 0


def plain_common(a, b):
    return next((n for n in range(min(len(a), len(b)), 0, -1) if {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)}), 0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab漢", max_size=30), st.text(alphabet="ab漢c", max_size=30))
def test_longest_common_substring(a, b):
    assert matching.longest_common_substring(a, b) == plain_common(a, b)


def test_longest_common_substring_of_whole_documents(spark):
    rng = random.Random(1)
    a, b = ("".join(rng.choices("abcd ", k=60_000)) for _ in range(2))
    rows = spark.createDataFrame([(a + "x" * 500 + b, b[:100] + "x" * 400 + a), (None, "a"), ("a", ""), ("ab", "ba")], "a string, b string")
    assert [r.n for r in rows.select(matching.common_length("a", "b").alias("n")).collect()] == [60_000, 0, 0, 1]


def test_pages_of_one_hot_and_one_far_off_key(spark):
    df = spark.createDataFrame([(5, "x", 1, 2, 3, 4)] * 900 + [(10**15, "x", 1, 2, 3, 4), (None, "x", 1, 2, 3, 4), (1, None, 1, 2, 3, 4)], "k long, s string, range int, place int, first int, page int").repartition(6)
    out = scanning.row_pages(df, "k", "s", 10, 2)
    assert out.columns == ["k", "s", "range", "place", "first", "page"]
    pages = {r.page: r.n for r in out.groupBy("page").agg(F.count("*").alias("n")).collect()}
    assert pages == {p: 10 for p in range(90)} | {90: 2}
    assert out.where("k IS NULL").first().page == 0 and out.where("k > 5").first().page == 90
    files = data_files(out.inputFiles()[0].removeprefix("file://").rpartition("/")[0])
    assert len(files) > 30  # no range holds them all


class _Handle:
    """State in lists, with a count of the messages that a real handle would send."""

    def __init__(self):
        self.n, self.held = 0, {"waiting": [], "held": []}

    def _state(self, name, schema):
        def called(change=None):
            self.n += 1
            if change is not None:
                self.held[name] = change
            return self.held[name]

        each = type("State", (), {})()
        each.appendList = lambda values: called(self.held[name] + values)
        each.update = lambda value: called([value])
        each.clear = lambda: called([])
        each.get = lambda: iter(called()) if name == "waiting" else next(iter(called()), None)
        return each

    getListState = getValueState = _state

    def registerTimer(self, at):
        self.n += 1


def test_messages_of_keyed_state_do_not_grow_with_keys():
    def messages(n):
        handle, processor = _Handle(), state.Expiring(["k"], ["at", "k", "id"], "id", 1000)
        processor.init(handle)
        mark = type("Mark", (), {"getCurrentWatermarkInMs": lambda self: 1 if n > 5 else 2})()
        rows = [Row(id=i, k=i % n, at=i, _data=True) for i in range(2 * n)]
        assert list(processor.handleInputRows((0,), iter(rows), mark)) == []
        assert sorted(r.id for r in processor.handleExpiredTimer((0,), mark, None)) == list(range(n))
        assert len(handle.held["waiting"]) == (n > 5)
        return handle.n

    assert messages(3) <= 8 and messages(900) <= 8
