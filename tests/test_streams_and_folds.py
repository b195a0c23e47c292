import datetime
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregation, changes, cleaning, folds, matching, scanning, sets, vectors
from millrace.streaming import jobs

T0 = datetime.datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp, user_id long, event_type string"


def rows_of_time(n=400, seed=3):
    rng = random.Random(seed)
    return [(i, T0 + datetime.timedelta(seconds=rng.randrange(40_000)), rng.randrange(3), rng.choice("ab")) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_keys_are_free_again_after_their_lifetime(spark, parts):
    rows = rows_of_time()
    held, want = {}, []
    for i, t, u, k in sorted(rows, key=lambda r: (r[1], r[0])):
        if (u, k) not in held or t - held[u, k] >= datetime.timedelta(minutes=20):
            held[u, k] = t
            want.append(i)
    odd = [(1000, None, 1, "a"), (1001, T0, None, "a"), (1002, T0, None, "a")]
    df = spark.createDataFrame(rows + odd, EVENTS).withColumn("batch", F.lit("x")).repartition(parts)
    out = folds.expiring_first(df, ["user_id", "event_type"], "ts", "event_id", 1200)
    assert out.columns == df.columns and sorted(r.event_id for r in out.collect()) == sorted([*want, 1000, 1001, 1002])
    assert folds.expiring_first(df.limit(0), ["user_id"], "ts", "event_id", 1200).count() == 0


def test_a_repeated_row_is_held_back(spark):
    df = spark.createDataFrame([(1, T0, 1, "a"), (1, T0, 1, "a"), (2, T0 + datetime.timedelta(minutes=20), 1, "a")], EVENTS)
    assert [r.event_id for r in folds.expiring_first(df, ["user_id"], "ts", "event_id", 1200).orderBy("event_id").collect()] == [1, 2]


@pytest.mark.parametrize("parts", [1, 5])
def test_buffers_are_flushed_by_size_and_by_time(spark, parts):
    rows = rows_of_time()
    want = []
    for u in range(3):
        number, held = 0, []
        mine = sorted((r for r in rows if r[2] == u), key=lambda r: (r[1], r[0]))
        for i, t, _, _ in mine:
            if held and t - held[0][1] >= datetime.timedelta(seconds=900):
                want.append((u, number, held[0][0], len(held), "time"))
                number, held = number + 1, []
            held.append((i, t))
            if len(held) == 6:
                want.append((u, number, held[0][0], len(held), "size"))
                number, held = number + 1, []
        if held:
            want.append((u, number, held[0][0], len(held), "end"))
    df = spark.createDataFrame([*rows, (2000, None, 1, "a"), (2001, T0, None, "a")], EVENTS).repartition(parts)
    out = folds.flushes(df, ["user_id"], "ts", "event_id", 6, 900)
    assert sorted(map(tuple, out.collect())) == sorted(want) and {r[4] for r in want} == {"time", "size", "end"}
    assert folds.flushes(df.limit(0), ["user_id"], "ts", "event_id", 6, 900).count() == 0


def _spool(spark, rows, path):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_streams_go_on_where_they_ended(spark, tmp_path):
    rows, source, out = rows_of_time(), f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    _spool(spark, rows[:150], source)
    first = jobs.hour_windows(spark, source, f"{out}/hours").agg(F.sum("n")).first()[0]
    keys = jobs.stream_distinct(spark, source, ["user_id", "event_type"], f"{out}/keys").count()
    assert first == 150 and keys == 6
    _spool(spark, [*rows[150:], (900, T0, None, "a"), (901, T0, None, "a")], source)
    _spool(spark, [(902, T0, None, "a"), (903, T0 - datetime.timedelta(days=400), 7, "c")], source)
    hours = {(r.start, r.event_type): r.n for r in jobs.hour_windows(spark, source, f"{out}/hours").collect()}
    assert sum(hours.values()) == 404 and hours[T0 - datetime.timedelta(days=400), "c"] == 1  # late, and counted
    found = jobs.stream_distinct(spark, source, ["user_id", "event_type"], f"{out}/keys").collect()
    assert sorted(map(tuple, found), key=str) == sorted({(u, k) for _, _, u, k in rows} | {(None, "a"), (7, "c")}, key=str)
    again = jobs.hour_windows(spark, source, f"{out}/hours").agg(F.sum("n")).first()[0]
    assert again == 404


def test_a_write_is_tried_again_and_its_failures_counted(spark, tmp_path):
    source, calls = f"file://{tmp_path}/in", []
    _spool(spark, rows_of_time(), source)

    def flaky(rows, path, until):
        calls.append(path)
        if len(calls) <= until:
            raise OSError("away")
        jobs._save(rows, path)

    out = jobs.shard_writes(spark, source, "user_id", 2, f"file://{tmp_path}/x", save=lambda r, p: flaky(r, p, 2)).collect()
    assert len(calls) == 3 and sum(r.written for r in out) == 400 and all(r.failed == 0 and r.attempts == 3 for r in out)
    assert spark.read.parquet(f"file://{tmp_path}/x/rows").count() == 400
    calls.clear()
    out = jobs.shard_writes(spark, source, "user_id", 2, f"file://{tmp_path}/y", save=lambda r, p: flaky(r, p, 9)).collect()
    assert len(calls) == 3 and sum(r.failed for r in out) == 400 and all(r.written == 0 for r in out)
    assert spark.read.parquet(f"file://{tmp_path}/y/failed").count() == 400
    valid = F.col("event_type") == "a"
    out = jobs.shard_writes(spark, source, "user_id", 2, f"file://{tmp_path}/z", valid=valid).collect()
    assert sum(r.written for r in out) == sum(r[3] == "a" for r in rows_of_time()) and sum(r.written + r.failed for r in out) == 400


def test_a_dry_run_marks_nothing(spark, tmp_path):
    df, marks = spark.createDataFrame(rows_of_time() + [(5, T0, None, "a")], EVENTS), f"file://{tmp_path}/marks"
    df.select("user_id").limit(0).write.parquet(marks)
    assert jobs.mark(df, "user_id", marks, dry=True).count() == 3 and spark.read.parquet(marks).count() == 0
    jobs.mark(df, "user_id", marks, dry=False)
    assert spark.read.parquet(marks).count() == 3 and jobs.mark(df, "user_id", marks, dry=False).count() == 0
    assert spark.read.parquet(marks).count() == 3


def test_days_are_done_once_for_the_same_parameters(spark, tmp_path):
    out, days = f"file://{tmp_path}/out", spark.createDataFrame([(datetime.date(2024, 1, d % 3 + 1),) for d in range(9)] + [(None,)], "day date")
    worked, fails = [], [True]

    def work(todo):
        worked.append(sorted(r.day.day for r in todo.collect()))
        if fails.pop() if fails else False:
            raise OSError("away")
        return todo.where(F.dayofmonth("day") != 2).withColumn("n", F.lit(1))  # nothing comes of the second

    with pytest.raises(OSError):
        jobs.run_days(days, out, {"hours": 6, "sites": ["a"]}, work)
    assert sorted(r.day.day for r in jobs.run_days(days.where("day < '2024-01-03'"), out, {"hours": 6, "sites": ["a"]}, work).collect()) == [1]
    assert [r.day.day for r in jobs.run_days(days, out, {"sites": ["a"], "hours": 6}, work).collect()] == [3]
    assert jobs.run_days(days, out, {"hours": 6, "sites": ["a"]}, work).count() == 0
    assert worked == [[1, 2, 3], [1, 2], [3], []] and spark.read.parquet(f"{out}/rows").count() == 2
    with pytest.raises(ValueError, match=r"hours: 6 then, 12 now; more: not set then, true now"):
        jobs.run_days(days, out, {"hours": 12, "sites": ["a"], "more": True}, work)
    assert len(worked) == 4


def test_upsert_takes_the_newest_of_several_updates(spark):
    old = spark.createDataFrame([(1, "a", "x"), (None, "n", "n")], "k long, p string, q string")
    new = spark.createDataFrame([(1, "b", "", 1), (1, "c", None, 3), (1, "", "z", 2), (None, "m", "m", 1), (4, "d", "", 1), (4, "e", "", 0)], "k long, p string, q string, at long")
    want = [(1, "c", "z"), (4, "d", None), (None, "n", "n")]
    assert sorted(map(tuple, changes.upsert(old, new, "k", "at").collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, changes.upsert(old, new, "k").collect()), key=str) == sorted([(1, "c", "z"), (4, "e", None), (None, "n", "n")], key=str)
    assert changes.upsert(old, new.limit(0), "k", "at").count() == 2 and changes.upsert(old.limit(0), new, "k", "at").count() == 2


def test_tiers_take_any_columns(spark):
    df = spark.createDataFrame([("m", 5.0, 1, 2, 3, "old"), (None, 9.0, 1, 2, 3, "old"), ("x", None, 1, 2, 3, "old")], "category string, v double, s int, a int, b int, tier string")
    t = spark.createDataFrame([("m", 5.0, 3.0, 1.0)], "category string, s double, a double, b double")
    out = aggregation.tiers(df, "category", "v", t, (10.0, 8.0, 6.0))
    assert sorted((str(r.category), r.s, r.tier) for r in out.collect()) == [("None", 1, "A"), ("m", 1, "S"), ("x", 1, "C")]
    assert out.columns == df.columns and aggregation.tiers(df.limit(0), "category", "v", t, (1.0, 1.0, 1.0)).count() == 0


def test_values_are_joined_in_order_over_runs(spark):
    rows = [(k, i, f"v{i}" if i % 7 else None) for i in range(50) for k in (1, None)]
    out = {r.k: r.joined for r in aggregation.joined_in_order(spark.createDataFrame(rows, "k long, o long, v string").repartition(3), "k", "o", "v", 8).collect()}
    assert out == dict.fromkeys((1, None), ",".join(f"v{i}" for i in range(50) if i % 7))


def test_json_keys_are_cleaned_row_by_row(spark):
    raw = ['{"a": "1", " a ": "2", "b": "", " b": "x", "b ": " "}', '{"a": "3"}', None, "no json", "{}", '{"c": null}']
    df = spark.createDataFrame([(1, r) for r in raw], "id long, raw string")
    assert sorted((r.key, r.value) for r in cleaning.clean_keys(df, "id", "raw").where("key <> 'c'").collect()) == [("a", "2"), ("a", "3"), ("b", "x")]
    assert "Exchange" not in cleaning.clean_keys(df, "id", "raw")._jdf.queryExecution().toString()


def test_numbers_with_inner_blanks(spark):
    from millrace.functions import exprs

    rows = spark.createDataFrame([("1 234",), (" 1,2 3 4\t",), (" - 5",), (None,)], "r string").select(exprs.safe_int(F.col("r")).alias("i")).collect()
    assert [r.i for r in rows] == [1234, 1234, 0, 0]


@pytest.mark.parametrize(("wanted", "listed"), [(1_000_000, 8 << 20), (1_000_000, -1), (2, -1)])
def test_grounding_against_plain_search(spark, wanted, listed, monkeypatch):
    monkeypatch.setattr(matching, "_WANTED", wanted)
    monkeypatch.setattr(matching, "_LIST_BYTES", listed)
    texts = ["The cat, sat on the MAT!", "漢字 かな 漢字を書く #1", "", None, "cat", "the cat sat on the mat", "xx"]
    items = ["cat sat on", "漢字漢字を", "C a T", "書く#1", "", None, "absent from all", "x"]
    plain = lambda t: "".join(c for c in (t or "") if c in "#" or (c.isascii() and c.isalnum()) or "一" <= c <= "鿿").lower()
    want = {i: sum(plain(e) in plain(t) for t in texts) for i, e in enumerate(items) if plain(e)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("g", F.lit(1))
    evidence = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {r.item_id: r.grounded for r in matching.grounded(docs, evidence).collect()} == {i: n for i, n in want.items() if n}
    assert matching.grounded(docs, evidence.limit(0)).count() == 0 == matching.grounded(docs.limit(0), evidence).count()


def test_grounding_in_ones_own_source(spark):
    pairs = [("The cat sat", "CAT", True), ("a long text here", "no text at all", True), ("abcd", "bcd", True), ("abcxyz", "abc wxyz", False), ("abcd", "", False), (None, "abcd", False), ("abcd", None, False), ("abx漢字語文", "漢字語文だ", True)]
    rows = spark.createDataFrame(pairs, "s string, e string, want boolean").select("want", matching.grounded_in(F.col("s"), F.col("e")).alias("got"))
    assert all(r.want == r.got for r in rows.collect())
    for s, e, want in pairs:
        norm = lambda t: "".join(c for c in (t or "") if c.isascii() and c.isalnum() or "一" <= c <= "鿿").lower()
        assert want == bool(norm(e) and (norm(e) in norm(s) or matching.longest_common_substring(norm(s), norm(e)) >= 4))


def test_long_word_lists(spark):
    docs = spark.createDataFrame([(1, "Red, GREEN"), (2, "redder"), (3, None), (4, "")], "doc_id long, text string")
    words = spark.createDataFrame([("red",), ("blue",), (None,), ("",)], "word string")
    assert [r.doc_id for r in matching.any_of_many(docs, "doc_id", "text", words, "word").collect()] == [1]
    assert matching.any_of_many(docs, "doc_id", "text", words.limit(0), "word").count() == 0


def test_pages_have_equal_rows_whatever_the_keys(spark):
    rng = random.Random(1)
    keys = [rng.choice([rng.randrange(50), 10**9 + rng.randrange(10**6)]) for _ in range(500)]
    df = spark.createDataFrame([(k, "x") for k in keys] + [(7, ""), (8, None)], "k long, s string").repartition(4)
    pages = {r.page: (r.n, r.a, r.b) for r in scanning.row_pages(df, "k", "s", 20, 2).groupBy("page").agg(F.count("*").alias("n"), F.min("k").alias("a"), F.max("k").alias("b")).collect()}
    keys.sort()
    assert pages == {p: (20, keys[20 * p], keys[20 * p + 19]) for p in range(25)}
    assert scanning.row_pages(df.limit(0), "k", "s", 20).count() == 0
    assert scanning.bounded_scan(df, ["k"], 3, "k").columns == ["k"] and scanning.bounded_scan(df, ["k"]).count() == 502


def test_latest_change_and_valid_entries(spark):
    at = lambda y: datetime.datetime(y, 1, 1)
    rows = [(1, "a", at(1996), 1), (1, "b", at(1997), 2), (1, "c", at(1997), 3), (1, "", at(1998), 4), (1, None, at(1998), 5), (1, "z", at(2000), 6), (2, "q", None, 7), (None, "n", at(1996), 8)]
    df = spark.createDataFrame(rows, "k long, value string, updated_at timestamp, id long")
    assert sorted(((r.k, r.value, r.updated_at) for r in sets.latest_change(df, "k", "1996-01-01", "1999-01-01").collect()), key=str) == [(1, "c", at(1997)), (None, "n", at(1996))]
    assert sorted(((r.k, r.entries) for r in changes.valid_entries(df, "k", "1996-01-01", "1999-01-01").collect()), key=str) == [(1, 4), (None, 1)]


def test_prototypes_are_the_same_by_blocks(spark, monkeypatch):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)], f"l{i % 5}") for i in range(60)] + [(60, None, "l1"), (61, [0.0] * 8, "l2")], "id long, v array<double>, label string")
    listed = sorted(map(tuple, vectors.nearest_prototype(df, "id", "v", "label").collect()))
    monkeypatch.setattr(vectors, "is_small", lambda _: False)
    blocks = sorted(map(tuple, vectors.nearest_prototype(df, "id", "v", "label").collect()))
    assert listed == blocks and len(listed) == 60
    found = {b: sorted(map(tuple, vectors.top_k(df.where("id % 10 = 0"), df, "id", "v", 3, 2, b).collect())) for b in (5, 8192)}
    assert found[5] == found[8192] and len(found[5]) == 18


def test_scratch_needs_a_shared_folder_off_a_local_master(monkeypatch):
    from types import SimpleNamespace

    from millrace.sources import tables

    session = lambda master, folder: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=SimpleNamespace(master=master))
    assert tables.scratch(session("yarn", "hdfs://x/y/"), "a").startswith("hdfs://x/y/a-")
    assert tables.scratch(session("local[2]", None), "a").startswith("file:///tmp/")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            tables.scratch(session(master, None), "a")


def test_mappings_and_fills_of_odd_rows(spark):
    from millrace.operators import enrichment, routes

    names = spark.createDataFrame([("A",), ("al",), ("A-x",), ("al|y",), (None,), ("zz",), ("A",)], "name string")
    targets = spark.createDataFrame([("A", "t1")], "name string, target string")
    aliases = spark.createDataFrame([("al", "A")], "alias string, canonical string")
    got = sorted(((r.name, r.target, r.matched_by) for r in routes.map_with_fallback(names, "name", targets, aliases).collect()), key=str)
    want = [("A", "t1", "exact"), ("A", "t1", "exact"), ("al", "t1", "alias"), ("A-x", "t1", "trimmed"), ("al|y", "t1", "trimmed alias"), (None, None, None), ("zz", None, None)]
    assert got == sorted(want, key=str)
    assert routes.map_with_fallback(names, "name", targets.limit(0), aliases).where("target IS NOT NULL").count() == 0
    df = spark.createDataFrame([(1, " ", "x"), (2, "q", None), (None, "", None)], "k long, p string, q string")
    profile = spark.createDataFrame([(1, "P", "Q"), (2, "P", "Q")], "k long, p string, q string")
    assert sorted(map(tuple, enrichment.fill_empty(df, profile, "k", ["p", "q"]).collect()), key=str) == [(1, "P", "x"), (2, "q", "Q"), (None, None, None)]
