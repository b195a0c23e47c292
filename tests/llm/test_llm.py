import collections
import hashlib
import io
import itertools
import math
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import (
    chat,
    classifier,
    common,
    components,
    minhash,
    packing,
    quality_rules,
    queries,
    segmentations,
    sharding,
    suffixes,
    vectors_dedup,
    vocabulary,
    warc,
)
from tests.llm import brute
from tests.oracle import DATA, assert_same, connection

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def made(n=60, seed=1):
    """Documents with copies, near copies, repeats, blanks, odd characters, a long text and nulls."""
    rng = random.Random(seed)
    vocabulary_ = ["".join(rng.choices("abcdefgé", k=rng.randint(1, 7))) for _ in range(300)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.15 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.4 and texts and (base := (rng.choice(texts) or "").split(" ")):
            base[rng.randrange(len(base))] = rng.choice(vocabulary_)
            texts.append(" ".join(base))
        elif kind < 0.45:
            texts.append(rng.choice([None, "", " ", "\n", "One", "a b\tc", "<|endoftext|> ▁x", "漢字かな 🎉\r\n"]))
        else:
            texts.append(" ".join(rng.choices(vocabulary_, k=rng.choice([3, 30, 120]))) + rng.choice(["", "\nsame line\nsame line", "  two  blanks "]))
    texts.append(" ".join(rng.choices(vocabulary_, k=6000)))
    return [(i * 7 % (n + 1), t, rng.choice(["en", "fr", None, "xx"]), rng.choice(["a", "a", "a", "b", None]), 0) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), DOCS).repartition(3).cache()


def clashing(df):
    """Columns whose names operators might use for themselves."""
    for c in ("rid", "n", "rank", "kept", "family", "_m", "block", "key", "marks", "_join", "label"):
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, DATA), queries.ORACLES[name], connection())


def test_quality_rules(spark, docs):
    rows = quality_rules.measure(clashing(docs), "q").collect()
    assert len(rows) == docs.count()
    for r in rows:
        q = r.q
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute.base_counts(r.text)
        assert q.base_failed == (q.n_words < 20 or 100 * q.n_repeat_words > 30 * q.n_words)
        assert not (q.base_failed and q.kept)
        words = brute.words(r.text)
        bpe = vocabulary.byte_bpe(vocabulary.default_path("byte_bpe_multi_50k.tiktoken"))
        tokens = [t for w in words for t in bpe.encode_ordinary(" " + w)]
        assert q.n_tokens == len(tokens)
        entropy = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in collections.Counter(tokens).values())
        assert abs(q.token_entropy - entropy) < 1e-9
    assert quality_rules.keep(docs).columns == docs.columns
    assert quality_rules.measure(docs.limit(0), "q").count() == 0


def plain_fertility(text):
    """Characters a token, share of byte pieces, bits of entropy, tokens and script of a text with words, word by word."""
    words = brute.words(text)
    bpe = vocabulary.byte_bpe(vocabulary.default_path("byte_bpe_multi_50k.tiktoken"))
    model = vocabulary.piece_model(vocabulary.default_path("piece_bpe_32k.model"))
    tokens = [t for w in words for t in bpe.encode_ordinary(" " + w)]
    pieces = [p for w in words for p in model.encode(w)]
    entropy = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in collections.Counter(tokens).values())
    script = "latin" if 2 * sum(ord(c) < 0x250 for c in text) >= len(text) else "other"
    return sum(map(len, words)) / len(tokens), sum(map(model.is_byte, pieces)) / len(pieces), entropy, len(tokens), script


def test_verdicts_of_the_fertility_bands(spark):
    rng, real = random.Random(9), spark.read.parquet(f"{DATA}/documents.parquet").select("text", "lang").limit(60).collect()
    runs = ["".join(rng.choices("qxzjkvw0123456789", k=9)) for _ in range(60)]  # few characters a token
    odd = ["".join(chr(rng.randrange(0x13000, 0x13400)) for _ in range(3)) for _ in range(60)]  # bytes instead of pieces
    same = [" ".join(["word", "other"] * 10 + [f"tail{i}" for i in range(60)]) for _ in range(1)]
    texts = [(r.text, r.lang) for r in real]
    texts += [(" ".join(t), lang) for t in (runs, odd, [c for w in odd for c in w]) for lang in ("en", "xx", None)]
    texts += [(same[0], "de"), (" ".join("漢字仮名文章試験"[i % 8] + chr(0x4E00 + i) for i in range(80)), None), (" ".join(["a"] * 30), "en"), (None, "en"), ("", None), (" \n", "fr")]
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    rows = quality_rules.measure(df, "q").collect()
    seen = collections.Counter()
    for r in rows:
        if not brute.words(r.text):
            assert r.q.chars_per_token is None and r.q.byte_share is None and not r.q.kept and r.q.base_failed
            continue
        chars, share, entropy, n, script = plain_fertility(r.text)
        assert r.q.script == script and abs(r.q.chars_per_token - chars) < 1e-9 and abs(r.q.byte_share - share) < 1e-9
        b = quality_rules.BANDS.get(r.lang) or quality_rules.BANDS[script]
        faults = [not b.least_chars <= chars <= b.most_chars, share > b.byte_share, entropy < min(b.entropy, b.entropy_share * math.log2(n))]
        assert r.q.kept == (not r.q.base_failed and not any(faults))
        seen.update(["kept" if r.q.kept else "failed" if r.q.base_failed else "chars" if faults[0] else "bytes" if faults[1] else "entropy"])
    assert seen["kept"] and seen["failed"] and seen["chars"] and sum(seen.values()) == len(rows) - 3
    kept = {r.doc_id for r in rows if r.q.kept}
    assert {r.doc_id for r in quality_rules.keep(df).collect()} == kept


def test_segmentations_are_distinct_seeded_and_round_trip(spark, docs):
    small = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 2000)
    out = segmentations.sample(clashing(small), 4).withColumn("back", segmentations.decode(F.col("ids"))).collect()
    again = segmentations.sample(small.repartition(7), 4).collect()
    assert sorted((r.doc_id, r.rank, r.perturbed, bytes(r.ids)) for r in out) == sorted((r.doc_id, r.rank, r.perturbed, bytes(r.ids)) for r in again)
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    by = collections.defaultdict(list)
    for r in out:
        assert r.back == texts[r.doc_id]
        assert 0 < r.inclusion <= 1 or r.log_prob < -700 or r.inclusion == 0
        by[r.doc_id].append((r.rank, r.perturbed, bytes(r.ids)))
    for rows in by.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert [r[1] for r in rows] == sorted((r[1] for r in rows), reverse=True)
        assert len({r[2] for r in rows}) == len(rows)
    assert set(by) == set(texts)
    assert segmentations.sample(docs.limit(0), 2).count() == 0


def test_segmentations_query_against_plain_lattices(spark, docs, tmp_path):
    """Pieces, probabilities, inclusion scores and checksums of whole texts, the long one too."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    digests = {(r.doc_id, r.rank): r for r in queries.QUERIES["op2_segmentations"](spark, str(tmp_path)).collect()}
    samples = {(r.doc_id, r.rank): r for r in segmentations.sample(docs, 4).collect()}  # rank 3 is the first one left out
    pieces = segmentations._pieces(vocabulary.default_path("piece_bpe_32k.model"), 0.3)
    weights = brute.piece_weights(vocabulary.default_path("piece_bpe_32k.model"), 0.3)
    for r in docs.collect():
        text = r.text or ""
        total = brute.lattice_mass(text, weights)
        for rank in range(3):
            d, s = digests.get((r.doc_id, rank)), samples.get((r.doc_id, rank))
            assert (d is None) == (s is None) and (rank or d is not None)
            if d is None:
                continue
            ids = np.frombuffer(bytes(s.ids), "<i4").tolist()
            assert brute.spelled(ids, pieces.bytes_) == text == s.text
            assert (d.n_pieces, d.ids_crc32, d.text_crc32) == (len(ids), zlib.crc32(bytes(s.ids)), zlib.crc32(text.encode()))
            assert abs(d.log_prob - (sum(weights[1][i] for i in ids) - total)) < 1e-5 * max(1, len(ids) ** 0.5)
            out = samples.get((r.doc_id, 3))
            x = d.log_prob - out.perturbed if out else math.inf
            want = x if x < -36 else math.log(-math.expm1(-math.exp(x))) if x < 700 else 0.0
            assert abs(d.log_inclusion - want) < 1e-6 * max(1, abs(want)) and abs(d.inclusion - math.exp(want)) < 1e-6
    assert min(d.log_inclusion for d in digests.values()) < -745  # where the score itself is 0


def test_segmentations_follow_their_distribution():
    pieces = segmentations._pieces(vocabulary.default_path("piece_bpe_32k.model"), 0.3)
    lat = segmentations._Lattices(pieces)
    words = ["▁the", "☃an", "ab"]

    def paths(word):
        if not word:
            return [((), 0.0)]
        out = []
        for j in range(1, len(word) + 1):
            found = pieces.weights.get(word[:j]) or ((-1 - ord(word[0]), pieces.last * len(word[0].encode())) if j == 1 else None)
            if found:
                out += [((found[0], *rest), found[1] + w) for rest, w in paths(word[j:])]
        return out

    joint = {}
    for combination in itertools.product(*map(paths, words)):
        joint[tuple(x for p, _ in combination for x in p)] = sum(w for _, w in combination)
    total = np.logaddexp.reduce(list(joint.values()))
    p = {k: math.exp(w - total) for k, w in joint.items()}
    n = 20000
    seeds = segmentations.tn.mix(np.arange(n, dtype=np.uint64))
    results = segmentations.top_segmentations(np.tile(lat.of(words), n), np.arange(0, 3 * n + 1, 3), seeds, lat, 2)

    def seen(r):
        count = collections.Counter()
        for d in range(n):
            s, z = r["start"][3 * d : 3 * d + 3], r["size"][3 * d : 3 * d + 3]
            count[tuple(int(x) for a, b in zip(s, z) for x in r["pool"][a : a + b])] += 1
        return count

    first, second = map(seen, results)
    for path, q in p.items():
        then = sum(o * q / (1 - o) for other, o in p.items() if other != path)
        assert abs(first[path] / n - q) < 0.015 and abs(second[path] / n - then) < 0.015
    weights = sum(np.exp(r["log_prob"]) / -np.expm1(-np.exp(r["log_prob"] - r["threshold"])) for r in results)
    assert abs(weights.mean() - 1) < 0.02  # inclusion scores make sums over samples unbiased


def test_frequent_words_keep_their_lattices():
    """Beyond the limit the words of many calls stay and are not built again; what stays draws as if it stood alone."""
    pieces = segmentations._pieces(vocabulary.default_path("piece_bpe_32k.model"), 0.3)
    lat, alone = segmentations._Lattices(pieces, limit=40), segmentations._Lattices(pieces)
    often, built, build = ["▁the", "☃an", "▁straße", "ab", "▁"], [], lat._build
    lat._build = lambda line, sizes: built.append(line) or build(line, sizes)
    for i in range(30):
        lat.make_room()
        lat.of([f"once{i}a", *often[i % 2 :], f"▁once{i}b", f"x{i}漢字"])
        assert len(lat.types) <= 40 + 8
    assert sum("▁straße" in line for line in built) == 1 and sum(line.count("once") for line in built) == 60
    lat.make_room()
    offs, seeds = np.array([0, 3, 5]), segmentations.tn.mix(np.arange(2, dtype=np.uint64))
    for x, y in zip(*(segmentations.top_segmentations(t.of(often), offs, seeds, t, 3) for t in (lat, alone))):
        pick = [[r["pool"][s : s + z].tolist() for s, z in zip(r["start"], r["size"])] for r in (x, y)]
        assert pick[0] == pick[1] and x["log_prob"].tolist() == y["log_prob"].tolist() and x["threshold"].tolist() == y["threshold"].tolist()


@pytest.mark.parametrize("projections", [None, 9])
def test_near_vectors(spark, projections):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    rows = []
    for i in range(400):
        v = base[rng.integers(40)] + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.2])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    odd = [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] + [1.0] * 15, 1), (403, [None] + [1.0] * 15, 1), (404, [float("inf")] + [1.0] * 15, 1), (405, rows[0][1], None), (406, [1.0, 2.0], 1), (None, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    vectors_dedup._BLOCK, old = 8, vectors_dedup._BLOCK
    try:
        found = {r.vec_id: r for r in vectors_dedup.near_vectors(df.withColumn("keys", F.lit(1)), projections=projections).collect()}
    finally:
        vectors_dedup._BLOCK = old
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    links = [(i, j) for i in range(400) for j in range(i) if label[i] == label[j] and x[i] @ x[j] >= 0.93]
    degree = collections.Counter(i for pair in links for i in pair)
    top = brute.classes(range(400), links)
    assert all((found[i].n_links, found[i].component_id, found[i].kept) == (degree[i], top[i], top[i] == i) for i in range(400))
    assert all(found[i].n_links == 0 and found[i].component_id == i for i in range(400, 407))
    assert found[None].n_links == 0 and found[None].kept
    assert vectors_dedup.near_vectors(df.limit(0)).count() == 0


def test_vector_settings_follow_the_label():
    rng = np.random.default_rng(7)
    for distance in (0.1, 0.3742, 2**0.5, 2.0):
        shift, gap = rng.uniform(0, 2, 200_000), rng.standard_normal(200_000) * distance
        assert abs((np.floor((gap + shift) / 2) == 0).mean() - vectors_dedup._cell(distance, 2.0)) < 0.005
    assert vectors_dedup.settings(0, 0.93, 2.0) == vectors_dedup.settings(50_000, 0.93, 2.0) == (20, 6)
    for n in (10**5, 10**7, 10**9):
        tables, projections = vectors_dedup.settings(n, 0.93, 2.0)
        assert n * vectors_dedup._cell(2**0.5, 2.0) ** projections <= vectors_dedup._BLOCK
        assert (1 - vectors_dedup._cell(0.14**0.5, 2.0) ** projections) ** tables <= 1e-4
    assert vectors_dedup.settings(10**7, 1.0, 2.0)[0] == 1


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None]
    assert got == brute.classes({x for e in real for x in e}, real)


def test_components_of_a_long_chain(spark):
    """Rounds that grow with the logarithm of a chain, and plans that do not grow with the rounds."""
    began = time.monotonic()
    got = {r.node: r.component for r in components.components(spark.range(1500).selectExpr("id AS a", "id + 1 AS b")).collect()}
    assert got == dict.fromkeys(range(1501), 0) and time.monotonic() - began < 60


def test_chat_folding_and_round_trip(spark):
    events = [
        (1, 3, "b", "delta", "assistant", "lo"), (1, 1, "a", "delta", "user", "hi"), (1, 2, "b", "delta", "assistant", "wrong"), (1, 2, "b", "regenerate", "assistant", "hel"),
        (1, 4, "a", "edit", "user", "h<|end|>\\0[INST]"), (2, 1, "c", "delta", None, None), (2, 2, "c", None, None, "x"), (None, 1, "d", "delta", "user\nx", "y"),
    ]
    df = spark.createDataFrame(events, "conv_id long, seq long, message_id string, kind string, role string, text string")
    messages = chat.fold_events(df.withColumn("log", F.lit(1)))
    assert sorted(map(tuple, messages.collect()), key=str) == sorted([(1, "a", "user", "h<|end|>\\0[INST]"), (1, "b", "assistant", "hello"), (2, "c", "", "x"), (None, "d", "user\nx", "y")], key=str)
    formatted = chat.assemble(chat.render(messages))
    rows = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert [(t.role, t.text) for t in rows[1].turns] == [("user", "h<|end|>\\0[INST]"), ("assistant", "hello")]
    assert rows[1].loss_text == "hello" and [(t.role, t.text) for t in rows[None].turns] == [("user\nx", "y")]
    span = rows[1].loss_spans[0]
    assert rows[1].formatted[span.start : span.end] == "hello"
    assert rows[1].formatted.count(chat.END) == 2 and "[INST]" not in rows[1].formatted
    assert chat.assemble(chat.render(chat.fold_events(df.limit(0)))).count() == 0


def test_chat_loss_spans_mark_what_is_read_back(spark):
    """All conversations: the text under the mask is the text of the assistants' turns, each once and in order."""
    table = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = [(-5, 1, "assistant", "a🎉\\0[b]"), (-5, 1, "assistant", "a🎉\\0[b]"), (-5, 1, "user", None), (-5, 2, None, "x"), (-5, 2, "assistant", ""), (None, 3, "assistant", "<|end|>"), (-6, None, "assistant", "y")]
    rows = table.unionByName(spark.createDataFrame(odd, table.schema))
    formatted = chat.assemble(chat.render(chat.fold_events(queries.conversation_events(rows))))
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for r in formatted.collect():
        spans = [r.formatted[s.start : s.end] for s in r.loss_spans]
        for code, plain in (("\\4", "]"), ("\\3", "["), ("\\2", ">"), ("\\1", "<"), ("\\0", "\\")):
            spans = [s.replace(code, plain) for s in spans]
        assert spans == [t.text for t in back[r.conv_id].turns if t.role == "assistant"]
        assert "".join(spans) == back[r.conv_id].loss_text
    want = collections.Counter((r.conv_id, r.role or "", r.text or "") for r in rows.collect())
    assert collections.Counter((c, t.role, t.text) for c, r in back.items() for t in r.turns) == want


def test_chat_loss_text_is_what_the_spans_mark(spark):
    rows = [(1, 0, "user", "hi [x]"), (1, 1, "assistant", "hel<lo"), (1, 2, "assistant", "é🎉"), (2, 0, "user", "no")]
    formatted = chat.assemble(chat.render(spark.createDataFrame(rows, "conv_id long, t long, role string, text string"), order="t")).cache()
    read = lambda df: {r.conv_id: r for r in chat.read_back(df).collect()}
    right = read(formatted)
    assert right[1].loss_text == "hel<loé🎉" and right[2].loss_text == "" and [t.text for t in right[1].turns] == ["hi [x]", "hel<lo", "é🎉"]
    assert {r.conv_id: (r.formatted, r.loss_spans) for r in formatted.collect()} == {c: (r.formatted, r.loss_spans) for c, r in right.items()}
    moved = formatted.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), (s["end"] + 1).alias("end"))))
    assert read(moved)[1].loss_text == "el<lo<🎉<"
    assert read(formatted.withColumn("loss_spans", F.slice("loss_spans", 1, 1)))[1].loss_text == "hel<lo"
    assert chat.read_back(formatted.limit(0)).count() == 0


def test_chat_of_a_long_conversation(spark):
    rows = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("t"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("é<"), F.col("id").cast("string")).alias("text"))
    began = time.time()
    r = chat.read_back(chat.assemble(chat.render(rows, order="t"))).first()
    assert len(r.turns) == 30_000 and r.loss_text == "".join(f"é<{k}" for k in range(1, 30_000, 2)) and time.time() - began < 60


def test_packing_pads_little_with_many_partitions(spark, docs):
    few = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        ids, sequences = packing.pack(few).agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ids > 900_000 and sequences * 1024 < 1.01 * ids


def test_classifier_scores_a_repeated_text_once(spark, monkeypatch):
    rows = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("en").alias("lang"), F.lit("the same text").alias("text"), F.lit(1).cast("long").alias("mark"), (F.col("id") % 2).alias("model"), F.lit(False).alias("held"))
    monkeypatch.setattr(classifier, "probabilities", lambda grams, model: grams.select("context", "last", F.lit(-1.0).alias("logp")))
    out = classifier.perplexities(rows.repartition(4), {}, block_bytes=1000).collect()
    assert len(out) == 2000 and {(r.n_symbols, r.log_perplexity) for r in out} == {(14, 1.0)}
    batches = pa.table({"text_hash": [7] * 500 + [8], "text": ["a b"] * 500 + ["c"], "model": [0] * 501, "block": [3] * 501}).to_batches(250)
    packed = [pa.ipc.open_stream(rows).read_all().num_rows for b in classifier._pack(iter(batches)) for rows in b["rows"].to_pylist()]
    assert packed == [1, 1, 1]


def test_near_vectors_of_repeated_keys(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.0, 1.0], 2), (4, [0.01, 1.0], 1)]
    out = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert [r[:2] for r in out if r[0] > 1] == [(2, 2), (3, 0), (4, 1)] and [r[2] for r in out if r[0] != 3] == [1] * 5
    assert all(r[1] >= 1 for r in out if r[0] == 1)  # not exact where one key has several vectors, see near_vectors()


def test_sharding_order_is_by_fractional_rank(spark, docs):
    """The whole order against a plain version."""
    rows = [(r.doc_id, r.source, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
    digest = lambda r: int(hashlib.md5(f"42|{r[0]}|{r[3]}".encode()).hexdigest()[:15], 16)
    placed = []
    for source in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (digest(r), r[0]))
        placed += [((2 * k + 1) * 2**39 // len(mine), digest(r), source or "", r) for k, r in enumerate(mine)]
    order = [p[3] for p in sorted(placed, key=lambda p: p[:3])]
    got = {(r.shard, r.slot): (r.doc_id, r.source, r.size, r.text_crc32) for r in sharding.interleave(docs, 7, rows_per_bucket=5).collect()}
    assert [got[k] for k in sorted(got)] == order


def test_warc_splits_and_revisits(spark, tmp_path):
    rng = random.Random(4)
    payloads = [None, "", "same" * 50, "".join(rng.choices("<p>é☃\x1f", k=5000)), "x" * 200_000]
    rows = [(i, f"http://h/{i} é\r\n", rng.choice(payloads)) for i in range(60)] + [(None, None, "same" * 50), (2, "again", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("z")).repartition(3)
    manifest = warc.write_archives(df, f"file://{tmp_path}/a", least_bytes=3)
    for split in (97, 5000, 1 << 22):
        read = warc.read_archives(manifest, split_bytes=split).collect()
        assert len(read) == len(rows)
        by = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read)
        first = {}
        for i, _, h in rows:
            if i is not None:
                first[h or ""] = min(first.get(h or "", i), i)
        want = collections.Counter()
        for i, _, h in rows:
            b = (h or "").encode()
            again = i is not None and len(b) >= 3 and i > first[h or ""]
            want[(i, len(b), warc.digest(b), "revisit" if again else "response", first[h or ""] if again else None)] += 1
        assert by == want
    assert warc.read_archives(warc.write_archives(df.limit(0), f"file://{tmp_path}/b")).count() == 0


def test_warc_passes_over_what_is_no_record():
    record = warc._record(1, "u", b"payload", None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(record) + packer.flush()
    noise = b"\x1f\x8b\x08junk" + zlib.compress(b"no") + b"\x1f\x8b"
    data = noise + member + noise + member + member[:20]
    found = [at for at, _ in warc.members(io.BytesIO(data), 0, len(data))]
    assert found == [len(noise), 2 * len(noise) + len(member)]
    assert [at for at, _ in warc.members(io.BytesIO(data), 0, found[0] + 1)] == found[:1]
    assert [at for at, _ in warc.members(io.BytesIO(data), found[0] + 1, len(data))] == found[1:]


def test_classifier_is_kneser_ney(spark, docs):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 40)] + [(None, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in classifier.classify(clashing(docs), labels).collect()}
    rows = docs.collect()
    good = {i for i in range(40) if i % 3}
    perplexity = brute.kneser_ney([r.text for r in rows if r.doc_id in good and r.text])
    assert set(out) == {r.doc_id for r in rows}
    for r in rows:
        if not r.text:
            assert not out[r.doc_id].kept and out[r.doc_id].log_perplexity is None
        elif len(r.text) < 2000:
            assert abs(out[r.doc_id].log_perplexity - perplexity(r.text)) < 1e-9
            assert out[r.doc_id].kept == (out[r.doc_id].log_perplexity <= out[r.doc_id].limit)
    assert classifier.keep(docs, labels).columns == docs.columns
    assert classifier.classify(docs.limit(0), labels).count() == 0
    assert classifier.classify(docs, labels.limit(0)).where("kept").count() == docs.where("length(text) > 0").count()


def far_apart(n=30, seed=5):
    """Texts in ideographs, Hangul, emoji and letters."""
    rng = random.Random(seed)
    alphabet = "翨迥漢字語文한국어글자🎉🚀😀𠀋𠮟abc "
    return [(i, "".join(rng.choices(alphabet, k=rng.randint(5, 60))), rng.choice(["zh", "ko", None])) for i in range(n)]


@pytest.mark.parametrize("most", [1 << 16, 12, 4])
def test_classifier_tells_all_symbols_apart(spark, most, monkeypatch):
    """Also where a task meets more symbols than its short numbers hold: with 12 it starts anew, with 4 it does without them."""
    rows = far_apart()
    perplexity = brute.kneser_ney([t for i, t, _ in rows if i % 2])
    table, labels = pa.table({"text": [t for _, t, _ in rows], "fold": [i % 5 + 1 for i, _, _ in rows]}), {i for i, _, _ in rows if i % 2}
    monkeypatch.setattr(classifier._Symbols, "most", most)
    got = collections.Counter()
    for b in classifier._counts(table.to_batches(max_chunksize=4)):
        for c, w, k in zip(*(b[x].to_pylist() for x in ("context", "last", "c"))):
            got[c, w & 0x1FFFFF, w >> 21] += k
    want = collections.Counter()
    for i, t, _ in rows:
        line = [1, 1, 1, *(ord(x) + 3 for x in t), 2]
        for j in range(3, len(line)):
            want[line[j - 3] << 42 | line[j - 2] << 21 | line[j - 1], line[j], i % 5 + 1] += 1
    assert got == want
    if most > 12:
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        out = classifier.classify(df, spark.createDataFrame([(i, 1, 0) for i in labels], "doc_id long, quality int, toxic int")).collect()
        assert all(abs(r.log_perplexity - perplexity(rows[r.doc_id][1])) < 1e-9 for r in out)
    packed = io.BytesIO()
    part = pa.table({"text_hash": [1], "text": [rows[0][1]], "model": [0]})
    with pa.ipc.new_stream(packed, part.schema) as w:
        w.write_table(part)
    left = pa.table({"block": [0], "rows": pa.array([packed.getvalue()], pa.binary())})
    asked = pa.Table.from_batches(classifier._ask(iter(left.to_batches())))
    assert len(set(zip(asked["context"].to_pylist(), asked["last"].to_pylist()))) == len({x for x in brute.grams(rows[0][1], 4)})
    scored = classifier._score(left, asked.append_column("logp", pa.array(np.full(len(asked), -2.0))))
    assert scored["log_perplexity"].to_pylist() == [2.0] and scored["n_symbols"].to_pylist() == [len(rows[0][1]) + 1]


def test_classifier_keeps_and_drops_by_row(spark):
    good = "the cat sat on the mat and the dog sat on the log"
    rows = [(i, good + f" {i}", "en") for i in range(12)] + [(None, "", "en"), (None, "zqxjkv" * 30, "en"), (None, good + " 3", "en"), (3, "QQ##" * 40, "en"), (3, None, None), (20, good + " 4", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mark", F.lit(1)).withColumn("_row", F.lit(2))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12) if i != 3], "doc_id long, quality int, toxic int")
    left = classifier.keep(df, labels, quantile=1.0)
    assert left.columns == df.columns
    texts = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert texts == sorted([(i, t) for i, t, _ in rows if t and t.startswith("the")], key=str)


def test_classifier_rejects_held_out_junk(spark):
    docs = spark.read.parquet(f"{DATA[:-3]}01/documents.parquet")
    labels = spark.read.parquet(f"{DATA[:-3]}01/labels.parquet")
    out = classifier.classify(docs, labels.where("doc_id % 5 > 0")).join(labels.where("doc_id % 5 = 0"), "doc_id")
    good = out.where("quality = 1 AND toxic = 0")
    assert good.where("kept").count() >= 0.97 * good.count()
    assert out.where("quality = 0 AND NOT kept").count() >= 0.4 * out.where("quality = 0").count()


def test_classifier_limits_leave_own_counts_out(spark, docs):
    docs = docs.where("length(text) BETWEEN 1 AND 2000")
    rows = docs.withColumn("fold", classifier.fold_of("doc_id")).collect()
    labels = spark.createDataFrame([(r.doc_id, int(r.doc_id % 3 > 0), 0) for r in rows], "doc_id long, quality int, toxic int")
    good = [r for r in rows if r.doc_id % 3]
    others = {f: brute.kneser_ney([r.text for r in good if r.fold != f]) for f in {r.fold for r in good}}
    held = collections.defaultdict(list)
    for r in good:
        held[r.lang].append(others[r.fold](r.text))
    held[None] = [x for v in held.values() for x in v]
    want = {k: math.ceil(1000 * sorted(v)[math.ceil(0.99 * len(v)) - 1]) / 1000 for k, v in held.items()}
    out = classifier.classify(docs, labels).collect()
    assert len(out) == len(rows)
    for r in out:
        assert abs(r.limit - want[r.lang if r.lang in want else None]) < 1e-9
        assert r.kept == (r.log_perplexity <= r.limit)
    alone = classifier.classify(docs, labels.where(f"doc_id = {good[0].doc_id}")).collect()  # no other text to hold it against
    assert all(r.kept for r in alone if r.doc_id == good[0].doc_id)


@pytest.mark.parametrize("layout", [suffixes.Layout(20, 8), suffixes.Layout(20, 8, hot_strings=2, hot_in_batch=2, bucket_strings=5), suffixes.Layout(60, 16, hot_in_batch=3), suffixes.Layout(), suffixes.Layout(hot_strings=3), suffixes.Layout(300)])
def test_repeated_passages(spark, docs, layout):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeated_passages(clashing(docs), layout=layout).collect()}
    assert got == brute.passages([(r.doc_id, r.text) for r in docs.collect()], layout.span)


def test_repeated_passages_of_odd_rows(spark):
    rows = [(1, "ab" * 40), (1, "ab" * 40), (None, "ab" * 40), (0, None), (2, ""), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffixes.repeated_passages(df, layout=suffixes.Layout(20, 8)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in out) == [(0, 0), (0, 0), (1, 0), (80, 78), (80, 80), (80, 80)]
    assert [s.asDict() for r in out for s in r.spans if r.n_removed == 78] == [{"start": 2, "end": 80}]
    left = suffixes.remove(df.withColumn("row", F.lit(5)), layout=suffixes.Layout(20, 8))
    assert left.columns == ["doc_id", "text", "row"] and left.count() == 6
    assert suffixes.repeated_passages(df.limit(0)).count() == 0


def test_strings_of_a_common_gram_are_dealt_out(spark):
    """A gram in every tenth document: no batch has many of its strings, and yet they do not share a route."""
    rng = random.Random(9)
    filler = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    common = "the very same forty bytes in every tenth text"
    df = spark.createDataFrame([(i, filler(150) + (common if i % 10 == 0 else "") + filler(150)) for i in range(4000)], "rid long, text string").repartition(8)
    lay = suffixes.Layout(60, 16, hot_strings=100)
    hot = suffixes.hot_slots(df, lay)
    assert 0 < len(hot) < 50 and suffixes.hot_slots(df, suffixes.Layout(60, 16)) == [] == suffixes.hot_slots(df.limit(0), lay)
    found = df.mapInArrow(suffixes._emit_anchors(lay, hot), "route long, gram long, string long, rid long, lo long, hot boolean")
    largest = lambda c: found.groupBy(c).count().agg(F.max("count")).first()[0]
    assert largest("gram") >= 300 and largest("route") <= lay.hot_strings + 32 * 8  # the bound that hot_slots() states, of 8 tasks
    with pytest.raises(ValueError):
        suffixes.Layout(20, 32)


def test_column_order_sorts_suffixes():
    rng = np.random.default_rng(0)
    strings = [bytes(rng.integers(97, 100, rng.integers(1, 30)).tolist()) for _ in range(50)]
    data, offs = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0, *map(len, strings)])
    at = np.array([rng.integers(0, len(s)) for s in strings])
    for order, place, shared in suffixes.column_order(data, offs, at, 10):
        tails = [strings[i][p:] for i, p in zip(order, place)]
        assert tails == sorted(tails)
        for a, b, n in zip(tails, tails[1:], shared[1:]):
            common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert n == min(common, 10)


@pytest.mark.parametrize("percent", [80, 50])
def test_near_duplicates(spark, docs, percent):
    old = minhash._CHUNK, minhash._QUERIES
    minhash._CHUNK, minhash._QUERIES = 3, 2
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(clashing(docs), percent=percent, rows=2).collect()}
    finally:
        minhash._CHUNK, minhash._QUERIES = old
    sets = {r.doc_id: brute.shingles(r.text) for r in docs.collect()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    top = brute.classes(sets, links)
    assert got == {i: (len(s), top[i], top[i] == i) for i, s in sets.items()}
    assert minhash.keep(docs).columns == docs.columns


def test_near_duplicates_just_at_the_threshold_are_seen(spark):
    rows = []
    for i in range(4000):  # 28 of 35 shingles
        words = [f"p{i}w{j}" for j in range(39)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:32]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert minhash.keep(df, percent=80).where("doc_id % 2 = 1").count() == 0  # 1e-6 of 4000 pairs go unseen
    assert (minhash.bands_for(85, 6), minhash.bands_for(80, 6)) == (30, 46)


def test_near_duplicates_of_a_chain_meet_in_buckets(spark, monkeypatch):
    """A family far wider than a chunk, where few link with the centre: every link is still found."""
    monkeypatch.setattr(minhash, "_CHUNK", 20)
    monkeypatch.setattr(minhash, "_QUERIES", 15)
    seen = []
    mates = minhash._bucket_mates
    monkeypatch.setattr(minhash, "_bucket_mates", lambda *a: seen.append(1) or mates(*a))
    texts = {i: " ".join(f"w{j}" for j in range(3 * i, 3 * i + 60)) for i in range(150) if i % 40 < 37}  # each is like its neighbours alone
    texts |= {1000 + i: " ".join(f"c{j}" for j in range(60)) + f" x{i}" for i in range(70)}  # all alike, and in the same buckets
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, percent=80).collect()}
    sets = {i: brute.shingles(t) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert got == brute.classes(sets, links) and len(set(got.values())) == 5 and seen


def test_near_duplicates_of_odd_rows(spark):
    text = " ".join("abcdefgh")
    df = spark.createDataFrame([(3, text), (None, text), (5, text.upper()), (5, text), (6, None), (7, " \n"), (8, "a b"), (9, "A\tb")], "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    want = [(3, 4, 3, True), (5, 4, 3, False), (5, 4, 3, False), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 8, True), (9, 1, 8, False), (None, 4, None, True)]
    assert out == sorted(want, key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_are_dropped_by_row(spark):
    text, other = " ".join("abcdefgh"), " ".join("stuvwxyz")
    rows = [(3, text), (3, text), (3, other), (None, other), (None, "x y"), (1, "x y z"), (2, None), (2, None), (2, "")]
    left = minhash.keep(spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)))
    assert left.columns == ["doc_id", "text", "row"]
    want = [(3, text), (3, other), (None, "x y"), (1, "x y z"), (2, None), (2, None), (2, "")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True  # pack() is told of no added tokens here
    odd = spark.createDataFrame([(None, "x  y \n z", "en", "a", 0), (1, "it's\x1c 　 a  b", "en", "a", 0)], DOCS)
    df = docs.unionByName(odd).unionByName(docs.where("doc_id IN (2, 3)"))  # rows that repeat, too
    pieces = packing.pack(clashing(df), length=64).collect()
    sequences, docs_ = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append((p.offset, p.length))
        docs_[p.doc_id].append((p.start, p.length, bytes(p.ids), p.doc_tokens))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(sum(x[1] for x in s) < 64 for s in sequences.values()) <= 4  # one of each range at most
    want = collections.defaultdict(list)
    for r in df.collect():
        want[r.doc_id].append(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4"))
    assert set(want) == set(docs_)
    for key, held in docs_.items():
        # every piece is where its start says in one of the rows of its key, and the rows are covered once
        left = collections.Counter()
        for start, length, raw, total in held:
            assert any(len(ids) == total and ids[start : start + length].tobytes() == raw for ids in want[key])
            left.update((total, i) for i in range(start, start + length))
        assert left == sum((collections.Counter((len(ids), i) for i in range(len(ids))) for ids in want[key]), collections.Counter())
    assert sum(p.length for p in pieces) == sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in df.collect())
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_queries_take_added_tokens_inside_texts(spark, docs, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y ", "<|endoftext|", "\n<|endoftext|>\n<|endoftext|>é", " <|endoftext|> word " * 400]
    texts = dict(enumerate([r.text for r in docs.collect()] + odd))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["packing"]
    for out in (queries.QUERIES["op9_packing"](spark, str(tmp_path)), stage(spark, df, str(tmp_path))):
        pieces = collections.defaultdict(list)
        for p in out.collect():
            pieces[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        for i, text in texts.items():
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            at = 0
            for start, length, crc, total in sorted(pieces[i]):
                assert (start, total, crc) == (at, len(ids), zlib.crc32(ids[at : at + length].tobytes()))
                at += length
            assert at == len(ids)


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 3), (3, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = packing.hilbert_key(points, bits)
        assert sorted(keys) == list(range(len(points)))
        assert np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


@pytest.mark.parametrize("shards", [4, 200])
def test_sharding(spark, docs, shards):
    df = clashing(docs).unionByName(clashing(docs.where("doc_id < 5")))
    out = sharding.interleave(df, shards, rows_per_bucket=7).collect()
    n = len(out)
    assert n == df.count()
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())
    totals = collections.Counter(r.source for r in out)
    for rows in by.values():
        mixture = collections.Counter(r.source for r in rows)
        assert all(abs(mixture[s] - t * len(rows) / n) <= 2 for s, t in totals.items())
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in out:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, sharding.interleave(df.repartition(5), shards).collect()), key=str)
    assert sharding.interleave(df.limit(0), 3).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    frames = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA).cache()
        frames.append(docs)
    assert all(f.columns == columns for f in frames[:-1])
    classified, ruled, single, cleaned, packed = frames
    ids = lambda f: {r.doc_id for r in f.select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in classified.collect()}
    for i, text in texts.items():
        words, _, _, _, repeats = brute.base_counts(text)
        if words < 20 or 100 * repeats > 30 * words:
            assert i not in ids(ruled)
    sets = {r.doc_id: brute.shingles(r.text) for r in ruled.collect()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert ids(single) == set(brute.classes(sets, links).values())
    _, classified_ = None, classifier.classify(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))
    assert ids(classified) == ids(classified_.where("kept"))
    rest = brute.passages([(r.doc_id, r.text) for r in single.collect()], 100, text=True)
    assert {r.doc_id: r.text for r in cleaned.collect()} == rest
    assert all(r.n_chars == len(r.text) for r in cleaned.collect())
    assert ids(cleaned) == ids(single) == ids(packed)


def test_pipeline_stages_take_odd_rows_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    odd = [(None, None, None, None, None), (None, "", "en", "a", 0), (1, " \n", None, None, 0), (2, "short", "xx", "b", 5)]
    rows = made(40) + odd + made(40)[:5]  # nulls, empty texts, a long text, repeated rows
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    for name, data in (("odd", rows), ("none", [])):
        docs = spark.createDataFrame(data, DOCS).withColumn("family", F.lit("x")).withColumn("_row", F.lit(1))
        docs.coalesce(2).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.where("true" if data else "false").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, spark.read.parquet(f"{tmp_path}/{name}/documents.parquet") if k == 0 else docs, f"{tmp_path}/{name}").cache()
            assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        assert (docs.count() > 0) == bool(data)
    packed = corpus_pipeline.pack(spark, spark.createDataFrame(odd, DOCS), "")
    assert sorted((r.doc_id, r.doc_tokens) for r in packed.where("doc_id IS NOT NULL").collect()) == [(1, 3), (2, 2)]


def test_tokenizers_are_let_go_with_the_tables():
    path = vocabulary.default_path("byte_bpe_multi_50k.tiktoken")
    common.of_worker("first", lambda: vocabulary.byte_bpe(path))
    assert vocabulary.byte_bpe.cache_info().currsize == 1
    common.no_tables()
    assert vocabulary.byte_bpe.cache_info().currsize == 0 and not common._held
