import collections
import hashlib
import itertools
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import divergence, infill, queries, url_rules
from millrace.llm import textnum as tn
from tests.llm.test_llm import DOCS, made
from tests.oracle import DATA, assert_same, connection

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op11_urls", "op12_infill", "op13_divergence"])
def test_queries_equal_their_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, DATA), queries.ORACLES[name], connection())


# fill-in-middle


def infilled(key, text, seed=42, percent=50, spm_percent=80):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    parts = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, None, text
    prefix, middle, suffix = parts
    if h[3] % 100 < spm_percent:
        return len(units), "spm", *parts, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", *parts, f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["", " ", "\n\n", "a", " a", "a ", "\x0b\x1c a\x85b ", "é", "漢 字", "🎉🎉 🎉", "a\u00a0b c", "x" * 100_000, " \t".join(["word"] * 40_000), "in <P> it", "<", "<S", "P>", "\x00 \x7f"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x0c\r\x08\x0e\x1fab\x80é漢🎉\x00", max_size=40), max_size=12), st.randoms(use_true_random=False))
def test_units_of_a_batch_are_those_of_the_pattern(texts, rng):
    first, second = (np.array([rng.randrange(1 << 32) for _ in texts], dtype=np.int64) for _ in range(2))
    n, head, tail = infill.cut_places(pa.array(texts, pa.string()), first, second)
    for k, text in enumerate(texts):
        units = UNITS.findall(text)
        a, b = sorted((int(first[k]) % (len(units) + 1), int(second[k]) % (len(units) + 1)))
        assert (n[k], head[k], tail[k]) == (len(units), len("".join(units[:a]).encode()), len("".join(units[:b]).encode()))


def test_every_unit_of_a_text_can_be_cut_at():
    text = "".join(random.Random(3).choices(" \n\tab é漢", k=300))
    units, data = UNITS.findall(text), np.frombuffer(text.encode(), np.uint8)
    ends = infill.UnitEnds(data, np.array([0, len(data)]))
    places = np.cumsum([len(u.encode()) for u in units])
    assert ends.after(np.arange(1, len(units) + 1)).tolist() == places.tolist()
    assert ends.before(np.arange(len(data) + 1)).tolist() == np.searchsorted(places, np.arange(len(data) + 1), "right").tolist()


@pytest.mark.parametrize("percent", [0, 50, 100])
def test_infill_equals_the_plain_version_and_is_reversible(spark, percent):
    rows = [(k, t, "en", "a", 0) for k, t in enumerate([None, *ODD])] + [(None, "null key here", None, None, None)] * 2 + made(150, 4)
    docs = spark.createDataFrame(rows, DOCS).withColumn("form", F.lit(1)).withColumn("prefix", F.lit("x")).repartition(3)
    out = infill.transform(docs, percent=percent).withColumn("again", infill.restore(F.col("output"), F.col("form"))).collect()
    found = collections.Counter((r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.suffix, r.output) for r in out)
    assert found == collections.Counter((k, t or "", *infilled(k, t, percent=percent)) for k, t, *_ in rows)
    assert all(r.again == r.text for r in out)
    if percent == 100:
        assert {r.form for r in out} == {"plain", "spm", "psm"}


def test_infill_of_an_empty_table(spark):
    assert infill.transform(spark.createDataFrame([], DOCS)).collect() == []


# URL rules


def url_tokens(url):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after).group().translate(UPPER)
    path = re.match(r"[^/?#]*([^?#]*)", after).group(1)
    rest = after[len(re.match(r"[^?#]*", after).group()) :]
    parts = (("h", host), ("p", path.translate(UPPER)), ("q", rest.translate(UPPER)))
    words = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    return host, path, {f"{k}:{w}" for k, part in parts for w in words.findall(part) if not re.fullmatch("[0-9]+", w)}


def judged(pages, labels, rules, support, least, confidence):
    marks = {}
    for doc, bad in labels:
        if doc is not None:
            marks[doc] = marks.get(doc, False) or bool(bad)
    labelled = []
    for _, url in pages:
        _, path, tokens = url_tokens(url)
        number = re.search(r"/([0-9]{1,18})(?:/|\.[^/]*)?$", path)
        if number and int(number.group(1)) in marks:
            labelled.append((tokens, marks[int(number.group(1))]))
    floor = max(least, -(-len(labelled) * support // 1))
    everywhere = collections.Counter()
    for tokens, bad in labelled:
        if bad:
            for k in range(1, len(tokens) + 1):
                everywhere.update(map(frozenset, itertools.combinations(sorted(tokens), k)))
    mined = [s for s, n in everywhere.items() if n >= floor and n >= confidence * sum(s <= t for t, _ in labelled)]
    out = []
    for page, url in pages:
        host, path, tokens = url_tokens(url)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.host + r.path), default=None)
        verdict = best.verdict if best else "block" if any(s <= tokens for s in mined) else "allow"
        out.append((page, host, path, best and best.host + best.path, verdict))
    return collections.Counter(out), mined


RULES = queries.HOST_RULES
PAGES = "page_id long, url string, verdict string, shape string, mined int"


def url_fixture(seed=5, n=500):
    rng = random.Random(seed)
    pages, labels = [], []
    for k in range(n):
        host = rng.choice(["casino-win", "shop", "news", "blog.casino", "ÉCOLE"]) + "." + rng.choice(["org", "example.org", "EXAMPLE.com", "net"])
        tail = rng.choice(["", "/", ".html", "?ref=bets", "#top", "?a=1&b=free-bets"])
        pages.append((k, f"http{rng.choice(['', 's'])}://{host}/{rng.choice(['en', 'es', 'fr'])}/{rng.choice(['slots', 'poems'])}/{k}{tail}"))
        bad = ("casino" in host and "slots" in pages[-1][1]) or "bets" in tail
        if rng.random() < 0.6:
            labels.append((k, bad if rng.random() < 0.9 else not bad))
    labels += [(3, None), (None, True), (3, True), (10**9, True)]
    odd = [None, "", "no scheme", "://", "http://", "http://x", "http://a.com", "http://a.com/", "http://com/", "http://notcom/", "http://A.Example.COM/en/x?y=http://z.net/es/", "http://www.example.com/en/1", "http://example.com/EN/", "http://b.net/fr/#a\nb", "a://b://c/7"]
    return pages + [(1000 + k, u) for k, u in enumerate(odd)] + [(None, "http://casino-win.org/en/slots/3")] * 2 + pages[:40], labels


@pytest.mark.parametrize(("support", "least", "confidence"), [(0.02, 5, 0.5), (0.1, 1, 0.8), (0.0, 8, 0.95)])
def test_urls_are_judged_like_the_plain_version(spark, support, least, confidence):
    pages, labels = url_fixture()
    frame = spark.createDataFrame([(*p, "x", "y", 1) for p in pages], PAGES).repartition(3)
    out = url_rules.judge(frame, spark.createDataFrame(labels, "doc_id long, bad boolean"), RULES, support=support, least=least, confidence=confidence)
    want, mined = judged(pages, labels, RULES, support, least, confidence)
    assert mined and collections.Counter(map(tuple, out.collect())) == want
    assert {r[4] for r in want if r[3] is None} == {"allow", "block"}


def test_mined_rules_are_the_smallest(spark):
    pages, labels = url_fixture()
    marks = spark.createDataFrame(labels, "doc_id long, bad boolean").where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    rows = spark.createDataFrame([(" ".join(sorted(url_tokens(u)[2])), k) for k, u in pages if k is not None and k < 500], "shape string, doc_id long")
    rules = url_rules.mine(rows.join(marks, "doc_id"), support=0.02, least=5, confidence=0.8, longest=16).collect()
    found = [frozenset(r.antecedent) for r in rules]
    _, mined = judged([p for p in pages if p[0] is not None and p[0] < 500], labels, RULES, 0.02, 5, 0.8)
    assert set(found) == {s for s in mined if not any(t < s for t in mined)} and len(found) == len(set(found))
    assert frozenset({"q:bets"}) in found and frozenset({"h:casino", "p:slots"}) in found
    assert all(r.token in r.antecedent and 0.8 <= r.confidence <= 1 and r.n_bad >= 5 for r in rules)


@pytest.mark.parametrize("longest", [1, 16])
def test_tokens_of_long_urls_are_all_mined(spark, longest):
    """Tokens that each go less with bad labels than 16 others of their URL, and only together always."""
    rng = random.Random(3)
    words = [f"p:w{chr(97 + k)}" for k in range(18)]
    rows = [(" ".join(sorted([*words, "p:ya", "p:yb", f"q:u{chr(97 + k)}"])), True) for k in range(6)]
    rows += [(" ".join(sorted([y, *(w for w in words if rng.random() < 0.6)])), False) for y in ("p:ya", "p:yb") for _ in range(40)]
    rows += [(" ".join(sorted(rng.sample(words, 4))), k % 2 == 0) for k in range(60)]
    sets = [(frozenset(s.split()), bad) for s, bad in rows]
    found = url_rules.mine(spark.createDataFrame(rows, "shape string, bad boolean"), support=0.0, least=5, confidence=0.8, longest=longest).collect()
    counts = {frozenset(r.antecedent): r for r in found}
    assert frozenset({"p:ya", "p:yb"}) in counts and len(counts) == len(found)
    tokens = sorted({t for s, _ in sets for t in s})
    want = set()
    for size in range(1, 4):
        level = [frozenset(c) for c in itertools.combinations(tokens, size) if sum(bad for s, bad in sets if s >= set(c)) >= 5]
        want |= {c for c in level if sum(b for s, b in sets if s >= c) >= 0.8 * sum(s >= c for s, _ in sets) and not any(w < c for w in want)}
    assert {c for c in counts if len(c) < 4} == want
    for c, r in counts.items():
        assert r.n_bad == sum(b for s, b in sets if s >= c) and r.confidence == r.n_bad / sum(s >= c for s, _ in sets) and r.token in c
        assert not any(w < c for w in counts)


def test_long_equal_urls_do_not_make_all_their_subsets(spark):
    url = "http://h.org/" + "/".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)) + "/"
    pages = spark.createDataFrame([(k, url + str(k)) for k in range(40)], "page_id long, url string")
    labels = spark.createDataFrame([(k, True) for k in range(30)], "doc_id long, bad boolean")
    assert {r.verdict for r in url_rules.judge(pages, labels, [], longest=8).collect()} == {"block"}


def test_urls_of_empty_tables(spark):
    none, labels = spark.createDataFrame([], PAGES), spark.createDataFrame([], "doc_id long, bad boolean")
    assert url_rules.judge(none, labels, RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/1")], "page_id long, url string")
    assert [tuple(r) for r in url_rules.judge(one, labels, RULES).collect()] == [(1, "a.org", "/1", None, "allow")]


# divergence


def audited(rows, least_docs, top, scale=10**9):
    counts, docs, occurring = collections.Counter(), collections.Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERMS.findall((text or "").translate(UPPER))
        occurring.add((lang, source))
        for t in terms:
            counts[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = set()
    for lang in {g[0] for g in occurring}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least_docs]
        sources = [s for x, s in occurring if x == lang]
        inside = {s: {t: counts[lang, s, t] for t in kept} for s in sources}
        whole = {t: sum(inside[s][t] for s in sources) for t in kept}

        def shares(c):
            return {t: 1 + scale * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()}

        p, q = {s: shares(inside[s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            parts = [("pair", [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s])]
            parts.append(("term", sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if inside[s][t] and p[s][t] > q[t])[:top]))
            for part, found in parts:
                out |= {(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(sorted(found), 1)}
    return out


@pytest.mark.parametrize(("least_docs", "top", "seed"), [(10, 10, 1), (2, 3, 2), (1, 1, 3), (10**6, 10, 4)])
def test_divergence_equals_the_plain_version(spark, least_docs, top, seed):
    rows = made(200, seed) + [(k, t, "en", "odd", 0) for k, t in enumerate(["A-b\x00C d1e ÉÀ éà", "ﬁ Straße İ", None, "", "_ @[`{", "x" * 50_000])] * 2 + [(1, None, "qq", None, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit("x")).withColumn("term", F.lit(2)).withColumn("p0", F.lit(2)).repartition(5)
    found = divergence.audit(docs, least_docs=least_docs, top=top).collect()
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == audited(rows, least_docs, top)


def test_divergence_when_tasks_hold_little(spark, monkeypatch):
    rows = made(120, 6)

    def small(name, value):  # the functions run in workers that read their module's values
        monkeypatch.setattr(divergence, name, value)

    counts = []
    for held, block in ((1 << 20, 1 << 16), (50, 7)):
        small("_HELD", held)
        small("_BLOCK", block)
        batch = pa.table({"lang": ["en"] * len(rows), "source": [r[3] or "" for r in rows], "text": [r[1] or "" for r in rows]}).to_batches(10)
        partial = pa.Table.from_batches(list(divergence._counted(iter(batch))))
        sums = partial.group_by(["source", "term"]).aggregate([("n", "sum"), ("docs", "sum")]).sort_by([("term", "ascending"), ("source", "ascending")])
        source, term = sums["source"].to_pylist(), sums["term"].to_pylist()
        ones = pa.table({"lang": ["en"] * len(source), "source": source, "term": term, "p": pa.array(sums["n_sum"].to_pylist(), pa.int64()), "p0": pa.array([1] * len(source), pa.int64())})
        pairs = collections.Counter()
        for b in divergence._corrected(iter(ones.to_batches(13))):
            for x in b.to_pylist():
                pairs[x["source"], x["item"]] += x["value"]
        counts.append((sorted(zip(source, term, sums["n_sum"].to_pylist(), sums["docs_sum"].to_pylist())), pairs))
    assert counts[0] == counts[1]


def test_corrections_in_a_new_worker():
    """A worker that has run nothing else has no more of pyarrow than this module imports; rows come to it as an Arrow stream."""
    ones = pa.table({"lang": ["en"] * 5, "source": ["s", "t", "u", "s", "t"], "term": ["a", "a", "a", "b", "b"], "p": pa.array([50, 30, 10, 20, 90], pa.int64()), "p0": pa.array([10] * 5, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ones.schema) as writer:
        writer.write_table(ones, max_chunksize=2)
    code = """if True:
        import sys
        import pyarrow as pa
        from millrace.llm import divergence
        divergence._BLOCK = 4
        batches = pa.ipc.open_stream(sys.stdin.buffer)
        print(sorted(tuple(row.values()) for b in divergence._corrected(batches) for row in b.to_pylist()))"""
    ran = subprocess.run([sys.executable, "-c", code], input=sink.getvalue().to_pybytes(), capture_output=True, cwd=Path(__file__).parents[2], timeout=120)
    assert ran.returncode == 0, ran.stderr.decode()[-2000:]
    f = lambda a, b: (a - b) ** 2 // (a + b)
    more = lambda a, b: f(a, b) - f(a, 10) - f(10, b)
    assert ran.stdout.decode().strip() == str([("en", "s", "t", more(50, 30) + more(20, 90)), ("en", "s", "u", more(50, 10)), ("en", "t", "u", more(30, 10))])


def test_ties_are_ranked_by_bytes(spark):
    rows = [(1, "é z a Ω", "en", "s", 0), (2, "é z a Ω", "en", "s", 0), (3, "é z a Ω q", "en", "t", 0), (4, "q", "en", "t", 0)]
    found = divergence.audit(spark.createDataFrame(rows, DOCS), least_docs=2, top=3).where("part = 'term' AND source = 's'").orderBy("rank")
    assert [r.item for r in found.collect()] == ["a", "z", "é"]
    assert {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, DOCS), least_docs=2, top=3).collect()} == audited(rows, 2, 3)


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_terms_end_with_their_text():
    data, offs = tn.buffers(pa.array(["ab", "cd", None, "", "1e", "É"]))
    words, doc = divergence.terms_of(data, offs)
    assert (words.to_pylist(), doc.tolist()) == (["ab", "cd", "e", "É"], [0, 1, 4, 5])
