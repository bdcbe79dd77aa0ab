import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import ranked
from tests.llm.helpers import no_docs, odd_docs

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(ASCII))


def plain(docs, queries, k=20):
    """All scores of all documents, in Python's integers."""
    bags = [(d, terms(t)) for d, t in docs]
    bags = [(d, Counter(t), len(t)) for d, t in bags if t]
    n_docs, length = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in queries:
        asked, scored = terms(text), []
        for d, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in asked if t in bag)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def found(docs, queries, **kw):
    return [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranked.search(docs, queries, **kw).collect()]


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_terms(text):
    assert [t.decode() for t in ranked.terms(text.encode())] == terms(text)


@given(st.integers(0, 10**6), st.integers(1, 5), st.sampled_from([1, 2, 7, 256]))
@settings(max_examples=150, deadline=None)
def test_no_document_is_missed(seed, k, step):
    rng = random.Random(seed)
    n, v = rng.randrange(1, 60), rng.randrange(1, 12)
    post = [(d, t, rng.choice([1, 1, 2, 9])) for d in range(n) for t in range(v) if rng.random() < (t + 1) / v / 1.5]
    doc, term, tf = (np.array(x, np.int64) for x in zip(*post, strict=True)) if post else (np.empty(0, np.int64),) * 3
    m, w = np.array([rng.choice([80, 100, 300]) for _ in range(n)], np.int64), np.array([rng.choice([0, 5, 900, 4000]) for _ in range(v)], np.int64)
    query = [(t, rng.choice([1, 2])) for t in range(v) if rng.random() < 0.7]
    old, ranked.STEP = ranked.STEP, step
    try:
        d, score, looked = ranked.Shard(doc, term, tf, m, w).search(query, k)
    finally:
        ranked.STEP = old
    want = Counter()
    for a, t, f in post:
        want[a] += dict(query).get(t, 0) * int(w[t]) * ((10**9 * f) // (1000 * f + 12 * int(m[a])))
    top = sorted((-s, a) for a, s in want.items() if s > 0)[:k]
    assert sorted((-int(s), int(a)) for a, s in zip(d, score, strict=True))[:k] == top
    assert all(want[int(a)] == s for a, s in zip(d, score, strict=True)) and looked <= n


def test_reading_stops_when_the_rest_cannot_win(monkeypatch):
    """A rare term's few documents decide; the common term's list is not read to its end."""
    monkeypatch.setattr(ranked, "STEP", 16)
    n = 5000
    doc, term = np.concatenate([np.arange(n), np.arange(30)]), np.repeat([0, 1], [n, 30])
    s = ranked.Shard(doc, term, np.ones(n + 30, np.int64), np.full(n, 100, np.int64), np.array([10, 8000]))
    d, score, looked = s.search([(0, 1), (1, 1)], 20)
    assert looked < 100 and set(range(20)) <= set(d.tolist())
    _, _, more = s.search([(0, 1), (1, 1)], 20, floor=int(score.max()) + 1)
    assert more <= looked


def test_best_positions_run_ahead_of_reading(monkeypatch):
    """Both lists hold the same documents in the same order: direct accesses mark the other list's head, which is not read again."""
    monkeypatch.setattr(ranked, "STEP", 1)
    n = 100
    doc, term = np.tile(np.arange(n), 2), np.repeat([0, 1], n)
    s = ranked.Shard(doc, term, np.tile(np.arange(n, 0, -1), 2), np.full(n, 100, np.int64), np.array([1000, 1000]))
    *_, looked = s.search([(0, 1), (1, 1)], 5)
    assert looked == 5  # what stands below the gapless five cannot tie


def test_every_item(spark, monkeypatch):
    monkeypatch.setattr(ranked, "SHARD_DOCS", 70)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranked.op11_ranked_search(spark, SF).collect()]
    same(got, plain(docs, items))


def test_blocks_of_queries_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 200)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 9)))) for i in range(120)]
    items = [(i % 150, " ".join(rng.choices([*words, "absent"], k=4))) for i in range(200)]
    got = found(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), k=7)
    same(got, plain(docs, items, 7))


def test_odd_rows_and_empty_tables(spark):
    items = [(1, "The CAT sat, the dog"), (1, "The CAT sat, the dog"), (None, "word über 日本語"), (3, None), (4, ""), (5, "\n ."), (6, "nowhere"), (7, "word " * 100_000)]
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' qid", "'y' rank")
    docs = odd_docs(spark)
    same(found(docs, q), plain([(r["doc_id"], r["text"]) for r in docs.collect()], items))
    assert found(no_docs(spark), q) == [] and found(docs, q.where("false")) == []
    tied = found(spark.createDataFrame([(None, "a b"), (None, "a b"), (2, "a b")], "doc_id long, text string"),
                 spark.createDataFrame([(1, "a a b")], "item_id long, text string"))
    assert [r[2] for r in sorted(tied, key=lambda r: r[1])] == [2, None, None]
