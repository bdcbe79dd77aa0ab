import itertools

import numpy as np

from starloom.llm import decontam as D
from starloom.llm.common import bloom_filter, in_filter, open_filter
from tests.llm.helpers import DOCS, documents, no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def test_masks_hit_thirteen_words_with_any_two_substituted():
    places = [{j + at for j, bit in enumerate(m) if bit == "1"} for m in D.MASKS for at in range(13 - len(m) + 1)]
    for gone in itertools.combinations(range(13), 2):
        assert any(not p & set(gone) for p in places), gone


def test_masks_hit_every_overlap_that_counts():
    """Whole items of 3 to 12 words, and windows of 13 to 25: a longer one holds a shorter one that counts."""
    for n in range(3, 26):
        places = [sum(1 << j + at for j, bit in enumerate(m) if bit == "1") for m in D.masks_of(n) for at in range(n - len(m) + 1)]
        for gone in (g for k in range(n // 5 + 1) for g in itertools.combinations(range(n), k)):
            spoilt = sum(1 << j for j in gone)
            if all(p & spoilt for p in places):
                inner = [(i, j) for i in range(n) for j in range(i + 13, n + 1) if j - i < n]
                assert any(5 * sum(i <= g < j for g in gone) <= j - i for i, j in inner), (n, gone)


def test_short_items_and_null_item_ids(spark):
    rows, bench, want = [], [(None, " ".join(f"n{j}" for j in range(16)))], {(1, None)}
    rows.append((1, "a b " + bench[0][1] + " c d", None, None, None))
    for n in range(3, 16):
        item = [f"i{n}x{j}" for j in range(n)]
        bench.append((n, " ".join(item)))
        k = 3 if n == 15 else n // 5
        for at, gone in enumerate((*itertools.combinations(range(n), k), tuple(range(k + 1)) if n < 13 else None)):
            if gone is None:
                continue
            w = ["changed" if j in gone else x for j, x in enumerate(item)]
            rows.append((n * 1000 + at, " ".join(["left", "of", *w, "right", "of"]), None, None, None))
            if len(gone) == k:
                want.add((n * 1000 + at, n))
    found = D.contaminated(spark.createDataFrame(rows, DOCS), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want)


def brute(docs, items, rule=D.Rule()):
    """(doc, item) with an alignment that verifies, over all alignments."""
    out = set()
    words = {k: D.words_of((t or "").encode()) for k, t in docs.items()}
    for i, t in items.items():
        item = D.words_of((t or "").encode())
        if len(item) < D.MIN_ITEM:
            continue
        for k, w in words.items():
            if len(np.intersect1d(w, item)) < 5:
                continue
            if any(D.overlap(w, item, s, rule) for s in range(-len(item) + 5, len(w))):
                out.add((k, i))
    return out


def test_query_against_all_alignments(spark):
    docs = documents(spark, SF)
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    some = {k: v for k, v in docs.items() if len(v or "") < 2500}  # the plain version is quadratic in a text's length
    got = {(r["doc_id"], r["item_id"]) for r in D.op3_decontaminate(spark, SF).collect()}
    assert {x for x in got if x[0] in some} == brute(some, items)
    assert got


def test_substituted_passages_are_caught_and_short_common_phrases_are_not(spark):
    rng = np.random.default_rng(3)
    item = [f"b{i}" for i in range(30)]
    filler = lambda n: [f"f{x}" for x in rng.integers(0, 1000, n)]
    rows, leaked = [], []
    for i in range(60):
        w = list(item)
        for at in rng.permutation(30)[:i % 6]:  # up to a sixth of the words
            w[at] = "changed"
        rows.append((i, " ".join(filler(20) + w + filler(20)), None, None, None))
        leaked.append(i)
    rows += [(100, " ".join(filler(20) + item[5:11] + filler(20)), None, None, None),
             (101, " ".join(filler(200)), None, None, None),
             (102, " ".join(item[8:22]).upper(), None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "too short an item"), (3, None), (None, "x " * 20)], "item_id long, text string")
    found = D.contaminated(df, bench).collect()
    assert {r["doc_id"] for r in found} == {*leaked, 102}
    assert all(r["n_equal"] >= 0.8 * r["n_words"] and 13 <= r["n_words"] <= 30 for r in found)
    assert next(r for r in found if r["doc_id"] == 0).asDict().items() >= {"first_word": 20, "n_words": 30, "n_equal": 30}.items()
    kept = D.clean(df, bench)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {100, 101}


def test_overlap_at_the_edges():
    item = np.arange(20, dtype=np.uint64)
    assert D.overlap(item[6:], item, -6) == (0, 14, 14)
    assert D.overlap(np.concatenate([item[:13] + np.uint64(100), item[:13]]), item, 13) == (13, 13, 13)
    assert D.overlap(item[:12], item, 0) is None
    short = np.arange(8, dtype=np.uint64)
    assert D.overlap(short, short, 0) == (0, 8, 8)


def any_window(doc, item, shift, rule=D.Rule()):
    """Whether a run of the alignment holds, each window's equal words counted by themselves."""
    need = min(rule.min_words, len(item))
    eq = [0 <= shift + j < len(doc) and doc[shift + j] == item[j] for j in range(len(item))]
    inside = [j for j in range(len(item)) if 0 <= shift + j < len(doc)]
    lo, hi = (inside[0], inside[-1] + 1) if inside else (0, 0)
    return any(10 * sum(eq[i:j]) >= 8 * (j - i) for i in range(lo, hi) for j in range(i + need, hi + 1))


def test_overlap_finds_every_window_that_holds():
    item = np.arange(40, dtype=np.uint64)
    for n in (13, 14, 16):  # a passage inside a longer item and document
        for gone in (g for k in (1, 2) for g in itertools.combinations(range(n), k)):
            doc = np.full(60, 999, np.uint64)
            doc[20:20 + n] = item[12:12 + n]
            doc[[20 + g for g in gone]] = 998
            assert D.overlap(doc, item, 8), (n, gone)
    rng = np.random.default_rng(5)
    kinds = {True: 0, False: 0}
    for _ in range(3000):
        m, w = int(rng.integers(1, 40)), int(rng.integers(1, 50))
        a, shift = rng.integers(0, 50, m).astype(np.uint64), int(rng.integers(-m, w))
        doc = np.full(w, 999, np.uint64)
        for j in range(m):
            if 0 <= shift + j < w and rng.random() < rng.choice([0.7, 0.85]):
                doc[shift + j] = a[j]
        got, want = D.overlap(doc, a, shift), any_window(doc, a, shift)
        kinds[want] += 1
        assert bool(got) == want
        if got:
            first, n, same = got
            assert n >= min(13, m) and same == (doc[first:first + n] == a[first - shift:first - shift + n]).sum() >= 0.8 * n
    assert min(kinds.values()) > 300


def test_query_against_all_windows(spark):
    """The query's documents, with overlaps counted without the operator's own check."""
    docs = documents(spark, SF)
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    words = {k: D.words_of((v or "").encode()) for k, v in docs.items() if len(v or "") < 1500}
    want = set()
    for i, t in items.items():
        item = D.words_of(t.encode())
        for k, w in words.items():
            if np.isin(item, w).sum() < 8:
                continue
            shifts = (np.flatnonzero(w[:, None] == item[None, :]))
            counts = np.unique(shifts // len(item) - shifts % len(item), return_counts=True)
            if any(any_window(w, item, int(s)) for s, n in zip(*counts, strict=True) if n >= min(11, 0.8 * len(item))):
                want.add((k, i))
    got = {(r["doc_id"], r["item_id"]) for r in D.op3_decontaminate(spark, SF).collect()}
    assert {x for x in got if x[0] in words} == want and want


def test_filter_has_no_false_negatives(spark):
    h = [int(x) for x in np.random.default_rng(1).integers(-2**63, 2**63, 5000)]
    bits = open_filter(bloom_filter(spark.createDataFrame([(x,) for x in h], "h long")))
    assert in_filter(bits, np.array(h, np.int64).view(np.uint64)).all()
    assert in_filter(bits, np.random.default_rng(2).integers(0, 2**64, 20000, dtype=np.uint64)).mean() < 0.01


def test_odd_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "the cat sat on the mat and looked at the dog for a long while"), (1, "mail me")], "item_id long, text string")
    rows = D.contaminated(odd_docs(spark), bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(1, 1)]
    assert D.clean(odd_docs(spark), bench).count() == 9
    assert D.contaminated(no_docs(spark), bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(odd_docs(spark), empty).count() == 0 and D.clean(odd_docs(spark), empty).count() == 11
