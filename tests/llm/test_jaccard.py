from collections import defaultdict

import numpy as np
import pytest

from starloom.llm import jaccard as J
from starloom.llm.components import components
from tests.llm.helpers import DOCS, documents, no_docs, odd_docs

SF = "/root/testdata/sf0.01"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, n):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(docs, sim):
    """component by row number, from all pairs of rows that share a shingle."""
    sets = [shingles(t, sim.n) for t in docs]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in holders[g]:
                common[j] += 1
            holders[g].append(i)
        for j, c in common.items():
            if sim.den * c >= sim.num * (len(s) + len(sets[j]) - c):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))], [len(s) for s in sets]


def test_query_against_brute_force(spark):
    docs = documents(spark, SF)
    ids = sorted(docs)
    roots, sizes = brute([docs[i] for i in ids], J.Similarity(3, 90, 100))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.op1_jaccard_join(spark, SF).collect()}
    assert got == {i: (n, ids[r]) for i, n, r in zip(ids, sizes, roots, strict=True)}
    assert len({c for _, c in got.values()}) < len(ids)


def near_copies(rng, n_groups, per_group, words=60):
    """Texts that differ from their group's base in up to a few words, added, dropped or changed."""
    rows = []
    for g in range(n_groups):
        base = [f"w{x}" for x in rng.integers(0, 500, words)]
        for _ in range(per_group):
            w = list(base)
            for _ in range(int(rng.integers(0, 5))):
                at = int(rng.integers(0, len(w)))
                w[at:at + int(rng.integers(0, 2))] = [f"x{rng.integers(0, 50)}"] * int(rng.integers(0, 2))
            rows.append(" ".join(w))
    return rows


@pytest.mark.parametrize("sim", [J.Similarity(3, 90, 100), J.Similarity(5, 80, 100), J.Similarity(1, 1, 2)])
def test_groups_of_near_copies_against_brute_force(spark, sim, monkeypatch):
    rng = np.random.default_rng(sim.num)
    texts = near_copies(rng, 4, 40) + near_copies(rng, 10, 3, 12) + near_copies(rng, 3, 4, 400) + ["a b", "a b", "", None, "c"]
    monkeypatch.setattr(J, "BLOCK", 16)  # several blocks to a group
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    roots, sizes = brute(texts, sim)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.similar_documents(df, sim).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}
    kept = {r["doc_id"] for r in J.keep_one(df, sim).collect()}
    assert kept == {i for i in range(len(texts)) if roots[i] == i}


@pytest.mark.parametrize("sim", [J.Similarity(3, 90, 100), J.Similarity(5, 80, 100)])
@pytest.mark.parametrize("crowd", [1.0, 1e4, 1e9])
def test_every_linked_pair_shares_a_probed_signature(sim, crowd):
    """For few and very many sets, that is with few and many tolerant segments."""
    scheme = J.Scheme(sim, {k: crowd for k in range(30)})
    rng = np.random.default_rng(7)
    linked = 0
    for _ in range(1500):
        size = int(rng.integers(2, 260))
        a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        gone, new = (int(x) for x in rng.integers(0, size // 6 + 2, 2))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2**64, new, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or both == len(a) == len(b) or sim.den * both < sim.num * (len(a) + len(b) - both):
            continue
        linked += 1
        (x, nx), (y, ny) = J.signatures(a, scheme), J.signatures(b, scheme)
        assert set(x[:nx].tolist()) & set(y.tolist()) or set(y[:ny].tolist()) & set(x.tolist())
        assert J.may_link(len(a), len(b), J.bitmap(a).tobytes(), J.bitmap(b).tobytes(), sim) is not None
    assert linked > 100


def test_allotment_covers_and_turns_tolerant_in_a_crowd():
    for most in (1, 2, 7, 40):
        for n in (1.0, 1e6, 1e12):
            m, d = J.allot(most, most * 9.0, n)
            assert m + d == most + 1 and 0 <= d <= m
    assert J.allot(40, 100, 1e12)[1] > J.allot(40, 100, 10)[1]


def test_bitmaps_of_different_lengths_still_bound_the_difference():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 2**64, 3300, dtype=np.uint64))
    b = a[:len(a) - 200]
    for x, y in ((a, b), (a, a[:790])):
        fx, fy = J.bitmap(x), J.bitmap(y)
        w = min(len(fx), len(fy))
        assert int(np.bitwise_count(J.fold(fx, w) ^ J.fold(fy, w)).sum()) <= len(x) - len(y)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), **dict.fromkeys(range(200, 209), 200)}


def test_odd_rows_and_empty_table(spark):
    sim = J.Similarity(3, 90, 100)
    rows = J.similar_documents(odd_docs(spark), sim).collect()
    assert len(rows) == 11
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_shingles"] == by[3]["n_shingles"] == by[4]["n_shingles"] == 0 and by[2]["component_id"] == 2
    assert by[None]["component_id"] is None and by[6]["n_shingles"] == 1 and by[7]["n_shingles"] == 1
    kept = J.keep_one(odd_docs(spark), sim)
    assert kept.columns == odd_docs(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "5", "6", "7", "8", "None"]
    assert J.similar_documents(no_docs(spark), sim).count() == 0 and J.keep_one(no_docs(spark), sim).count() == 0
