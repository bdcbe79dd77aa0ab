from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import packing as P
from tests.llm.helpers import documents, no_docs, odd_docs

SF = "/root/testdata/sf0.01"
CAPS = (8, 16, 40)


def one_by_one(lengths, caps):
    """Best-fit decreasing with a list of bins: their spaces and contents."""
    bins = []
    for x, n in sorted(Counter(lengths).items(), reverse=True):
        left = n
        while left:
            fit = min((b for b in bins if b[0] >= x), default=None, key=lambda b: b[0])
            if fit:
                fit[0] -= x
                fit[1] += x
                left -= 1
                continue
            cap = min((c for c in caps if c >= x), key=lambda c: (P.cost(c) / (c // x * x), c))
            while left:
                k = min(left, cap // x)
                bins.append([cap - k * x, k * x])
                left -= k
    return bins


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=200, deadline=None)
def test_runs_of_equal_pieces_pack_as_one_by_one(lengths):
    plan = P.best_fit(dict(Counter(lengths)), CAPS)
    used, seen = Counter(), Counter()
    for x in lengths:
        b = int(plan.bins(np.array([x]), np.array([seen[x]]))[0])
        seen[x] += 1
        used[b] += x
    assert len(used) == plan.n_bins and all(v <= 40 for v in used.values())
    want = one_by_one(lengths, CAPS)
    assert len(want) == plan.n_bins and sorted(b[1] for b in want) == sorted(used.values())


def check(rows, lengths, caps):
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin"]].append(r)
    for b in bins.values():
        b.sort(key=lambda r: r["bin_start"])
        at = 0
        for r in b:
            assert r["bin_start"] == at
            at += r["n_tokens"]
        assert {r["bin_used"] for r in b} == {at} and {r["bin_size"] for r in b} == {min(c for c in caps if c >= at)}
    assert sorted(bins) == list(range(len(bins)))
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
        assert r["piece_start"] == r["piece"] * caps[-1]
    assert got == lengths


def test_query_packs_every_token_once(spark):
    docs = documents(spark, SF)
    rows = P.op6_best_fit(spark, SF).collect()
    check(rows, Counter({k: len((v or "").encode()) + 1 for k, v in docs.items()}), P.CAPACITIES)
    sizes = {r["bin"]: r["bin_size"] for r in rows}
    assert sum(r["n_tokens"] for r in rows) > 0.95 * sum(sizes.values())
    assert len(set(sizes.values())) > 1


def test_odd_rows_long_texts_and_empty_table(spark):
    rows = P.pack(odd_docs(spark), capacities=(16, 64, 1000)).collect()
    want = Counter()
    for r in odd_docs(spark).collect():
        want[r["doc_id"]] += len((r["text"] or "").encode()) + 1
    check(rows, want, (16, 64, 1000))
    assert max(r["piece"] for r in rows) == 15
    assert P.pack(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        P.best_fit({50: 1}, (10, 40))
