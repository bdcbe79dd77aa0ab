import hashlib
import re

import numpy as np
import pytest

from starloom.llm import pii
from tests.llm.helpers import documents, no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def plain(text):
    """The patterns as they are given."""
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [(s, pii.KINDS[k], e) for s, k, e in sorted(out)]


CASES = ["", "a@b", "a@b.c", "x a.b+c@d-e.f.gh, y@z.", "@@a@b.c@d.e", "a@b.c-@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.0004",
         "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "+1 (269) 555-5822", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "+49.30.1234567.",
         "+1 (555", "1" * 5000, "a" * 3000 + "@" + "b" * 3000, "+" + "1 " * 900, "é@é.fr mé@ex.fr", "12a@1.2.3.4", "1.2.3.4@h.com"]


@pytest.mark.parametrize("text", CASES)
def test_patterns_match_leftmost_without_overlap(text):
    assert pii.base_spans(text) == plain(text)


def test_patterns_on_random_strings():
    r = np.random.default_rng(4)
    for _ in range(3000):
        x = "".join(r.choice(list("01245.@+- ()ab%"), int(r.integers(0, 40))))
        assert pii.base_spans(x) == plain(x), x


def test_long_runs_take_no_quadratic_time():
    for x in ("1" * 300_000, "1." * 100_000, "a" * 300_000, "@" * 200_000, "+1" * 100_000, "1 " * 150_000):
        pii.base_spans(x)


def test_gradients_are_those_of_the_likelihood():
    r = np.random.default_rng(0)
    net = pii.Tagger.fresh(hidden=4)
    ids, y = r.integers(0, pii.N_CHARS, (3, 7)), r.integers(0, pii.N_LABELS, (3, 7))
    _, g = net.gradients(ids, y)
    for k, w in net.w.items():
        for _ in range(6):
            at = tuple(int(r.integers(0, n)) for n in w.shape)
            old, eps = w[at], 1e-5
            w[at] = old + eps
            up = net.gradients(ids, y)[0]
            w[at] = old - eps
            down = net.gradients(ids, y)[0]
            w[at] = old
            assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-5, (k, at)


def test_viterbi_and_marginals_against_all_paths():
    import itertools
    r = np.random.default_rng(1)
    net = pii.Tagger.fresh(hidden=2)
    net.w["t"] = r.normal(0, 1, (pii.N_LABELS, pii.N_LABELS))
    e = r.normal(0, 1, (1, 4, pii.N_LABELS))
    paths = list(itertools.product(range(pii.N_LABELS), repeat=4))
    s = np.array([sum(e[0, i, p[i]] for i in range(4)) + sum(net.w["t"][p[i], p[i + 1]] for i in range(3)) for p in paths])
    assert tuple(net.viterbi(e)[0]) == paths[int(s.argmax())]
    w = np.exp(s - s.max())
    want = sum(x for x, p in zip(w, paths, strict=True) if p[1] == 3) / w.sum()
    assert abs(net.marginals(e)[0][0, 1, 3] - want) < 1e-9


def samples(r, n):
    words = ["alpha", "Beta,", "gamma", "3.", "delta", "2.0", "von", "x7"]
    out = []
    for _ in range(n):
        w = [str(x) for x in r.choice(words, 18)]
        d = lambda k: "".join(str(x) for x in r.integers(0, 10, k))
        w[5] = {0: f"{r.choice(words[:1])}.{d(2)}@mail{d(1)}.example.com", 1: ".".join(str(x) for x in r.integers(0, 256, 4)),
                2: f"+1 ({d(3)}) 555-{d(4)}", 3: "plain"}[int(r.integers(0, 4))]
        out.append(" ".join(w))
    return out


def test_trained_tagger_finds_held_out_spans():
    r = np.random.default_rng(5)
    net = pii.train_tagger(samples(r, 500))
    hit = found = wanted = 0
    for x in samples(r, 150):
        base = {(s, k, e) for s, k, e in pii.base_spans(x)}
        got = set(pii.model_spans(net, x))
        hit, found, wanted = hit + len(base & got), found + len(got), wanted + len(base)
    assert hit / wanted > 0.9 and hit / found > 0.9


def test_windows_cover_every_digit_and_spans_are_whole_across_them():
    x = "a" * 100 + " " + "7" * 150 + " " + "b" * 100 + "@" + "c" * 300
    covered = {s + i for s in pii.window_starts(x) for i in range(pii.WINDOW)}
    for m in re.finditer("[0-9@]", x):
        assert {*range(max(0, m.start() - pii.REACH), min(len(x), m.end() + pii.REACH))} <= covered


def test_query_keeps_the_patterns_spans(spark):
    docs = documents(spark, SF)
    rows = {r["doc_id"]: r for r in pii.op9_pii(spark, SF).collect()}
    assert rows.keys() == docs.keys()
    for k, text in docs.items():
        base, r = plain(text), rows[k]
        line = ",".join(f"{kind}:{s}:{e}" for s, kind, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{x}"] for x in pii.KINDS] == [sum(b[1] == x for b in base) for x in pii.KINDS]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
    assert sum(r["n_added"] for r in rows.values()) <= 0.05 * sum(sum(r[f"n_{x}"] for x in pii.KINDS) for r in rows.values()) + 5


def test_masking_and_odd_rows(spark):
    assert pii.mask_text("mail a@b.cd or 1.2.3.4!", pii.base_spans("mail a@b.cd or 1.2.3.4!")) == "mail <email> or <ip>!"
    assert pii.mask_text("1.2.3.4@h.com", pii.base_spans("1.2.3.4@h.com")) == "<email>"
    masked = pii.mask(odd_docs(spark))
    assert masked.columns == odd_docs(spark).columns
    got = [r["text"] for r in masked.collect()]
    assert len(got) == 11 and "mail me at <email> or call <phone> now" in got and None in got
    rows = pii.find(odd_docs(spark)).collect()
    assert len(rows) == 11 and [r["spans"] for r in rows if r["doc_id"] == 2] == [""]
    assert pii.find(no_docs(spark)).count() == 0 and pii.mask(no_docs(spark)).count() == 0
