import hashlib
import random
import zlib

import pytest

from starloom.llm import merkle
from starloom.llm.merkle import H
from tests.llm.helpers import no_docs, odd_docs

SF = "/root/testdata/sf0.001"


def levels(nodes):
    """All levels of a tree, plainly."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(lv, i):
    out = []
    for row in lv[:-1]:
        run = range(i // 3 * 3, min(i // 3 * 3 + 3, len(row)))
        out.append(("".join(row[k] for k in run if k < i), "".join(row[k] for k in run if k > i)))
        i //= 3
    return out


def plain_leaf(row, text):
    enc = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)]
    return H(*enc)


def plain(rows):
    """Every row's result by the contract, in order of source and doc_id."""
    low = lambda x: (x is not None, (x or "").encode())
    leaves = sorted(((low(r["source"]), r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r) for r in rows), key=lambda x: x[:4])
    sources = {}
    for key, *_, leaf, r in leaves:
        sources.setdefault(key, []).append((leaf, r))
    trees = {k: levels([leaf for leaf, _ in v]) for k, v in sources.items()}
    top = levels([t[-1][0] for t in trees.values()])
    out = []
    for n, (key, members) in enumerate(sources.items()):
        for i, (leaf, r) in enumerate(members):
            way = siblings(trees[key], i) + siblings(top, n)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            digest = plain_leaf(r, text)
            for a, b in way:
                digest = H(a, digest, b)
            out.append((r["doc_id"], leaf, trees[key][-1][0], top[-1][0], H(*(x for p in way for x in p)), digest, digest == top[-1][0]))
    return out


def found(spark, docs):
    leaves = docs.select("source", "doc_id", merkle.leaf().alias("leaf"), merkle.leaf({"text": merkle.tampered()}).alias("changed"))
    rows = merkle.prove(leaves).selectExpr("*", "folded_root = root verified").collect()
    return [tuple(r) for r in rows]


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 40])
def test_parts_of_every_range(n):
    leaves = [H(str(i)) for i in range(n)]
    lv = levels(leaves)
    assert merkle.sizes(n) == [len(x) for x in lv]
    for a in range(n):
        for b in range(a + 1, n + 1):
            below = [{i for i in range(len(row)) if any(a <= leaf < b for leaf in range(i * 3**k, min(n, (i + 1) * 3**k)))} for k, row in enumerate(lv)]
            need = {(k, s) for k, row in enumerate(lv[:-1]) for i in below[k] for s in range(i // 3 * 3, min(i // 3 * 3 + 3, len(row))) if s not in below[k]}
            lacks = list(merkle.missing(a, b, n))
            assert set(lacks) == need and len(lacks) == len(need)
            paths = merkle.Paths(leaves[a:b], a, n, {(k, i): lv[k][i] for k, i in lacks})
            assert paths.root == lv[-1][0] and all(list(paths.siblings(i)) == siblings(lv, i) for i in range(a, b))


@pytest.mark.parametrize("n", [1, 2, 5, 9, 27, 31, 80, 100])
def test_nodes_that_parts_hand_out_give_the_tree(n):
    leaves = [H(str(i)) for i in range(n)]
    lv, rng = levels(leaves), random.Random(n)
    for _ in range(20):
        cuts = sorted({0, n, *(rng.randrange(n + 1) for _ in range(rng.randrange(5)))})
        given = [x for a, b in zip(cuts, cuts[1:], strict=False) for x in merkle.largest(leaves[a:b], a, n)]
        assert len(given) <= 4 * len(lv) * len(cuts) and all(lv[k][i] == d for k, i, d in given)
        derived = list(merkle.derive({(k, i): d for k, i, d in given}, n))
        assert all(lv[k][i] == d for k, i, d in derived)
        assert (len(lv) - 1, 0) in {(k, i) for k, i, _ in [*given, *derived]}


def test_every_document(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = merkle.op13_merkle_manifest(spark, SF).collect()
    same([tuple(r) for r in got], plain([r.asDict() for r in rows]))
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("part", [7, 40])
def test_sources_over_many_partitions(spark, monkeypatch, part):
    monkeypatch.setattr(merkle, "PART_LEAVES", part)
    rng = random.Random(part)
    rows = [(i, f"text\n{i % 17}", rng.choice(["en", None]), rng.choice(["hot", "hot", "é", "z", None, f"own{i}"]), i % 5) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    same(found(spark, docs), plain([r.asDict() for r in docs.collect()]))


def test_one_doc_id_for_all_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PART_LEAVES", 10)
    docs = spark.createDataFrame([(1, "same", "en", "a", 4)] * 100, "doc_id long, text string, lang string, source string, n_chars long")
    same(found(spark, docs), plain([r.asDict() for r in docs.collect()]))


def test_odd_rows_one_row_and_none(spark):
    docs = odd_docs(spark)
    same(found(spark, docs), plain([r.asDict() for r in docs.collect()]))
    one = docs.where("doc_id = 8")
    (row,) = found(spark, one)
    assert row[1] == row[2] == row[3] and row[4] == hashlib.sha256(b"").hexdigest()
    assert found(spark, no_docs(spark)) == []
