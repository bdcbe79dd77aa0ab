import zlib

import numpy as np

from starloom.llm import langid as L
from tests.llm.helpers import DOCS, no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in L.op10_langid(spark, SF).collect()}
    assert rows.keys() == docs.keys()
    right = total = 0
    for k, d in docs.items():
        r = rows[k]
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        if r["held_out"] and d["lang"] and r["lang_pred"] != "und":
            total, right = total + 1, right + (r["lang_pred"] == d["lang"])
    assert total > 100 and right / total > 0.97


def test_nothing_but_the_text_of_learnable_rows_counts(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    from pyspark.sql import functions as F
    other = df.withColumn("lang", F.when(L.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(df).collect()}
    b = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(other).collect()}
    assert a == b


def test_ngram_counts():
    at, n = L.ngram_counts("ab ab")
    assert n.sum() == 5 + 4 + 3
    assert L.ngram_counts("12 .. 3") is None and L.ngram_counts("") is None and L.ngram_counts(None) is None
    assert (L.ngram_counts("a1b")[0] == L.ngram_counts("A, B")[0]).all()
    at, x = L.vector(L.ngram_counts("hello world"), np.ones(L.DIM))
    assert abs(float(x @ x) - 1) < 1e-9


def test_document_frequencies_over_all_rows(spark):
    texts = ["abc", "abd", "xyz", "123"]
    df, n = L.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros(L.DIM, np.int64)
    for t in texts[:3]:
        want[L.ngram_counts(t)[0]] += 1
    assert n == 3 and (df == want).all()


def test_elastic_net_leaves_weights_at_zero_and_temperature_softens():
    rng = np.random.default_rng(0)
    words = {"a": ["foo", "bar", "baz"], "b": ["qux", "quux", "zip"]}
    rows = [(k, *L.ngram_counts(" ".join(rng.choice(words[k], 12)))) for k in "ab" for _ in range(60)]
    m = L.fit(rows, np.ones(L.DIM))
    assert 0 < np.count_nonzero(m.weights) < 0.01 * m.weights.size
    assert m.predict("foo baz bar") == ("a", m.predict("foo baz bar")[1]) and m.predict("zip qux")[0] == "b"
    logits = rng.normal(0, 8, (400, 2))
    y = (rng.random(400) < 0.5).astype(int)
    assert L.temperature(logits, y) > 5 and L.temperature(np.empty((0, 2)), np.empty(0, int)) == 1.0
    assert m.predict("foo")[1] < 1


def test_odd_rows_empty_table_and_nothing_to_learn(spark):
    rows = L.identify(odd_docs(spark)).collect()
    assert len(rows) == 11
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    assert L.identify(no_docs(spark)).count() == 0 and L.keep_known(no_docs(spark)).count() == 0
    kept = L.keep_known(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.where("doc_id in (2, 3, 4)").count() == 0
    none = spark.createDataFrame([(1, "words", None, "s", 5)], DOCS)
    assert [r["lang_pred"] for r in L.identify(none).collect()] == ["und"]
