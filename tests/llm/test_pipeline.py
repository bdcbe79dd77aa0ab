import corpus_pipeline as C
from starloom.llm import decontam, jaccard, langid, packing, pii
from tests.llm.helpers import no_docs, odd_docs
from tests.llm.test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_every_stage_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in C.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = seen[name][1]
    for name in list(seen)[:-1]:
        assert seen[name][1].columns == columns
    by = lambda df: {r["doc_id"]: r for r in df.collect()}

    before, after = map(by, seen["language"])
    model = langid.train_model(seen["language"][0])
    want = {k for k, r in before.items() if (p := model.predict(r["text"]))[0] != "und" and p[1] >= 0.3}
    assert after.keys() == want and len(want) > 0.9 * len(before)

    before, after = map(by, seen["near_duplicates"])
    ids = sorted(before)
    roots, _ = brute([before[k]["text"] for k in ids], C.NEAR)
    assert after.keys() == {k for k, r, i in zip(ids, roots, range(len(ids)), strict=True) if r == i}
    assert all(after[k] == before[k] for k in after)

    before, after = map(by, seen["decontaminate"])
    found = decontam.contaminated(seen["decontaminate"][0], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert before.keys() - after.keys() == {r["doc_id"] for r in found.collect()}

    before, after = map(by, seen["personal_data"])
    assert before.keys() == after.keys()
    for k, r in after.items():
        assert not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not pii.base_spans(before[k]["text"]) and not any(c in before[k]["text"] for c in "0123456789@"):
            assert r == before[k]

    pieces = seen["pack"][1].collect()
    assert sum(p["n_tokens"] for p in pieces) == sum(len(r["text"].encode()) + 1 for r in after.values())
    assert {p["bin_size"] for p in pieces} <= set(packing.CAPACITIES)


def test_run_gives_the_last_stage(spark):
    rows = C.run(spark, SF)
    assert rows.columns[0] == "doc_id" and rows.count() > 150


def test_stages_take_odd_rows_and_empty_tables(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            assert name == "pack" or out.columns == docs.columns
            out.count()
    assert C.near_duplicates(spark, odd_docs(spark), SF).count() == 10
    assert jaccard.Similarity(5, 80, 100) == C.NEAR
