import zlib
from collections import Counter, defaultdict

from starloom.llm.hashtree import assign, grown, layout, op5_hash_tree, with_shard
from tests.llm.helpers import documents, no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def shards(spark, root, n=4000):
    return {r[0]: r[1] for r in with_shard(spark.range(n).withColumnRenamed("id", "doc_id"), root, "doc_id", "s").collect()}


def test_query_digests_slots_and_growth(spark):
    docs = documents(spark, SF)
    rows = op5_hash_tree(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r["grown_shard"] == 24 for r in rows)


def test_one_more_shard_only_takes_rows_into_itself_again_and_again(spark):
    root = layout(5, 1, 2)
    before = shards(spark, root)
    for new in (5, 6, 7):
        root = grown(root)
        after = shards(spark, root)
        moved = [k for k in before if before[k] != after[k]]
        assert moved and all(after[k] == new for k in moved)
        assert len(moved) < 2 * len(before) / (new + 1)
        before = after


def test_weights_set_the_shares_and_confine_movement(spark):
    light, heavy = layout(8, 2, 2), layout(8, 2, 2, {7: 3.0})
    a, b = shards(spark, light, 8000), shards(spark, heavy, 8000)
    count = Counter(b.values())
    assert 0.24 < count[7] / 8000 < 0.36  # 3 of 10
    # shards 0-3 are another region: nothing moves between them, and nothing moves into them
    assert all(a[k] == b[k] or (a[k] < 4 <= b[k]) or (a[k] >= 4 and b[k] >= 4) for k in a)
    assert set(shards(spark, layout(3, 1, 3, {1: 0.0})).values()) == {0, 2}


def test_odd_rows_and_empty_table(spark):
    rows = assign(odd_docs(spark), layout(3)).collect()
    assert len(rows) == 11
    assert [r["size"] for r in rows if r["doc_id"] == 2] == [8]
    for s in {r["shard"] for r in rows}:
        got = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert got == list(range(len(got)))
    assert assign(no_docs(spark), layout(24)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op5_hash_tree(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
