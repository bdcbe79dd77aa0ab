from collections import Counter

import pytest

from starloom.llm.hostrules import beta_prior, features, host_quality, host_verdicts, op2_host_rules
from tests.llm.helpers import documents, no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def plain(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n, again = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            again.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def test_query_against_plain_counts(spark):
    docs = documents(spark, SF)
    rows = {r["doc_id"]: r for r in op2_host_rules(spark, SF).collect()}
    assert rows.keys() == docs.keys()
    for k, text in docs.items():
        r, want = rows[k], plain(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, k
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["host_kept"])


def test_prior_shrinks_small_hosts_more():
    a, b = beta_prior(50, 5000, 500, 500 * 0.1 + 30)
    assert 0.09 < a / (a + b) < 0.11
    small, large = (2 + a) / (2 + a + b), (200 + a) / (200 + a + b)
    assert 0.1 < small < large < 1
    assert beta_prior(0, 0, 0, 0) == (0.5, 0.5)
    assert beta_prior(3, 30, 0, 0)[0] > 0


def test_a_bad_host_goes_and_a_small_one_is_given_the_benefit_of_the_doubt(spark):
    good = "some plain words that make up one quite ordinary sentence number {} here".format
    bad = "buy now " * 30
    rows = [(i, good(i), "en", f"h{i % 20}", 0) for i in range(600)]
    rows += [(1000 + i, bad if i % 10 else good(i), "en", "spam", 0) for i in range(100)]
    rows += [(2000, bad, "en", "tiny", 0), (2001, good(1), "en", "tiny", 0)]
    out = {r["doc_id"]: r for r in host_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert all(out[i]["kept"] for i in range(600))
    assert not out[1000]["host_kept"] and not out[1010]["kept"] and not out[1010]["base_failed"]
    assert out[2001]["kept"] and out[2000]["base_failed"]


def test_odd_rows_and_empty_table(spark):
    rows = host_quality(odd_docs(spark)).collect()
    assert len(rows) == 11
    nulls = [r for r in rows if r["doc_id"] == 2]
    assert nulls[0]["n_words"] == 0 and nulls[0]["base_failed"] and not nulls[0]["kept"]
    assert host_quality(no_docs(spark)).count() == 0
    v = host_verdicts(features(odd_docs(spark)))
    assert v.where("host is null").count() == 1
    with pytest.raises(Exception):
        host_quality(no_docs(spark), "no_such_column").count()
