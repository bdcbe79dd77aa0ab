import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import pretoken, tokencount, tokenstore
from tests.llm.helpers import documents, no_docs, odd_docs

SF = "/root/testdata/sf0.01"
PATH = tokencount.vocabulary()


def ids(text):
    return pretoken.load(PATH).encode(text or "", add_special_tokens=False).ids


AWKWARD = st.lists(st.sampled_from([*" \n\t\r\x0b\x1c\x85\xa0\u2003\u3000\u200babcXYZ019.,'!éß日ش́²Ⅷ\u180e", "  ", "'s", "<|endoftext|>", " the", "\n\n", "&&&", "###'", "a*", "()\"", "Ⅷ%"]),
                   max_size=40).map("".join)


@given(st.lists(st.one_of(AWKWARD, st.text(max_size=30)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_parts_give_what_the_library_gives(texts):
    want = [ids(x) for x in texts]
    assert [sum(x) for x in tokencount._counter(PATH).batch(texts)] == [len(x) for x in want]
    got = tokenstore.encode(texts, PATH, 2, 2)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [[*x, 2] for x in want]


def test_shortcut_strings_are_one_token():
    whole = tokencount.whole_tokens(PATH)
    assert "Ġthe" in whole and len(whole) > 40_000
    model = pretoken.load(PATH).model
    assert all(len(model.tokenize(x)) == 1 for x in sorted(whole)[::997])


def test_memo_starts_afresh_when_full():
    memo = pretoken.PartMemo(lambda parts: [len(p) for p in parts], [], most=3)
    for _ in range(3):
        assert [sum(x) for x in memo.batch(["a bb ccc", "", "dd  e"])] == [8, 0, 5]


def test_joined_results_are_those_of_the_batch_and_each_part_is_worked_once():
    asked = []
    memo = pretoken.PartMemo(lambda parts: [asked.append(p) or f"<{p}>".encode() for p in parts], [])
    texts = ["a bb a\nbb ccc.", "", "dd  e", " f", "one", "a\tb \tc", "é\u2003 x", "a bb a ccc", "\n\n", "x\n y"]
    got = memo.joined(texts)
    assert len(asked) == len(set(asked))
    assert got == [b"".join(x) for x in pretoken.PartMemo(memo.work, []).batch(texts)]
    assert memo.joined(["", ""]) == [b"", b""] and memo.joined([]) == []


def test_words_of_ascii_letters_get_the_ids_of_the_library():
    encoder = tokenstore._encoder(PATH, 2)
    words = [" qwordly", "Zzyqx", " a", "x", " don't", "\nWord", " é", " 12"]
    assert encoder.work(words) == [np.array(ids(w), "<u2").tobytes() for w in words] and encoder.work([]) == []


def test_counts_of_every_document(spark):
    docs = documents(spark, SF)
    rows = {r["doc_id"]: r for r in tokencount.op7_token_counts(spark, SF).collect()}
    assert rows.keys() == docs.keys()
    for k, text in docs.items():
        n = len(ids(text))
        assert (rows[k]["n_bytes"], rows[k]["n_tokens"], rows[k]["over_limit"]) == (len((text or "").encode()), n, n > 512)


def test_counts_of_odd_rows(spark):
    rows = tokencount.token_counts(odd_docs(spark), PATH).collect()
    assert len(rows) == 11 and [r["n_tokens"] for r in rows if r["doc_id"] == 2] == [0]
    assert tokencount.token_counts(no_docs(spark), PATH).count() == 0


def test_store_round_trip(spark):
    docs = documents(spark, SF)
    start = 0
    rows = sorted(tokenstore.op4_token_store(spark, SF).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == sorted(docs)
    for r in rows:
        want = np.array([*ids(docs[r["doc_id"]]), 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_store_of_odd_rows_and_of_none(spark, tmp_path):
    folder = f"file://{tmp_path}/odd"
    tokenstore.write_store(odd_docs(spark), folder, PATH)
    rows = sorted(tokenstore.with_starts(tokenstore.read_store(spark, folder)).collect(), key=lambda r: r["start"])
    assert len(rows) == 11 and rows[0]["doc_id"] is None
    assert [r["doc_id"] for r in rows[1:]] == [1, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert rows[-1]["start"] == sum(r["n_tokens"] for r in rows[:-1])
    folder = f"file://{tmp_path}/none"
    tokenstore.write_store(no_docs(spark), folder, PATH)
    assert tokenstore.with_starts(tokenstore.read_store(spark, folder)).count() == 0


def test_a_document_is_read_alone_and_the_dictionary_is_checked():
    raw = b"0123456789" * 50
    import hashlib
    zc = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    frames = [zc.compress(np.array(x, "<u2").tobytes()) for x in ([1, 2, 3], [], [7])]
    data = tokenstore.pack_segment([5, 6, 9], [3, 0, 1], frames, 2, hashlib.sha256(raw).hexdigest())
    seg = tokenstore.Segment(data, raw)
    assert [seg.ids(i).tolist() for i in range(3)] == [[1, 2, 3], [], [7]] and seg.doc_ids.tolist() == [5, 6, 9]
    with pytest.raises(ValueError):
        tokenstore.Segment(data, raw + b"x")
    with pytest.raises(ValueError):
        tokenstore.Segment(b"something else", raw)
