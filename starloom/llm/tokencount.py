"""Token counts by the whole-token shortcut.

Offline, every string of the vocabulary is encoded alone; those that come back
as one token form the shortcut set. A text's pre-tokens that are in the set
count one each, and only the rest goes through the merges.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import pretoken
from starloom.llm.common import arrow_map, no_null, table

#: Documents of more tokens are marked.
TOKEN_LIMIT = 512


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings (as the byte-level alphabet writes them) proved to encode alone as one token."""
    model = pretoken.load(path).model
    return frozenset(v for v in pretoken.load(path).get_vocab(with_added_tokens=False) if len(model.tokenize(v)) == 1)


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> pretoken.PartMemo:
    """One memo for each worker process; it outlives the tasks."""
    tok = pretoken.load(path)
    single, model, pre = whole_tokens(path), tok.model, tok.pre_tokenizer
    special = pretoken.added(tok)

    def count(part: str) -> int:
        if any(s in part for s in special):
            return len(tok.encode(part, add_special_tokens=False).ids)
        pieces = [p for p, _ in pre.pre_tokenize_str(part)]
        return sum(1 if p in single else len(model.tokenize(p)) for p in pieces)

    return pretoken.PartMemo(lambda parts: [count(p) for p in parts], special)


def token_counts(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    Null and empty texts have no token; repeated rows are counted each; an
    empty table gives an empty result; extra columns are not read.
    """
    def run(b: pa.RecordBatch):
        memo = _counter(path)
        for s in pretoken.in_groups(b.column(2).to_pylist()):
            part = b.slice(s.start, s.stop - s.start)
            counts = [sum(x) for x in memo.batch(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    body = no_null(F.col("text").cast("string"))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"),
                      F.octet_length(body).cast("long").alias("n_bytes"))
    return arrow_map(src, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary())
