"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a short window of words: the words at its ones are
hashed, those at its zeros are ignored, so a substituted word spoils a window
only where a mask looks. Hashes of benchmark items and of documents are joined;
around every hit the document is laid against the item at the hit's shift and
the overlap is verified word by word, substitutions allowed.

The benchmark's hashes also fill a Bloom filter of fixed size, which the tasks
use to keep nearly all of a document's hashes out of the join's shuffle. Its
size does not depend on the data; a larger benchmark only lets more through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, arrow_map, bloom_filter, cut, in_filter, mix64, open_filter, ship, stored, table, utf8

#: Fixed masks. Together they hit every overlap of 13 words or more with four fifths of its words equal.
MASKS = ("1110111", "100011111", "111010001001", "110000110011", "111100101001")
#: Fixed masks by the length of a shorter item. They hit every copy of the whole item with four fifths of its words equal.
SHORT = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("111011", "11111"),
    9: ("1111011", "1101111"),
    10: ("111011", "11010011", "11111"),
    11: ("1110111", "111001011", "1011111", "111111"),
    12: ("11101011", "101100111", "111111"),
}
#: Every mask once; its place is part of its hashes.
_PLACE = {m: i for i, m in enumerate(dict.fromkeys((*MASKS, *(m for ms in SHORT.values() for m in ms))), 1)}
#: An overlap counts from this many words on (or the whole item, if shorter), of which this share must be equal.
MIN_WORDS, MIN_EQUAL = 13, 0.8
#: Items of fewer words count only as a document's whole text: one or two words inside a text are no evidence.
MIN_ITEM = 3


@dataclass(frozen=True)
class Rule:
    min_words: int = MIN_WORDS
    min_equal: float = MIN_EQUAL


def words_of(text: bytes | None) -> np.ndarray:
    """A 64-bit hash of each lower-cased word."""
    w = (text or b"").translate(LOWER).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))


def masks_of(n_words: int) -> tuple[str, ...]:
    """The masks an item of so many words is looked for with."""
    return SHORT.get(n_words, MASKS)


def seed_hashes(w: np.ndarray, masks: Sequence[str] = MASKS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every mask laid at every place it fits; one of under MIN_ITEM words fits a whole text only."""
    hs, ps = [], []
    for mask in masks:
        k = len(w) - len(mask) + 1
        if k <= 0 or len(mask) < MIN_ITEM and k > 1:
            continue
        h = np.full(k, _PLACE[mask], np.uint64)
        for j, bit in enumerate(mask):
            if bit == "1":
                h = mix64(h ^ w[j:j + k]) + np.uint64(j)
        hs.append(h)
        ps.append(np.arange(k))
    if not hs:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hs), np.concatenate(ps)


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, rule: Rule = Rule()) -> tuple[int, int, int] | None:
    """The best run of the alignment doc[shift + j] ~ item[j]: (first word of the document, words, equal words).

    Of all runs as long as asked for, the one whose equal words most outweigh
    the others at ``min_equal`` (a maximal-scoring segment of a least length).
    A run with that share of equal words scores 0 or more, so None means that
    there is none.
    """
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    need = max(1, min(rule.min_words, len(item)))
    if b - a < need:
        return None
    same = np.concatenate(([0], np.cumsum(doc[shift + a:shift + b] == item[a:b])))
    s = np.round(same - rule.min_equal * np.arange(len(same)), 9)
    gain = s[need:] - np.minimum.accumulate(s)[:len(s) - need]  # of the best run that ends there
    end = int(gain.argmax()) + need
    begin = int(s[:end - need + 1].argmin())
    return (shift + a + begin, end - begin, int(same[end] - same[begin])) if gain[end - need] >= -1e-6 else None


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """item_id and the words' hashes, for the items that have words; equal texts keep an item each, null ids stay."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = [(k, w) for k, x in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True) if len(w := words_of(x))]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.int64()), pa.array([w.tobytes() for _, w in got], pa.binary())],
                                          ["item_id", "item"])
    src = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(src, run, "item_id long, item binary")


def item_seeds(items: DataFrame) -> DataFrame:
    """hash, item_id, item_at: one row for each seed of each item."""
    def run(b: pa.RecordBatch):
        for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            w = np.frombuffer(x, np.uint64)
            h, p = seed_hashes(w, masks_of(len(w)))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([k] * len(h), pa.int64()), pa.array(p)], ["hash", "item_id", "item_at"])
    return arrow_map(items, run, "hash long, item_id long, item_at long")


def contaminated(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, n_equal, row_hash) of each document's best overlap with each item it leaks.

    first_word counts the document's words from 0. Null and empty texts leak
    nothing; a null doc_id or item_id stays null; items under MIN_ITEM words
    are found where they are the whole text; rows repeated with the same doc_id and
    text are found once; an empty table on either side gives an empty result.
    Extra columns are not read. ``row_hash`` joins back to the text with
    ``text_key``.
    """
    spark = docs.sparkSession
    items = cut(benchmark_words(benchmark))
    seeds = cut(item_seeds(items))
    lengths = items.select(F.least(F.expr("length(item) div 8"), F.lit(MIN_WORDS)).alias("n")).distinct().collect()
    masks = tuple(dict.fromkeys(m for r in lengths for m in masks_of(r["n"])))  # those that the benchmark's items ask for
    shared = spark.sparkContext.broadcast(bloom_filter(seeds.select("hash")))  # of fixed size, whatever the benchmark's

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = open_filter(shared.value)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for k, key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)), strict=True):
                w = words_of(x)
                h, p = seed_hashes(w, masks)
                at = np.flatnonzero(in_filter(bits, h))
                if len(at):
                    for c, v in zip(out, (k, key, w.tobytes(), [{"h": a, "p": q} for a, q in
                                                                zip(h[at].view(np.int64).tolist(), p[at].tolist(), strict=True)]), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["doc_id", "row_hash", "words", "hits"])
    ship(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("row_hash"), F.col("text").cast("string").alias("text"))
    hit = cut(src.mapInArrow(probe, "doc_id long, row_hash long, words binary, hits array<struct<h: bigint, p: bigint>>"))

    pairs = (hit.select("row_hash", F.explode("hits").alias("x")).select("row_hash", F.col("x.h").alias("hash"), F.col("x.p").alias("p"))
             .join(seeds, "hash").select("row_hash", "item_id", (F.col("p") - F.col("item_at")).alias("shift")).distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for key, k, item, shift, words, item_words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                o = overlap(np.frombuffer(words, np.uint64), np.frombuffer(item_words, np.uint64), shift, rule)
                if o:
                    got.append((key, k, item, *o))
            cols = list(zip(*got, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["row_hash", "doc_id", "item_id", "first_word", "n_words", "n_equal"])
    rows = hit.select("row_hash", "doc_id", "words").dropDuplicates(["row_hash"])
    texts = items.withColumnRenamed("item_id", "id")
    laid = (pairs.join(texts, F.col("item_id").eqNullSafe(F.col("id"))).join(rows, "row_hash")
            .select("row_hash", "doc_id", "item_id", "shift", "words", "item"))
    found = laid.mapInArrow(verify, "row_hash long, doc_id long, item_id long, first_word long, n_words long, n_equal long")
    best = F.max(F.struct("n_equal", (-F.col("n_words")).alias("m"), (-F.col("first_word")).alias("f"))).alias("b")
    return (found.groupBy("row_hash", "doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", (-F.col("b.f")).alias("first_word"), (-F.col("b.m")).alias("n_words"),
                    F.col("b.n_equal").alias("n_equal"), "row_hash"))


def text_key():
    """A 64-bit key of a row's doc_id and text, the same wherever it is worked out."""
    return F.xxhash64("doc_id", "text")


def clean(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` without the rows that leak an item; every column stays."""
    bad = stored(contaminated(docs, benchmark, rule).select(F.col("row_hash").alias("_leaks")).distinct())
    return docs.join(bad, text_key() == F.col("_leaks"), "left_anti")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the overlap."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_hash")
