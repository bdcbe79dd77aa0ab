"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts become counts of hashed 1- to 3-grams over their letters. Document
frequencies come from every document the model may learn from; the weights are
learned with follow-the-regularised-leader (elastic net) from a bounded sample
of them, and the scores are calibrated by one temperature.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_map, no_null, ship, table

#: Buckets the n-grams are hashed to.
DIM = 1 << 15
NGRAMS = 3
#: The classifier is fitted on at most so many documents of each language, and learns at most so many languages.
SAMPLE_PER_LANG, MAX_LANGS = 400, 256
UNDETERMINED = "und"


@dataclass(frozen=True)
class Params:
    """FTRL's learning rate and its elastic-net penalties."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    epochs: int = 4
    calibration_share: float = 0.25


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point: 2 for a letter, 1 for a mark, which is part of a word but no letter, else 0."""
    global _letters
    if _letters is None:
        kinds = {"L": 2, "M": 1}
        _letters = np.frombuffer(bytes(kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)), np.uint8)
    return _letters


_A = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets that occur and how often; None for a text without a letter.

    Everything but letters counts as a space, so digits and signs say nothing.
    """
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kind = letters()[c]
    if not (kind == 2).any():
        return None
    c = np.where(kind > 0, c, np.uint32(32))
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]  # one space between words
    shift = np.uint32(32 - DIM.bit_length() + 1)
    total = np.zeros(DIM, np.int64)
    h = np.zeros(len(c), np.uint32)
    for n in range(min(NGRAMS, len(c))):
        h = (h[:len(c) - n] ^ c[n:]) * _A[n]
        h ^= h >> np.uint32(15)
        total += np.bincount((h * _A[0]) >> shift, minlength=DIM)
    at = np.flatnonzero(total)
    return at, total[at]


def vector(counts: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their TF-IDF (log-damped counts), of length one."""
    at, n = counts
    x = (1 + np.log(n)) * idf[at]
    return at, x / max(math.sqrt(float(x @ x)), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader, proximal, one coordinate at a time, for a softmax over k classes."""

    def __init__(self, k: int, dim: int, p: Params):
        self.p, self.z, self.n = p, np.zeros((k, dim)), np.zeros((k, dim))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, p = self.z[:, at], self.n[:, at], self.p
        return np.where(np.abs(z) <= p.l1, 0.0,
                        -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = softmax(w @ x)
        g[y] -= 1
        g = g[:, None] * x
        n = self.n[:, at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.p.alpha
        self.z[:, at] += g - sigma * w
        self.n[:, at] = n + g * g


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the lowest log loss on rows that the weights were not learned from.

    One wrong row among one more is allowed for, so a sample without errors does not claim certainty.
    """
    if not len(y) or logits.shape[1] < 2:
        return 1.0
    slack = 1 / (len(y) + 1)

    def loss(log_t: float) -> float:
        p = np.log(np.maximum(softmax(logits / math.exp(log_t)), 1e-12))
        return float(-((1 - slack) * p[np.arange(len(y)), y] + slack * p.mean(axis=1)).mean())
    lo, hi, r = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


@dataclass
class Model:
    """``weights`` hold the IDF already; ``idf`` is kept for the vectors' length."""

    langs: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text)
        if counts is None or not self.langs:
            return UNDETERMINED, 0.0
        at, x = vector(counts, self.idf)
        p = softmax((self.weights[:, at] @ x) / self.temperature)
        i = int(p.argmax())
        return self.langs[i], float(p[i])


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, p: Params = Params()) -> Model:
    """A model from (lang, buckets, counts); every fourth row or so only calibrates."""
    langs = sorted({s[0] for s in samples})
    if not langs:
        return Model([], np.zeros((0, DIM)), idf, 1.0)
    rng = np.random.default_rng(11)
    order = rng.permutation(len(samples))
    rows = [(langs.index(samples[i][0]), *vector(samples[i][1:], idf)) for i in order]
    n_cal = int(len(rows) * p.calibration_share) if len(rows) >= 8 else 0
    cal, train = rows[:n_cal], rows[n_cal:]
    model = Ftrl(len(langs), DIM, p)
    for _ in range(p.epochs):
        for i in rng.permutation(len(train)):
            y, at, x = train[i]
            model.learn(at, x, y)
    w = model.weights()
    logits = np.array([w[:, at] @ x for _, at, x in cal]).reshape(len(cal), len(langs))
    return Model(langs, w, idf, temperature(logits, np.array([r[0] for r in cal], int)))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents that are never learned from (a null doc_id counts as one)."""
    return (F.crc32(no_null(F.col(doc_id).cast("string")).cast("binary")) % 5) == 0


def learnable(docs: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
            .where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out()))


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, and how many there are: each task sums its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIM, np.int64), 0
        for b in batches:
            for x in b.column(0).to_pylist():
                c = ngram_counts(x)
                if c is not None:
                    df[c[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["bucket", "n"])
    ship(train.sparkSession)
    rows = (train.select("text").mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # DIM + 1 rows at most
    df = np.zeros(DIM, np.int64)
    for r in rows:
        if r["bucket"] >= 0:
            df[r["bucket"]] = r["n"]
    return df, sum(r["n"] for r in rows if r["bucket"] < 0)


def sample(train: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """N-gram counts of about ``per_lang`` documents of each language, at most.

    A language's documents are taken where their key's hash is low, at a rate
    that its number of documents gives; counting happens in the tasks, so the
    driver gets no texts and at most DIM numbers for each document.
    """
    langs = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    if not langs:
        return []
    rate = F.element_at(F.create_map(*[F.lit(v) for r in langs for v in (r["lang"], min(1.0, per_lang / r["count"]))]), F.col("lang"))
    u = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    known = train.where(F.col("lang").isin([r["lang"] for r in langs]))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [(lang, c) for lang, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                 if (c := ngram_counts(x)) is not None]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, _ in found], pa.string()),
             pa.array([c[0].astype("<i4").tobytes() for _, c in found], pa.binary()),
             pa.array([c[1].astype("<i4").tobytes() for _, c in found], pa.binary())], ["lang", "at", "n"])
    rows = arrow_map(known.where(u < rate).select("lang", "text"), run, "lang string, at binary, n binary").collect()
    got: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"]))):
        got.setdefault(r["lang"], []).append((r["lang"], np.frombuffer(r["at"], "<i4").astype(np.int64), np.frombuffer(r["n"], "<i4")))
    rng = np.random.default_rng(5)
    return [x[i] for x in got.values() for i in sorted(rng.permutation(len(x))[:per_lang])]


def train_model(docs: DataFrame, p: Params = Params()) -> Model:
    train = learnable(docs)
    df, n = document_frequencies(train)
    idf = np.log((1 + n) / (1 + df)) + 1
    return fit(sample(train), idf, p)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    ``und`` with score 0 for a text that is null or has no letter, and for all
    rows if there is nothing to learn from. lang, source and doc_id are no
    inputs of a prediction; a null doc_id is held out.
    Repeated rows are answered each, texts of any length are read whole, an
    empty table gives an empty result; extra columns are not read.
    """
    spark = docs.sparkSession
    model = model or train_model(docs)
    shared = spark.sparkContext.broadcast(model)  # MAX_LANGS x DIM numbers at most

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        got = [m.predict(x) for x in b.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()),
             pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                      F.col("text").cast("string").alias("text"))
    return arrow_map(src, run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, min_score: float = 0.3, model: Model | None = None) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or scored under ``min_score``; every column stays."""
    model = model or train_model(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = [shared.value.predict(x) for x in b.column(b.schema.get_field_index("text")).to_pylist()]
        return b.filter(pa.array([lang != UNDETERMINED and score >= min_score for lang, score in got], pa.bool_()))
    return arrow_map(docs, run, docs.schema)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
