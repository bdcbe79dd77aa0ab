"""Host-level quality rules.

Every document is measured in one pass. Rule failures are counted by host, the
counts' rates are shrunk towards a beta prior that is fitted to all hosts by
moments, and each host's verdict is joined back to its documents.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_map, cut, mix64, table, utf8

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
NGRAM = 5
SCHEMA = ("doc_id long, host string, n_words long, word_chars long, n_symbols long, "
          "n_dup_lines long, n_repeat_words long, n_lines long")



def rules() -> dict[str, Column]:
    c = F.col
    return {
        "few_words": c("n_words") < 10,
        "repeats": 100 * c("n_repeat_words") > 20 * c("n_words"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "dup_lines": 100 * c("n_dup_lines") > 30 * c("n_lines"),
        "word_length": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 20 * c("n_words")),
    }


def repeat_words(words: list[bytes], n: int = NGRAM) -> int:
    """Words inside n-word windows that occur twice or more, first ones included."""
    if len(words) <= n:
        return 0
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = len(words) - n + 1
    g = np.zeros(k, np.uint64)
    for i in range(n):
        g = mix64(g + h[i:i + k])
    _, back, count = np.unique(g, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[back] > 1)
    if not len(again):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + n, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word)."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.split()
    solid = text.translate(None, SPACE)
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))
    lines = Counter(x for x in text.split(b"\n") if x.strip(SPACE))
    n_lines = lines.total()
    return (len(words), chars, len(text) - len(text.translate(None, SYMBOLS)),
            n_lines - len(lines), repeat_words(words), n_lines)


def features(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row of counts for each document (SCHEMA)."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(x) for x in utf8(b.column(2))]
        cols = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols],
                                          ["doc_id", "host", *SCHEMA.replace(" long", "").split(", ")[2:]])
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                      F.col("text").cast("string").alias("text"))
    return arrow_map(src, run, SCHEMA)


def beta_prior(n_hosts: float, n: float, k: float, nsq: float) -> tuple[float, float]:
    """Alpha and beta from the hosts' sums, by moments.

    n, k: all documents, all failures; nsq: the sum over hosts of k*k/n. The
    spread between hosts beyond what chance gives sets the prior's strength,
    held between 1 and 1e6 documents.
    """
    if not n or not n_hosts:
        return 0.5, 0.5
    m = k / n
    if m <= 0 or m >= 1:
        return max(m, 1e-6) * 1.0, max(1 - m, 1e-6) * 1.0
    spread = nsq / n - m * m
    chance = m * (1 - m) * n_hosts / n
    tau = max(spread - chance, 1e-12)
    strength = min(max(m * (1 - m) / tau - 1, 1.0), 1e6)
    return m * strength, (1 - m) * strength


def host_verdicts(feats: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """host, n_docs, rate_<rule> (shrunk), host_kept; hosts of null are one host.

    Counts are summed inside every task before the shuffle, so a host that
    holds most rows costs no more than another. A host is kept when none of
    its shrunk failure rates exceeds ``max_rate``.
    """
    rs = rules()
    by = feats.groupBy("host").agg(F.count("*").alias("n_docs"),
                                   *[F.sum(c.cast("long")).alias(f"k_{r}") for r, c in rs.items()])
    by = cut(by)
    sums = by.agg(F.count("*").alias("h"), F.sum("n_docs").alias("n"),
                  *[F.sum(f"k_{r}").alias(f"k_{r}") for r in rs],
                  *[F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / F.col("n_docs")).alias(f"q_{r}") for r in rs]).first()
    out, kept = by, F.lit(True)
    for r in rs:
        a, b = beta_prior(sums["h"], sums["n"] or 0, sums[f"k_{r}"] or 0, sums[f"q_{r}"] or 0.0)
        rate = (F.col(f"k_{r}") + a) / (F.col("n_docs") + a + b)
        out = out.withColumn(f"rate_{r}", rate)
        kept = kept & (rate <= max_rate)
    return out.withColumn("host_kept", kept).drop(*[f"k_{r}" for r in rs])


def host_quality(docs: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host, host_kept.

    A null or empty text has no words and fails; documents of a null host
    share one host; repeated rows are judged each; an empty table gives an
    empty result. Extra columns of ``docs`` are not read.
    """
    feats = cut(features(docs, host))
    hosts = host_verdicts(feats, max_rate).select(F.col("host").alias("_host"), "host_kept")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (feats.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
            .withColumn("base_failed", failed)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))).alias("kept"),
                    "host", "host_kept"))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and verdict; the host is the document's source."""
    return host_quality(table(spark, sf_dir, "documents"))
