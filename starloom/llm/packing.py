"""Variable-capacity best-fit packing.

Documents go into sequences of several permitted lengths. Best-fit decreasing
runs on the histogram of piece lengths, which has at most as many entries as
the largest capacity has tokens, whatever the corpus holds: runs of equal
pieces are placed at once, a new bin gets the capacity that costs least per
token for such pieces, and at the end every bin shrinks to the smallest
capacity its contents fit. The plan names, for each length, ranges of ranks and
the bins they go to; Spark ranks the pieces and looks their bins up.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import arrow_map, cut, no_null, table

#: Permitted sequence lengths, in tokens.
CAPACITIES = (2048, 4096, 8192, 16384)
#: A sequence of c tokens costs c + c * c / ATTENTION: attention's part grows with the square.
ATTENTION = 65536
#: Sub-buckets that the pieces of one length are cut into while they are ranked.
RANK_BUCKETS = 64


def cost(capacity: int) -> float:
    return capacity + capacity * capacity / ATTENTION


@dataclass
class Plan:
    """Row i: pieces of ``length`` with ranks from ``first`` on go to bins from ``bin`` on, ``per`` to a bin."""

    length: np.ndarray
    first: np.ndarray
    bin: np.ndarray
    per: np.ndarray
    n_bins: int

    def bins(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        key = self.length.astype(np.int64) << np.int64(40) | self.first
        at = np.searchsorted(key, length.astype(np.int64) << np.int64(40) | rank, "right") - 1
        return self.bin[at] + (rank - self.first[at]) // self.per[at]


def best_fit(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> Plan:
    """Best-fit decreasing over (length, count); ties among equal spaces go to the bin opened first.

    Bins of one state are kept as ranges of bin numbers, so the work depends
    on the number of different lengths, not on the number of pieces.
    """
    caps = sorted(capacities)
    if histogram and max(histogram) > caps[-1]:
        raise ValueError("a piece is longer than the largest capacity")
    space: dict[int, list[tuple[int, int]]] = {}  # free tokens -> ranges (first bin, bins)
    free: list[int] = []  # the keys of space, in order
    rows: list[tuple[int, int, int, int]] = []
    n_bins = 0

    def give(room: int, first: int, n: int) -> None:
        if n and room >= smallest:
            if room not in space:
                space[room] = []
                insort(free, room)
            insort(space[room], (first, n))

    smallest = min(histogram, default=1)
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(free, length)
            if i < len(free):
                room = free[i]
                first, n = space[room].pop(0)
                if not space[room]:
                    del space[room], free[i]
                # the fullest bin that fits stays the fullest that fits, so it is filled before the next
                per = min(room // length, left)
                used = min(n, left // per)
                give(room, first + used, n - used)
                give(room - per * length, first, used)
                rows.append((length, rank, first, per))
                rank, left = rank + used * per, left - used * per
                continue
            fits = [c for c in caps if c >= length]
            cap = min(fits, key=lambda c: (cost(c) / (c // length * length), c))
            per = cap // length
            full, rest = divmod(left, per)
            if full:
                rows.append((length, rank, n_bins, per))
                give(cap - per * length, n_bins, full)
                rank, n_bins = rank + full * per, n_bins + full
            if rest:
                rows.append((length, rank, n_bins, rest))
                give(cap - rest * length, n_bins, 1)
                n_bins += 1
            left = 0
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 4)
    return Plan(a[:, 0], a[:, 1], a[:, 2], a[:, 3], n_bins)


def pieces(docs: DataFrame, tokens: Column, largest: int) -> DataFrame:
    """doc_id, piece, piece_start, n_tokens: texts longer than the largest capacity are cut into full pieces and a rest."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tokens.cast("long").alias("_t"))
    cuts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_t") - 1) / largest).cast("long"))
    return (t.select("doc_id", "_t", F.explode(cuts).alias("piece"))
            .select("doc_id", "piece", (F.col("piece") * largest).alias("piece_start"),
                    F.least(F.lit(largest).cast("long"), F.col("_t") - F.col("piece") * largest).alias("n_tokens")))


def byte_tokens() -> Column:
    """Tokens of a byte-level model: the text's UTF-8 bytes and one end mark (a null text has the mark alone)."""
    return F.octet_length(no_null(F.col("text").cast("string"))).cast("long") + 1


def pack(docs: DataFrame, tokens: Column | None = None, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """doc_id, piece, piece_start, n_tokens, bin, bin_size, bin_start, bin_used for every piece of every row.

    No token is dropped and no bin overflows; bin_start is the piece's place
    in its bin. Repeated rows and null doc_ids are packed like others, an empty
    table gives an empty result, and extra columns are not read.
    """
    caps = sorted(capacities)
    p = pieces(docs, byte_tokens() if tokens is None else tokens, caps[-1])
    sub = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_BUCKETS)).cast("int")
    p = cut(p.withColumn("sub", sub))
    counts = p.groupBy("n_tokens", "sub").agg(F.count("*").alias("n"))
    w = Window.partitionBy("n_tokens").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)  # RANK_BUCKETS rows
    firsts = counts.select("n_tokens", "sub", no_null(F.sum("n").over(w), 0).alias("before"))
    sums = p.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()  # a row for each length up to the capacity
    plan = best_fit({r["n_tokens"]: r["n"] for r in sums}, tuple(caps))
    shared = docs.sparkSession.sparkContext.broadcast(plan)  # ranges of lengths: bounded by the capacity, not by the corpus

    def look_up(b: pa.RecordBatch) -> pa.RecordBatch:
        n, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
        bins = shared.value.bins(n, rank) if len(n) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(bins, pa.int64())],
                                          ["doc_id", "piece", "piece_start", "n_tokens", "bin"])
    inside = Window.partitionBy("n_tokens", "sub").orderBy("doc_id", "piece")
    ranked = (p.withColumn("r", F.row_number().over(inside).cast("long") - 1).join(firsts, ["n_tokens", "sub"])
              .select("doc_id", "piece", "piece_start", "n_tokens", (F.col("before") + F.col("r")).alias("rank")))
    placed = arrow_map(ranked, look_up, "doc_id long, piece long, piece_start long, n_tokens long, bin long")
    whole = Window.partitionBy("bin")  # a bin's pieces: at most as many as the largest capacity has tokens
    upto = whole.orderBy(F.desc("n_tokens"), "doc_id", "piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    used = F.sum("n_tokens").over(whole)
    size = F.lit(caps[-1])
    for c in reversed(caps[:-1]):
        size = F.when(F.col("bin_used") <= c, F.lit(c)).otherwise(size)
    return (placed.withColumn("bin_start", F.sum("n_tokens").over(upto) - F.col("n_tokens")).withColumn("bin_used", used)
            .select("doc_id", "piece", "piece_start", "n_tokens", "bin", size.cast("long").alias("bin_size"), "bin_start", "bin_used"))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
