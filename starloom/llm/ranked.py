"""Operator 11: ranked lexical search by the Best Position Algorithm (BPA).

The corpus is split into shards of whole documents. A shard holds, for every
term of the queries, its *impact list*: the documents by falling impact (the
term's part of a document's score), which can also be asked for one document.
For a query, lists are read in sorted order; each document that turns up is
asked for in all lists of the query at once, which gives its score and marks
the positions where it stands. A list's best position is the end of the
gapless run of marked positions from its top: direct accesses push it ahead of
the last position read. No unseen document can score more than the sum of the
impacts at the best positions; reading stops when that is strictly less than
the k-th score, so that ties are whole. The list whose next impact is highest
is read next.

Statistics (documents, lengths, document frequencies) cover all documents and
are integer sums, so a shard's scores are final. A task hands on its k best of
each query, seen over all its shards, and starts each shard with the k-th
score it has; the k best of those are the answer.

Queries go in blocks of at most BLOCK_BYTES of text, each a pass over the
documents; what is sent to the executors is bounded by that.

Rows: a document without terms is never found, a null text has none. A query
without terms has no rows; repeated queries and null item_ids are answered
each. Equal scores go by ascending doc_id, null last; rows of one doc_id are
documents each. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, cut, ship, slices, stored, table, utf8

K = 20
#: Query text of a block; documents and postings of a shard, about.
BLOCK_BYTES, SHARD_DOCS, SHARD_POSTINGS = 16 << 20, 100_000, 16_000_000
#: Positions of a list that are read at a time.
STEP = 256

#: Bytes that end a term become spaces: all ASCII but letters and digits.
_SPLIT = bytes(LOWER[c] if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(raw: bytes | None) -> list[bytes]:
    """The terms of a text's UTF-8 bytes, in order."""
    return raw.translate(_SPLIT).split() if raw else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(w, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of the scores, in 64-bit integers."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def damping(n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    return 75 + (25 * n * n_docs) // length


class Shard:
    """The impact lists of some documents. doc, term, tf: postings, one for each document and term."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, weights: np.ndarray):
        self.n_docs = len(m)
        imp = impacts(weights[term], tf, m[doc])
        by_impact = np.lexsort((doc, -imp, term))
        self.doc, self.impact = doc[by_impact], imp[by_impact]
        self.first = np.searchsorted(term[by_impact], np.arange(len(weights) + 1))
        # for direct access: (term, doc) ascending, with the place in the list
        key = term[by_impact].astype(np.int64) * max(1, self.n_docs) + self.doc
        self.at = np.argsort(key)
        self.key = key[self.at]

    def search(self, query: list[tuple[int, int]], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, documents looked at): all that may be among the k best.

        query: (term, how often). Documents that score less than ``floor`` may be left out.
        """
        lists = [(int(self.first[t]), int(self.first[t + 1]), t, q) for t, q in query if self.first[t + 1] > self.first[t]]
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        lo, hi, term, often = (np.array(x, np.int64) for x in zip(*lists, strict=True))
        marked = [np.zeros(b - a, bool) for a, b, *_ in lists]
        best = np.zeros(len(lists), np.int64)  # gapless marked positions from the top
        seen = np.zeros(self.n_docs, bool)
        bound = often * self.impact[lo]  # most that an unseen document can get from each list
        docs, scores, kth = [], [], floor
        top = np.empty(0, np.int64)
        while (total := int(bound.sum())) > 0 and total >= kth:
            i = int(np.argmax(bound))
            a = lo[i] + best[i]  # what stands above has been marked
            b = min(a + STEP, hi[i])
            new = self.doc[a:b]
            new = new[~seen[new]]
            marked[i][a - lo[i]:b - lo[i]] = True
            if len(new):
                seen[new] = True
                score = np.zeros(len(new), np.int64)
                base = term * max(1, self.n_docs)
                for j in range(len(lists)):  # direct accesses
                    where = np.searchsorted(self.key, base[j] + new)
                    where[where == len(self.key)] = 0
                    hit = self.key[where] == base[j] + new
                    place = self.at[where[hit]]
                    score[hit] += often[j] * self.impact[place]
                    marked[j][place - lo[j]] = True
                keep = score >= max(kth, 1)
                docs.append(new[keep])
                scores.append(score[keep])
                top = np.concatenate([top, score[keep]])
                if len(top) >= k:
                    top = -np.partition(-top, k - 1)[:k]
                    kth = max(kth, int(top.min()))
            for j in range(len(lists)):
                p, row = int(best[j]), marked[j]
                if p < len(row) and row[p]:
                    rest = row[p:]
                    stop = int(np.argmin(rest))
                    best[j] = p = len(row) if rest[stop] else p + stop
                    bound[j] = often[j] * self.impact[lo[j] + p] if p < len(row) else 0
        return (np.concatenate(docs) if docs else np.empty(0, np.int64),
                np.concatenate(scores) if scores else np.empty(0, np.int64), int(seen.sum()))


def best(ids: np.ndarray, known: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best: by score, then by id, those without one last."""
    return np.lexsort((ids, ~known, -scores))[:k]


def _blocks(queries: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """(qid, text) in blocks of at most BLOCK_BYTES, or one text; ``queries`` is numbered by qid."""
    lots = queries.where("text is not null").withColumn("lot", F.floor(F.col("qid") / 64))
    sums = lots.groupBy("lot").agg(F.sum(F.octet_length("text")).alias("n"))
    size = F.sum("n").over(Window.orderBy("lot")) - F.col("n")
    placed = cut(sums.select("lot", F.floor(size / BLOCK_BYTES).alias("block")))
    for (block,) in sorted(map(tuple, placed.select("block").distinct().collect())):
        rows = lots.join(placed.where(F.col("block") == block), "lot").select("qid", "text").collect()
        yield sorted((r["qid"], r["text"].encode()) for r in rows)


def _postings(docs: DataFrame, vocabulary: dict[bytes, int], kind: str) -> DataFrame:
    """Documents with terms: doc_id, n, the query terms they hold and how often (32-bit, as bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            keep, n, term, tf = [], [], [], []
            for i, raw in enumerate(utf8(b.column(1))):
                words = terms(raw)
                if not words:
                    continue
                held = [(t, c) for w, c in Counter(words).items() if (t := vocabulary.get(w)) is not None]
                keep.append(i)
                n.append(len(words))
                term.append(np.array([t for t, _ in held], "<u4").tobytes())
                tf.append(np.array([c for _, c in held], "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                                              pa.array(term, pa.binary()), pa.array(tf, pa.binary())], ["doc_id", "n", "term", "tf"])
    ship(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, n long, term binary, tf binary")


def _frequencies(postings: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and each term's df: partial sums in the tasks, then one row a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(size, np.int64), 0, 0
        for b in batches:
            docs += b.num_rows
            length += int(b.column(0).to_numpy(zero_copy_only=False).sum()) if b.num_rows else 0
            for raw in b.column(1).to_pylist():
                df[np.frombuffer(raw, "<u4")] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *held.tolist()], pa.int64()), pa.array([docs, length, *df[held].tolist()], pa.int64())], ["term", "n"])
    rows = postings.select("n", "term").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = {r["term"]: r["n"] for r in rows}
    df = np.zeros(size, np.int64)
    for t, n in got.items():
        if t >= 0:
            df[t] = n
    return got.get(-2, 0), got.get(-1, 0), df


def _search(postings: DataFrame, queries: list[tuple[int, list[tuple[int, int]]]], weights: np.ndarray, n_docs: int,
            length: int, k: int, kind: str) -> DataFrame:
    """Each task's k best of every query: qid, doc_id, score, looked (documents looked at in the task)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        looked: Counter = Counter()

        def shard(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held)
            term = [np.frombuffer(x, "<u4") for x in t.column("term").to_pylist()]
            doc = np.repeat(np.arange(len(term)), [len(x) for x in term])
            tf = np.frombuffer(b"".join(t.column("tf").to_pylist()), "<u4").astype(np.int64)
            ids, known = t.column("doc_id").fill_null(0).to_numpy(), t.column("doc_id").is_valid().to_numpy()
            s = Shard(doc, np.concatenate(term).astype(np.int64), tf, damping(t.column("n").to_numpy(), n_docs, length), weights)
            for qid, query in queries:
                old = found.get(qid)
                floor = int(old[2][-1]) if old and len(old[2]) >= k else 0
                d, score, n = s.search(query, k, floor)
                looked[qid] += n
                if not len(d):
                    continue
                i, kn = ids[d], known[d]
                if old:
                    i, kn, score = np.concatenate([old[0], i]), np.concatenate([old[1], kn]), np.concatenate([old[2], score])
                keep = best(i, kn, score, k)
                found[qid] = i[keep], kn[keep], score[keep]

        held, docs, size = [], 0, 0
        for b in batches:
            held.append(b)
            docs += b.num_rows
            size += sum(map(len, b.column(2).to_pylist())) // 4
            if docs >= SHARD_DOCS or size >= SHARD_POSTINGS:
                shard(held)
                held, docs, size = [], 0, 0
        if docs:
            shard(held)
        for qid, (i, kn, score) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([qid] * len(i), pa.int64()), pa.array(i, mask=~kn), pa.array(score),
                                              pa.array([looked[qid]] * len(i), pa.int64())], ["qid", "doc_id", "score", "looked"])
    return postings.mapInArrow(run, f"qid long, doc_id {kind}, score long, looked long")


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The k best documents (doc_id, text) of each query (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = queries.schema["item_id"].dataType.simpleString()
    numbered = cut(queries.select("item_id", F.col("text").cast("string").alias("text")).withColumn("qid", F.monotonically_increasing_id()))
    parts = []
    for block in _blocks(numbered):
        asked = [(qid, Counter(terms(text))) for qid, text in block]
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, c in asked for w in c}))}
        if not vocabulary:
            continue
        postings = stored(_postings(docs, vocabulary, kind))
        n_docs, length, df = _frequencies(postings, len(vocabulary))
        weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
        found = _search(postings, [(qid, sorted((vocabulary[w], n) for w, n in c.items())) for qid, c in asked if c],
                        weights, n_docs, length, k, kind)
        order = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        parts.append(cut(found.select("qid", "doc_id", "score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)))
    if not parts:
        return spark.createDataFrame([], f"item_id {named}, rank int, doc_id {kind}, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.join(numbered.select("qid", "item_id"), "qid").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
