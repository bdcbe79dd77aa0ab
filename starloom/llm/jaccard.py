"""Exact n-gram Jaccard self-join by universe partitioning.

Documents become sets of word n-grams, and equal sets one node. Sizes are cut
into bands. A linked pair whose smaller set lies in a band differs in at most H
n-grams, so the 64-bit hash range is cut into segments, and some segment must
agree: with m segments of which d also tolerate one missing n-gram, m + d = H + 1
is enough (pigeonhole). Every set is indexed by the hash of its subset of each
segment, and in the d tolerant ones also by those of its subsets with one
n-gram deleted. m and d are allotted to each band by their estimated cost, which
the corpus' sizes give, and within a band each set probes only the segments that
tell most, as many as its own size asks for.

Sets that share a signature are candidates. Pairs are never listed within a
group. First each member is held against the group's smallest node, its leader;
the links found join nodes to components. Then, only for leaders whose groups
still span several components, blocks of their nodes are compared inside a task
by parity bitmaps, and the pairs of different components that the bitmaps
cannot tell apart are verified. Both verifications compare the sets themselves. As a component's
nodes need no further links among them, the components are those of all links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, arrow_map, bloom_bits, bloom_filter, cut, in_filter, mix64, open_filter, release, ship, slices, stored, table, utf8
from starloom.llm.components import components

#: A band holds sizes up to this times its smallest.
BAND = 1.5
#: Members of a group that are compared with each other in one task.
BLOCK = 1024
#: Bytes that a signature costs (its print, shuffled), and those that a chance meeting costs: a membership row,
#: and a bitmap of a quarter byte for each n-gram, written a few times. Segments are allotted by them.
ROW_BYTES, MEET_BYTES, MEET_BYTES_NGRAM = 4.0, 32.0, 0.75
#: Prints of a part of the hash range, about: what a task sorts.
PART_PRINTS = 4_000_000
_SALT = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Similarity:
    """Sets of ``n``-word shingles link when their intersection is at least num/den of their union."""

    n: int
    num: int
    den: int

    def differ(self, a: int, b: int) -> int:
        """The largest symmetric difference of linked sets of sizes a and b."""
        low = -(-self.num * (a + b) // (self.num + self.den))
        return a + b - 2 * low

    def largest(self, a: int) -> int:
        return a * self.den // self.num

    def smallest(self, b: int) -> int:
        return -(-b * self.num // self.den)


@dataclass(frozen=True)
class Band:
    """Sets of low to high n-grams; pairs whose smaller set is here differ in at most ``most``."""

    k: int
    low: int
    high: int
    most: int
    m: int
    d: int


def band_edges(k: int) -> tuple[int, int]:
    low = 1
    for _ in range(k):
        low = int(low * BAND) + 1
    return low, int(low * BAND)


def band_of(size: int) -> int:
    k = 0
    while band_edges(k)[1] < size:
        k += 1
    return k


def allot(most: int, size: float, n_sets: float) -> tuple[int, int]:
    """(m, d) with m + d >= most + 1, of the least estimated cost.

    A set costs its signatures: m, and one for each n-gram of the d tolerant
    segments. Unrelated sets meet where both have nothing in a segment, which
    is the likelier the smaller the segments are; both are priced in bytes.
    """
    best = None
    for d in range(0, (most + 1) // 2 + 1):
        m = most + 1 - d
        if m < max(d, 1):
            break
        per = size / m
        rows = n_sets * (m + d * per)
        pairs = n_sets * n_sets / 2 * m * math.exp(-2 * per)
        c = ROW_BYTES * rows + (MEET_BYTES + MEET_BYTES_NGRAM * size) * pairs
        if best is None or c < best[0]:
            best = (c, m, d)
        elif d > 64 and c > 4 * best[0]:
            break
    return best[1], best[2]


@dataclass
class Scheme:
    """Bands of a similarity for a corpus with about n_sets[k] sets in band k."""

    sim: Similarity
    n_sets: dict[int, float]
    n_grams: float = 0.0
    made: dict[int, Band] = field(default_factory=dict)

    def band(self, k: int) -> Band:
        if k not in self.made:
            low, high = band_edges(k)
            most = max(self.sim.differ(high, b) for b in {high, self.sim.largest(high)})
            most = max(most, self.sim.differ(high, max(high, self.sim.largest(high) - 1)))
            m, d = allot(most, (low + high) / 2, max(1.0, self.n_sets.get(k, 1.0))) if most > 0 else (0, 0)
            self.made[k] = Band(k, low, high, most, m, d)
        return self.made[k]

    def bands_for(self, size: int) -> list[Band]:
        """The bands a set is indexed in: its own, and lower ones that may hold a smaller partner."""
        k = band_of(size)
        out = [self.band(k)]
        while k > 0 and band_edges(k)[0] > self.sim.smallest(size):
            k -= 1
            out.append(self.band(k))
        return [b for b in out if b.most > 0]

    def need(self, size: int, b: Band) -> int:
        """The largest difference of a linked pair of this size whose smaller set is in the band."""
        high = max(size, min(self.sim.largest(size), self.sim.largest(b.high)))
        if size > b.high:
            return max(self.sim.differ(x, size) for x in {max(b.low, self.sim.smallest(size)), b.high})
        return max(self.sim.differ(size, x) for x in {size, high, max(size, high - 1)})


def shingle_hashes(text: bytes | None, n: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's n-word shingles (of all its words, if fewer)."""
    w = (text or b"").translate(LOWER).split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    k = max(1, len(w) - n + 1)
    g = np.full(k, np.uint64(min(n, len(w))))
    for i in range(min(n, len(w))):
        g = mix64(g + h[i:i + k])
    return np.unique(g)


def node_of(s: np.ndarray) -> int | None:
    """A 64-bit name of the set; equal sets have the same."""
    if not len(s):
        return None
    with np.errstate(over="ignore"):
        x = mix64(np.array([mix64(s ^ _SALT).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))
    return int(x.view(np.int64)[0])


def signatures(s: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, int]:
    """The set's signatures, those it probes first, and how many those are."""
    loud, quiet = [], []
    parts = mix64(s ^ _SALT)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)))
    for b in scheme.bands_for(len(s)):
        cuts = (np.arange(1, b.m, dtype=np.float64) * (2.0 ** 64 / b.m)).astype(np.uint64)
        edge = np.concatenate(([0], np.searchsorted(s, cuts), [len(s)]))
        count = np.diff(edge)
        sums = total[edge[1:]] - total[edge[:-1]]
        tag = mix64(np.arange(b.m, dtype=np.uint64) + np.uint64((b.k + 1) << 32))
        exact = mix64(sums ^ tag)
        # segments worth probing: the fullest, until what they tolerate covers the size's largest difference
        worth = np.where(np.arange(b.m) < b.d, 2, 1)
        order = np.argsort(-count, kind="stable")
        covered = np.cumsum(worth[order])
        n_probe = int(np.searchsorted(covered, min(scheme.need(len(s), b) + 1, covered[-1]))) + 1
        probes = np.zeros(b.m, bool)
        probes[order[:n_probe]] = True
        loud.append(exact[probes])
        quiet.append(exact[~probes])
        seg = np.repeat(np.arange(b.d), count[:b.d])  # of each n-gram in a tolerant segment
        without = mix64((sums[seg] - parts[:len(seg)]) ^ tag[seg])
        loud.append(without[probes[seg]])
        quiet.append(without[~probes[seg]])
    if not loud:
        return np.empty(0, np.uint64), 0
    a = np.concatenate(loud)
    return np.concatenate([a, *quiet]), len(a)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of the n-grams by bucket: at least 256 bits, and two for each n-gram.

    Two sets' bitmaps differ in no more bits than the sets differ in n-grams.
    """
    bits = 256
    while bits < 2 * len(s):
        bits *= 2
    at = np.bincount((s >> np.uint64(20)) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(at.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(x: np.ndarray, words: int) -> np.ndarray:
    """A bitmap's rows folded to fewer words (both stay valid)."""
    return np.bitwise_xor.reduce(x.reshape(*x.shape[:-1], -1, words), axis=-2)


def may_link(na: int, nb: int, a: bytes, b: bytes, sim: Similarity) -> int | None:
    """How many bits the bitmaps differ in; None if the sets cannot link."""
    lo, hi = min(na, nb), max(na, nb)
    if lo < sim.smallest(hi):
        return None
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    w = min(len(x), len(y))
    bits = int(np.bitwise_count(fold(x, w) ^ fold(y, w)).sum())
    return bits if bits <= sim.differ(lo, hi) else None


FEATURES = "doc_id long, text_key long, node long, n_shingles long, sigs array<bigint>, probes array<boolean>, bits binary"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))


@dataclass
class Copies:
    """Two filters that tell of each text's exact copies all but one (rarely two) to rest: ``keys`` holds the hashes of
    texts that occur twice or more, ``rows`` those of the rows that stand for them, and for texts ``keys`` takes for such."""

    keys: Broadcast
    rows: Broadcast

    def stand(self, key: np.ndarray, row: np.ndarray) -> np.ndarray:
        """True for the rows whose text is to be worked on."""
        return ~in_filter(open_filter(self.keys.value), key.view(np.uint64)) | in_filter(open_filter(self.rows.value), row.view(np.uint64))


def copies(docs: DataFrame) -> Copies:
    """Of copies one row stands for all, that of the smallest hash. Only hashes are shuffled."""
    spark = docs.sparkSession
    keyed = docs.select(F.xxhash64("text").alias("key"), _row_key().alias("row"))
    # the count is summed inside the tasks first, so that a text of very many copies is no hot group
    many = cut(keyed.groupBy("key").agg(F.min("row").alias("row"), F.count("*").alias("n")).where("n > 1").select("key", "row"))
    bits = bloom_bits(many.count())
    keys = spark.sparkContext.broadcast(bloom_filter(many.select("key"), bits))

    def taken(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pa.array(in_filter(open_filter(keys.value), b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
    mistaken = arrow_map(keyed, taken, "key long, row long").join(many.select("key"), "key", "left_anti")
    rows = cut(many.select("row").unionByName(mistaken.select("row")))
    return Copies(keys, spark.sparkContext.broadcast(bloom_filter(rows, max(bits, bloom_bits(rows.count())))))


def _row_key():
    return F.xxhash64(F.xxhash64("text"), F.col("doc_id").cast("long"))


def features(docs: DataFrame, scheme: Scheme, once: Copies, shared: Broadcast, parts: int) -> DataFrame:
    """A row for each document, with the signatures that the filter ``shared`` holds.

    Most signatures are one set's alone and never leave the task. Of exact
    copies one row has signatures, of equal sets in one task the first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held = open_filter(shared.value)
        for b in slices(batches):
            nodes, sizes, probes, sigs, bits = [], [], [], [], []
            stands = once.stand(*(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 3))).tolist()
            for x, stand in zip(utf8(b.column(2)), stands, strict=True):
                s = shingle_hashes(x, scheme.sim.n)
                node = node_of(s)
                nodes.append(node)
                sizes.append(len(s))
                if node is None or not stand or node in seen:
                    probes.append([])
                    sigs.append([])
                    bits.append(None)
                    continue
                seen.add(node)
                sig, n = signatures(s, scheme)
                at = np.flatnonzero(in_filter(held, _print_hash(*_prints(sig, parts))))
                probes.append(at < n)
                sigs.append(sig[at].view(np.int64))
                bits.append(bitmap(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(sigs, pa.list_(pa.int64())), pa.array(probes, pa.list_(pa.bool_())), pa.array(bits, pa.binary())],
                ["doc_id", "text_key", "node", "n_shingles", "sigs", "probes", "bits"])
    ship(docs.sparkSession)
    return _texts(docs).withColumn("row", _row_key()).mapInArrow(run, FEATURES)


def scheme_for(docs: DataFrame, sim: Similarity) -> Scheme:
    """Bands' sizes are estimated from the texts' lengths at six bytes a word; only costs depend on them."""
    size = F.greatest(F.lit(1), F.octet_length(F.col("text").cast("string")) / 6)
    bucket = F.floor(F.log(size) * 8).cast("int")
    n: dict[int, float] = {}
    grams = 0.0
    for r in docs.groupBy(bucket.alias("b")).count().collect():  # some hundred buckets at most
        if r["b"] is not None:
            words = math.exp((r["b"] + 0.5) / 8)
            k = band_of(max(1, int(words)))
            n[k] = n.get(k, 0) + r["count"]
            grams += words * r["count"]
    return Scheme(sim, n, grams)


def _sketches(feats: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, bits) of the nodes asked for."""
    return (feats.where("bits is not null").select("node", F.col("n_shingles").alias("n"), "bits")
            .join(nodes, "node", "left_semi").dropDuplicates(["node"]))


def _closest(star: DataFrame, feats: DataFrame, sim: Similarity) -> DataFrame:
    """Of pairs (a, b) that the bitmaps leave, the closest a for each b."""
    def run(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in slices([whole]):
            got = []
            for x, y, nx, ny, bx, by in zip(*(c.to_pylist() for c in b.columns), strict=True):
                bits = may_link(nx, ny, bx, by, sim)
                if bits is not None:
                    got.append((x, y, bits))
            cols = list(zip(*got, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "bits"])
    nodes = star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
    sk = cut(_sketches(feats, nodes))
    rows = (star.join(sk.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba")), "a")
            .join(sk.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb")), "b")
            .select("a", "b", "na", "nb", "ba", "bb"))
    return (arrow_map(rows, run, "a long, b long, bits long").groupBy("b").agg(F.min(F.struct("bits", "a")).alias("x"))
            .select(F.col("x.a").alias("a"), "b"))


def _verify(docs: DataFrame, feats: DataFrame, pairs: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs (a, b) whose sets link.

    The sets are made again from the texts that the pairs ask for; a Bloom
    filter of fixed size over the texts' hashes keeps the others out of the
    shuffle.
    """
    nodes = cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    keys = feats.select("node", "text_key").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("k"))
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(keys.select("k")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = open_filter(shared.value), set()
        for b in slices(batches):
            at = np.flatnonzero(in_filter(bits, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            names, raw = [], []
            for x in utf8(b.column(1).take(pa.array(at))):
                s = shingle_hashes(x, sim.n)
                node = node_of(s)
                if node is not None and node not in seen:
                    seen.add(node)
                    names.append(node)
                    raw.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(raw, pa.binary())], ["node", "items"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            left, right = [], []
            for x, y, sx, sy in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s, t = np.frombuffer(sx, np.uint64), np.frombuffer(sy, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if sim.den * both >= sim.num * (len(s) + len(t) - both):
                    left.append(x)
                    right.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    src = docs.select(F.xxhash64("text").alias("k"), F.col("text").cast("string").alias("text"))
    made = cut(src.mapInArrow(sets, "node long, items binary").join(nodes, "node", "left_semi").dropDuplicates(["node"]))
    rows = (pairs.join(made.select(F.col("node").alias("a"), F.col("items").alias("ia")), "a")
            .join(made.select(F.col("node").alias("b"), F.col("items").alias("ib")), "b").select("a", "b", "ia", "ib"))
    return rows.mapInArrow(compare, "a long, b long")


def _across(members: DataFrame, comps: DataFrame, feats: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs of different components that share a leader and that the bitmaps leave, where a leader's nodes span several."""
    named = (members.join(comps, "node", "left")
             .select("a", "node", F.coalesce("comp", "node").alias("comp")))
    live = (named.groupBy("a").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
            .where("lo <> hi").select("a", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = cut(named.join(live, "a"))
    sk = _sketches(feats, rows.select("node").distinct())
    mine = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    rows = (rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("a", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "node", "comp")
            .join(sk, "node").select("a", "p", "q", "mine", "node", "comp", "n", "bits")
            .repartition("a", "p", "q").sortWithinPartitions("a", "p", "q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        for b in slices(batches):
            got: set[tuple[int, int]] = set()
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[:3] != key:
                    got.update(_block_pairs(key, held, sim))
                    key, held = r[:3], []
                held.append(r[3:])
            yield _pairs_batch(got)
        yield _pairs_batch(set(_block_pairs(key, held, sim)))
    return rows.mapInArrow(run, "a long, b long").distinct()


def _pairs_batch(got: set[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(sorted(got), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])


def _block_pairs(key, held: list[tuple], sim: Similarity) -> list[tuple[int, int]]:
    """Pairs of rows (mine, node, comp, n, bits) of the block pair that may link and are of different components."""
    if len(held) < 2:
        return []
    mine, node, comp, n = (np.array([r[i] for r in held], np.int64) for i in range(4))
    words = min(len(r[4]) for r in held) // 8
    bits = np.stack([fold(np.frombuffer(r[4], np.uint64), words) for r in held])
    _, p, q = key
    rows = np.flatnonzero(mine == p)
    cols = np.flatnonzero(mine == q)
    out = []
    for i in rows.tolist():
        j = cols[cols > i] if p == q else cols
        j = j[comp[j] != comp[i]]
        if not len(j):
            continue
        lo, hi = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        most = lo + hi - 2 * (-(-sim.num * (lo + hi) // (sim.num + sim.den)))
        diff = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1)
        ok = j[(lo * sim.den >= hi * sim.num) & (diff <= most)]
        out += [(min(int(node[i]), int(x)), max(int(node[i]), int(x))) for x in node[ok].tolist()]
    return out


def _prints(sigs: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, 31-bit print) of signatures: from their halves, which are independent."""
    return (sigs >> np.uint64(32)) % np.uint64(parts), sigs & np.uint64(0x7FFFFFFF)


def _print_hash(part: np.ndarray, fp: np.ndarray) -> np.ndarray:
    return mix64((part << np.uint64(32)) | fp)


def _shared_signatures(docs: DataFrame, scheme: Scheme, once: Copies, parts: int) -> bytes:
    """A Bloom filter of the signatures that occur twice or more, one of them probing, sized by their number.

    Most signatures are one set's alone, and of the others many are probed by
    no set. To find the rest, only 31-bit prints and a bit for probing travel,
    packed by part of the hash range, and of a print no more than two copies
    from some 500 documents; a part's prints are sorted, and those kept that
    occur twice and are probed.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in slices(batches):
            found, quiet = [np.empty(0, np.uint64)], [np.empty(0, bool)]
            stands = once.stand(*(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)))
            for x in utf8(b.column(0).filter(pa.array(stands))):
                s = shingle_hashes(x, scheme.sim.n)
                node = node_of(s)
                if node is not None and node not in seen:
                    seen.add(node)
                    sig, n = signatures(s, scheme)
                    found.append(sig)
                    quiet.append(np.arange(len(sig)) >= n)
            part, fp = _prints(np.concatenate(found), parts)
            # by print, the probing ones first
            key = np.sort((part << np.uint64(32)) | (fp << np.uint64(1)) | np.concatenate(quiet).astype(np.uint64))
            name = key >> np.uint64(1)
            key = key[np.concatenate((np.ones(min(2, len(key)), bool), name[2:] != name[:-2]))]
            at, first = np.unique(key >> np.uint64(32), return_index=True)
            pieces = np.split((key & np.uint64(0xFFFFFFFF)).astype("<u4"), first[1:]) if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array([x.tobytes() for x in pieces], pa.binary())],
                                             ["part", "prints"])

    def twice(t: pa.Table) -> pa.Table:
        x = np.sort(np.concatenate([np.frombuffer(v, "<u4") for v in t.column("prints").to_pylist()]))
        name = x >> np.uint32(1)
        again = np.concatenate((name[1:] == name[:-1], [False]))
        first = np.concatenate(([True], name[1:] != name[:-1]))
        x = name[first & again & (x & np.uint32(1) == 0)].astype(np.uint64)
        part = np.full(len(x), t.column("part")[0].as_py(), np.uint64)
        return pa.table({"h": pa.array(_print_hash(part, x).view(np.int64))})
    ship(docs.sparkSession)
    packed = _texts(docs).select("text", "text_key", _row_key().alias("row")).mapInArrow(pack, "part long, prints binary")
    shared = cut(packed.groupBy("part").applyInArrow(twice, "h long"))
    return bloom_filter(shared, bloom_bits(shared.count()))


def _signature_rows(feats: DataFrame) -> DataFrame:
    """(sig, node, probe) of the signatures that two sets may share."""
    return feats.select("node", F.explode(F.arrays_zip("sigs", "probes")).alias("x")).select(F.col("x.sigs").alias("sig"), "node", F.col("x.probes").alias("probe"))


def join(docs: DataFrame, sim: Similarity) -> tuple[DataFrame, DataFrame]:
    """(features of every document, components of the linked nodes)."""
    spark = docs.sparkSession
    scheme = scheme_for(docs, sim)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(scheme.n_grams // PART_PRINTS) + 1)
    once = copies(docs)
    shared = spark.sparkContext.broadcast(_shared_signatures(docs, scheme, once, parts))
    release(spark)  # the prints are no longer needed
    feats = cut(features(docs, scheme, once, shared, parts))
    rows = _signature_rows(feats)
    groups = (rows.groupBy("sig").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.max("probe").alias("probe"))
              .where("a <> z and probe").select("sig", "a"))
    members = cut(rows.select("sig", "node").join(groups, "sig").select("a", "node").distinct())
    first = cut(_closest(members.where("a <> node").select("a", F.col("node").alias("b")), feats, sim))
    links = cut(_verify(docs, feats, first, sim))
    comps = cut(components(links))
    more = cut(_across(members, comps, feats, sim).join(first, ["a", "b"], "left_anti"))
    found = _verify(docs, feats, more, sim)
    return feats, cut(components(links.union(found)))


def similar_documents(docs: DataFrame, sim: Similarity) -> DataFrame:
    """doc_id, n_shingles, component_id, node for every row.

    component_id is the smallest doc_id that links reach, the document's own
    included. Texts that are null or have no word have an empty set, link with
    nothing and are their own component. Null doc_ids link like others but are
    no component_id unless a component has none else. Repeated rows are kept
    each; an empty table gives an empty result; extra columns are not read.
    """
    feats, comps = join(docs, sim)
    label = F.coalesce("comp", "node")
    named = feats.select("doc_id", "n_shingles", "node").join(comps, "node", "left").withColumn("label", label)
    least = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return (named.join(least, "label", "left")
            .select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "node"))


def keep_one(docs: DataFrame, sim: Similarity) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's (ties: the smallest text hash). Every column stays.

    Rows without words are components of their own and stay.
    """
    feats, comps = join(docs, sim)
    named = (feats.where("node is not null").select("doc_id", "text_key", "node").join(comps, "node", "left")
             .withColumn("label", F.coalesce("comp", "node")))
    best = named.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "text_key")).alias("x"))
    gone = stored(named.join(best, "label").where("not (doc_id <=> x.doc_id and text_key = x.text_key)")
                  .select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct())
    kept = _without(docs, gone)
    again = (named.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1")
             .select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")))
    again = stored(again)
    return kept if again.isEmpty() else _once(kept, again)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose (doc_id, text hash) is in gone(_d, _k).

    A Bloom filter of fixed size tells most rows to stay where they are; only
    the others are shuffled to the exact join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(gone.select(F.xxhash64("_d", "_k"))))
    keyed = docs.select(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("_key"), *docs.columns)

    def part(inside: bool) -> DataFrame:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            hit = in_filter(open_filter(shared.value), b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            return b.filter(pa.array(hit == inside)).select(range(1, b.num_columns))
        return arrow_map(keyed, run, docs.schema)
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_k"))
    return part(False).unionByName(part(True).join(gone, on, "left_anti"))


def _once(docs: DataFrame, again: DataFrame) -> DataFrame:
    """``docs`` with a single row for each (doc_id, text) in ``again``; the others pass as they are."""
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_k"))
    many = docs.join(again, on, "left_semi").withColumn("_k", F.xxhash64("text"))
    return docs.join(again, on, "left_anti").unionByName(many.dropDuplicates(["doc_id", "_k"]).drop("_k"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a Jaccard similarity of 0.9 over three-word shingles."""
    return similar_documents(table(spark, sf_dir, "documents"), Similarity(3, 90, 100)).drop("node")
