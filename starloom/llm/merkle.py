"""Operator 13: a Merkle manifest of a table, with a proof for every row.

Rows are leaves of their source's tree, the sources' subroots leaves of the
top tree; each run of FAN consecutive nodes is hashed into one (see ``H``).

* Leaves are range-partitioned by (source, doc_id): a *leaf partition* holds
  consecutive leaves, of one source or of several.
* Each leaf partition works out the nodes that lie wholly inside it and hands
  out the largest of them, a few for each level. From those, and from nothing
  else, the nodes above that span partitions are derived.
* Octopus multiproof: each leaf partition takes all its leaves as known, lists
  the coordinates that a run of theirs lacks (at most FAN - 1 on each side and
  level, none twice), fetches these once by a join, derives every interior its
  leaves share, and expands each leaf's own proof from that.

So what crosses the network besides the leaves grows with the number of
partitions times the tree's height, not with leaves times height.

Rows: null is a value of every field; null sources come first, as null doc_ids
within a source. Rows of one doc_id are ordered by their leaf; equal rows are
leaves each and are dealt to partitions by their place. A row without doc_id
is never tampered with. An empty table has no rows. Other columns than the
five are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import arrow_map, cut, no_null, ship, table

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves of a leaf partition, about: what a task holds at a time.
PART_LEAVES = 50_000
NODE = "tree long, level int, idx long, digest string"


def H(*inputs: str) -> str:
    """Lower-case hex SHA-256 of the inputs, concatenated."""
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(row: dict[str, Column | str] | None = None) -> Column:
    """The leaf of a row; ``row`` replaces fields by other columns."""
    fields = [F.col(c) if not row or c not in row else row[c] for c in FIELDS]
    text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[no_null(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), "-") for c in text]), 256)


def tampered() -> Column:
    """The text without line feeds where the CRC-32 of doc_id is even."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def sizes(n: int) -> list[int]:
    """The nodes of each level of a tree of n leaves, up to its root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def missing(a: int, b: int, n: int) -> Iterator[tuple[int, int]]:
    """The (level, index) that the leaves a to b - 1 of n need beside themselves: the least set, ascending by level."""
    lo, hi = a, b - 1
    for level, size in enumerate(sizes(n)[:-1]):
        yield from ((level, i) for i in range(lo // FAN * FAN, lo))
        yield from ((level, i) for i in range(hi + 1, min(hi // FAN * FAN + FAN, size)))
        lo, hi = lo // FAN, hi // FAN


def complete(leaves: list[str], a: int, n: int) -> Iterator[tuple[int, int, list[str]]]:
    """(level, first index, digests) of the nodes whose leaves all are among ``leaves``, which begin at a."""
    for level, size in enumerate(sizes(n)):
        if not leaves:
            return
        yield level, a, leaves
        up = -(-a // FAN)
        end = a + len(leaves)
        stop = -(-size // FAN) if end == size else end // FAN
        leaves = [H(*leaves[max(0, p * FAN - a):(p + 1) * FAN - a]) for p in range(up, stop)]
        a = up


def largest(leaves: list[str], a: int, n: int) -> Iterator[tuple[int, int, str]]:
    """The complete nodes that no other one contains."""
    rows = list(complete(leaves, a, n))
    for (level, at, nodes), above in zip(rows, [*rows[1:], None], strict=True):
        inside = range(above[1] * FAN, (above[1] + len(above[2])) * FAN) if above else range(0)
        yield from ((level, at + k, d) for k, d in enumerate(nodes) if at + k not in inside)


def derive(known: dict[tuple[int, int], str], n: int) -> Iterator[tuple[int, int, str]]:
    """The nodes over ``known`` that are not in it, up to the root; ``known`` covers all leaves."""
    by_level: dict[int, dict[int, str]] = {}
    for (level, i), d in known.items():
        by_level.setdefault(level, {})[i] = d
    here: dict[int, str] = {}
    for level, size in enumerate(sizes(n)[:-1]):
        here |= by_level.get(level, {})
        above: dict[int, str] = {}
        for p in sorted({i // FAN for i in here}):
            run = [here.get(i) for i in range(p * FAN, min(p * FAN + FAN, size))]
            if (level + 1, p) not in known and None not in run:
                above[p] = H(*run)
                yield level + 1, p, above[p]
        here = above


class Paths:
    """The known leaves a.. of a tree of n, with their fetched neighbours: the siblings on each leaf's way up."""

    def __init__(self, leaves: list[str], a: int, n: int, fetched: dict[tuple[int, int], str]):
        self.a, self.levels = a, []
        lo, nodes = a, leaves
        for level, size in enumerate(sizes(n)[:-1]):
            first, last = lo // FAN * FAN, min((lo + len(nodes) - 1) // FAN * FAN + FAN, size)
            row = [*(fetched[level, i] for i in range(first, lo)), *nodes, *(fetched[level, i] for i in range(lo + len(nodes), last))]
            runs = [row[i:i + FAN] for i in range(0, len(row), FAN)]
            self.levels.append((first, [("".join(r[:k]), "".join(r[k + 1:])) for r in runs for k in range(len(r))]))
            nodes, lo = [H(*r) for r in runs], lo // FAN
        self.root = nodes[0]

    def siblings(self, i: int) -> Iterator[tuple[str, str]]:
        """(left, right) of leaf i, level by level."""
        for first, row in self.levels:
            yield row[i - first]
            i //= FAN


def fold(digest: str, siblings: list[tuple[str, str]]) -> str:
    for left, right in siblings:
        digest = H(left, digest, right)
    return digest


def ranges(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (source, doc_id, leaf, ...) as leaf partitions, and the partitions' pieces.

    The first gains ``part`` and ``pos``, its place there. The second has for
    each part and source: tree (the source's number), a (its first leaf there),
    m (leaves there) and n (of the whole source).
    """
    spark = leaves.sparkSession
    leaves = cut(leaves).withColumn("place", F.monotonically_increasing_id())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // PART_LEAVES))
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("place")]
    dealt = cut(leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                .withColumn("part", F.spark_partition_id())
                .withColumn("pos", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33)).drop("place"))
    runs = dealt.groupBy("part", "source").agg(F.count(F.lit(1)).alias("m"))
    whole = Window.partitionBy("source")
    runs = runs.select("part", "source", "m", F.sum("m").over(whole).alias("n"),
                       (F.sum("m").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")).alias("a"))
    # a source counts where it begins; a part's first source may have begun before
    begun = runs.groupBy("part").agg(F.count_if(F.col("a") == 0).alias("new"))
    before = begun.select("part", (F.sum("new").over(Window.orderBy("part")) - F.col("new")).alias("before"))
    at = F.sum(F.when(F.col("a") == 0, 1).otherwise(0)).over(
        Window.partitionBy("part").orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    pieces = runs.join(before, "part").select(F.col("part").alias("part"), (F.col("before") + at - 1).alias("tree"), "a", "m", "n")
    return dealt.drop("source"), cut(pieces)


def _pieces(head: pa.Table) -> list[tuple[int, int, int, int]]:
    return sorted(zip(*(head.column(c).to_pylist() for c in ("tree", "a", "m", "n")), strict=True))


def _nodes(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.string())], ["tree", "level", "idx", "digest"])


def spanning(dealt: DataFrame, pieces: DataFrame) -> DataFrame:
    """The nodes (tree, level, idx, digest) that partitions hand out, and those derived from them up to each root."""
    def hand_out(left: pa.Table, right: pa.Table) -> pa.Table:
        leaves = left.sort_by("pos").column("leaf").to_pylist()
        out, at = [], 0
        for tree, a, m, n in _pieces(right):
            out += [(tree, *x) for x in largest(leaves[at:at + m], a, n)]
            at += m
        return _nodes(out)

    def join_up(t: pa.Table) -> pa.Table:
        tree, n = t.column("tree")[0].as_py(), t.column("n")[0].as_py()
        known = {(lv, i): d for lv, i, d in zip(*(t.column(c).to_pylist() for c in ("level", "idx", "digest")), strict=True)}
        return _nodes([(tree, *x) for x in derive(known, n)])

    ship(dealt.sparkSession)
    given = cut(dealt.select("part", "pos", "leaf").groupBy("part").cogroup(pieces.groupBy("part")).applyInArrow(hand_out, NODE))
    split = pieces.where("m < n").select("tree", "n").distinct()
    return given.unionByName(given.join(split, "tree").groupBy("tree").applyInArrow(join_up, NODE))


def top_tree(subroots: DataFrame, n: int) -> DataFrame:
    """All nodes of the tree over the subroots (idx, digest), level by level from the widest."""
    nodes = level = subroots.select(F.lit(-1).cast("long").alias("tree"), F.lit(0).alias("level"), "idx", "digest")
    for k in range(1, len(sizes(n))):
        up = level.groupBy(F.floor(F.col("idx") / FAN).cast("long").alias("up")).agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("run"))
        level = cut(up.select(F.lit(-1).cast("long").alias("tree"), F.lit(k).alias("level"), F.col("up").alias("idx"),
                              F.sha2(F.array_join("run.digest", ""), 256).alias("digest")))
        nodes = nodes.unionByName(level)
    return nodes


def _requests(pieces: DataFrame, n_sources: int) -> DataFrame:
    """(part, tree, level, idx): what each part lacks in its trees and in the top tree, -1."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(part, tree, *x) for part, tree, a, m, n in zip(*(c.to_pylist() for c in b.columns), strict=True) for x in missing(a, a + m, n)]
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                                          ["part", "tree", "level", "idx"])
    top = pieces.groupBy("part").agg(F.min("tree").alias("a"), (F.max("tree") - F.min("tree") + 1).alias("m"))
    all_ = pieces.where("m < n").select("part", "tree", "a", "m", "n").unionByName(
        top.select("part", F.lit(-1).cast("long").alias("tree"), "a", "m", F.lit(n_sources).cast("long").alias("n")))
    return arrow_map(all_, run, "part int, tree long, level int, idx long")


def prove(leaves: DataFrame) -> DataFrame:
    """For every leaf (source, doc_id, leaf, changed): doc_id, leaf, subroot, root, proof_sha256, folded_root.

    ``changed`` is the leaf that is folded up with the original siblings.
    """
    spark = leaves.sparkSession
    dealt, pieces = ranges(leaves)
    n_sources = int(pieces.agg(no_null(F.max("tree"), -1).alias("m")).first()["m"]) + 1
    nodes = cut(spanning(dealt, pieces))
    subroots = nodes.groupBy(F.col("tree").alias("idx")).agg(F.max_by("digest", "level").alias("digest"))
    top = top_tree(cut(subroots), n_sources)
    fetched = _requests(pieces, n_sources).join(nodes.unionByName(top), ["tree", "level", "idx"])
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
    head = pieces.select("part", "tree", "a", "m", "n", *none("int", "level"), *none("long", "idx"), *none("string", "digest")).unionByName(
        fetched.select("part", "tree", *none("long", "a", "m", "n"), "level", "idx", "digest"))
    kind = leaves.schema["doc_id"].dataType.simpleString()

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        own, changed = left.column("leaf").to_pylist(), left.column("changed").to_pylist()
        is_piece = right.column("m").is_valid()
        got: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, i, d in zip(*(right.filter(right.column("m").is_null()).column(c).to_pylist() for c in ("tree", "level", "idx", "digest")), strict=True):
            got.setdefault(tree, {})[level, i] = d
        at, trees = 0, []
        for tree, a, m, n in _pieces(right.filter(is_piece)):
            trees.append((tree, at, m, Paths(own[at:at + m], a, n, got.get(tree, {}))))
            at += m
        above = Paths([p.root for *_, p in trees], trees[0][0], n_sources, got.get(-1, {}))
        subroot, proof, folded = [], [], []
        for tree, at, m, paths in trees:
            rest = list(above.siblings(tree))
            for k in range(m):
                way = [*paths.siblings(paths.a + k), *rest]
                subroot.append(paths.root)
                proof.append(H(*(x for pair in way for x in pair)))
                folded.append(fold(changed[at + k], way))
        return pa.table([left.column("doc_id"), left.column("leaf"), pa.array(subroot, pa.string()),
                         pa.array([above.root] * len(own), pa.string()), pa.array(proof, pa.string()), pa.array(folded, pa.string())],
                        ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    ship(spark)
    return (dealt.select("part", "pos", "doc_id", "leaf", "changed").groupBy("part").cogroup(head.groupBy("part"))
            .applyInArrow(expand, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and whether the tampered row still folds up to the root."""
    docs = table(spark, sf_dir, "documents")
    leaves = docs.select("source", "doc_id", leaf().alias("leaf"), leaf({"text": tampered()}).alias("changed"))
    return prove(leaves).withColumn("verified", F.col("folded_root") == F.col("root"))
