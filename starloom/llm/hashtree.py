"""Sharding by a hierarchical weighted hash tree.

A layout is regions > racks > shards, each shard with a weight; a rack or
region weighs what its shards weigh. A row descends level by level: at a node
every child draws ``-ln(u) / weight`` with ``u`` hashed from the child's name
and the row's key, and the smallest draw wins. A child's draw depends only on
its own name and weight, so when weights change, rows move only into or out of
subtrees whose weights changed.

Law ``key``: the key and the layout alone decide. ``grown`` hangs a new shard
into the root as a region of its own, so a larger count takes rows only into
the new shard and moves none between the old ones.

Only DataFrame functions are used: the draws, the per-shard numbering and the
digests all stay in generated code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import no_null, table

#: Sub-buckets a shard is cut into while its slots are numbered.
SLOT_BUCKETS = 1024


@dataclass(frozen=True)
class Node:
    """``shard`` is set on leaves, ``children`` on the levels above."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight

    @property
    def shards(self) -> list[int]:
        return [self.shard] if not self.children else [s for c in self.children for s in c.shards]


def layout(n_shards: int, racks_per_region: int = 2, shards_per_rack: int = 4,
           weights: dict[int, float] | None = None) -> Node:
    """Shards 0 to n-1 dealt to racks and regions in order."""
    if n_shards < 1:
        raise ValueError("a layout needs at least one shard")
    w = weights or {}
    regions, shard = [], 0
    while shard < n_shards:
        racks = []
        while shard < n_shards and len(racks) < racks_per_region:
            last = min(n_shards, shard + shards_per_rack)
            name = f"g{len(regions)}/r{len(racks)}"
            racks.append(Node(name, tuple(Node(f"{name}/s{s}", shard=s, own_weight=float(w.get(s, 1.0)))
                                          for s in range(shard, last))))
            shard = last
        regions.append(Node(f"g{len(regions)}", tuple(racks)))
    return Node("root", tuple(regions))


def grown(root: Node, weight: float = 1.0) -> Node:
    """The layout with one more shard, in a region of its own."""
    new = max(root.shards) + 1
    name = f"g{len(root.children)}"
    leaf = Node(f"{name}/r0/s{new}", shard=new, own_weight=float(weight))
    return Node(root.name, (*root.children, Node(name, (Node(f"{name}/r0", (leaf,)),))))


def _draw(node: Node, key: Column) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(node.name), key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / F.lit(float(node.weight))


def _win(node: Node, key: Column) -> Column:
    """The name of the child that wins at a node."""
    live = [c for c in node.children if c.weight > 0]
    if not live:
        raise ValueError(f"{node.name} has no weight")
    if len(live) == 1:
        return F.lit(live[0].name)
    return F.array_min(F.array(*[F.struct(_draw(c, key).alias("d"), F.lit(c.name).alias("name")) for c in live]))["name"]


def with_shard(df: DataFrame, root: Node, key: str, name: str) -> DataFrame:
    """``df`` with the int column ``name``: the shard the key descends to, one level a step.

    A null key is a key like any other.
    """
    level = [root]
    at = f"_{name}_at"
    df = df.withColumn(at, F.lit(root.name))
    while any(n.children for n in level):
        step = F.col(at)
        for n in level:
            if n.children:
                step = F.when(F.col(at) == n.name, _win(n, F.col(key))).otherwise(step)
        df = df.withColumn(at, step)
        level = [c for n in level for c in (n.children or (n,))]
    return df.withColumn(name, F.substring_index(F.col(at), "/s", -1).cast("int")).drop(at)


def assign(df: DataFrame, root: Node, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    size is the text's UTF-8 bytes (null: none) plus 8. Slots run from 0
    without gaps in every shard: a shard is cut into sub-buckets by a second
    hash, the sub-buckets' counts give each its first slot, and rows are
    numbered inside a sub-bucket only, so no shard is ever sorted in one task.
    Rows with equal keys, null keys among them, go to one shard; repeated rows
    get slots of their own. An empty text counts like a null one; an empty
    table gives an empty result. Other columns of ``df`` are not read.
    """
    sub = F.pmod(F.xxhash64(F.lit("slot"), "doc_id"), F.lit(SLOT_BUCKETS)).cast("int")
    at = (with_shard(df.select(F.col(key).cast("long").alias("doc_id")), root, "doc_id", "shard")
          .withColumn("sub", sub))
    w = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    first = (at.groupBy("shard", "sub").agg(F.count("*").alias("n"))
             .select("shard", "sub", no_null(F.sum("n").over(w), 0).alias("first")))
    body = no_null(F.col(text))
    rows = df.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = with_shard(with_shard(rows, root, "doc_id", "shard"), grown(root), "doc_id", "grown_shard")
    inside = Window.partitionBy("shard", "sub").orderBy("doc_id", "text_crc32", "size")
    # at most SLOT_BUCKETS rows for each shard, whatever the input's size
    return (rows.withColumn("sub", sub).withColumn("rank", F.row_number().over(inside).cast("long") - 1)
            .join(F.broadcast(first), ["shard", "sub"])
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("first") + F.col("rank")).alias("slot"), "grown_shard"))


def op5_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of shards 0 to 23: three regions of two racks of four."""
    return assign(table(spark, sf_dir, "documents"), layout(24))
