"""Connected components of a link table, on the executors only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of links(a, b): comp is the component's smallest node.

    Alternating large-star and small-star steps: each hangs a node's
    neighbours on their smallest one, until nothing changes. Node minima are
    summed up inside the tasks first, so a node with very many links is no
    hot group; every step's links are written to the checkpoint folder.
    """
    e = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").where("u <> v").distinct())
        e = cut(small)
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        now = (mark["n"], mark["h"])
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)
