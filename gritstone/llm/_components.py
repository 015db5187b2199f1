"""Connected components of a written edge table, by alternating star contractions.

Each round replaces edges by edges towards the smallest neighbour, first among larger neighbours, then among smaller ones;
it ends when a round changes nothing. Nothing of size of the data reaches the driver: only two numbers a round do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.llm._store import drop, keep


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0


def _towards_least(pairs: DataFrame, own: bool) -> DataFrame:
    """Edges of each u to v become edges to the least of u's neighbours (and of u itself if ``own``)."""
    least = F.least("u", F.min("v")) if own else F.min("v")
    return pairs.groupBy("u").agg(least.alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of longs to (node, root): root is the smallest node that can be reached. Nodes without edges have no row."""
    now = keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        narrow=True,
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_towards_least(both, own=True), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = keep(large, narrow=True)
        small = large.join(_towards_least(large, own=False), "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        after = keep(small.select("e.u", "e.v").where("u <> v").distinct(), narrow=True)
        new = _mark(after)
        drop(now, large)
        now, done, mark = after, new == mark, new
        if done:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
