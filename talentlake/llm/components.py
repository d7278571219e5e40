"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.common import forget, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node on an edge (a, b) of longs; root: the least node
    that can be reached.

    Alternates two steps until nothing changes: each node hangs its larger
    neighbours under its least one, then its smaller ones. Each step only groups
    and joins, a node with very many edges sends partial minima, and a table in
    the shared folder cuts the lineage. The number of rounds grows with the
    logarithm of the longest chain."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
        # larger neighbours of n, under the least of n's neighbours and n itself
        large = now.join(low, now["b"] == low["n"]).select(F.col("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # smaller neighbours of a and a itself, under the least of them
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, large["a"] == low["n"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = written(small.unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct())
        mark = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        forget(now)
        now = after
        if mark == state:
            break
        state = mark
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct().join(roots, "node", "left_anti"))
