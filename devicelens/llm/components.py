"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation (combined before the shuffle) and a join back to the
edges in which hot nodes are spread, so a node with any number of neighbours is
never gathered; each step is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_group_facts, stored

MAX_STEPS = 60  # each halves the longest path; far above any depth a corpus has


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("degree"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``component``) of every node with an edge; the component is its least node."""
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "cc")
    mark = None
    for _ in range(MAX_STEPS):
        count, total = e.count(), None
        if count == 0:
            break
        # large star: every greater neighbour of a node points to the node's least neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        total = 2 * count
        large = (join_group_facts(both, _least(both), "u", "degree", total).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        large = stored(large, "cc-large")
        # small star: a node and its lesser neighbours point to the least of them
        least = _least(large)
        small = join_group_facts(large, least, "u", "degree", large.count())
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        nxt = stored(small.select("e.u", "e.v").where("u > v").distinct(), "cc")
        row = nxt.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.countDistinct("u")).first()
        e, now = nxt, tuple(row)
        # done: every node has one edge, and no step moved any
        if now == mark and now[0] == now[2]:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
