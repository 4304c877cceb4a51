"""Connected components of a graph given as edges, by alternating large and small stars.

Each round links every node to its smallest neighbour, so chains shorten by half and hubs
cost a minimum with partial aggregation. Rounds are written to the shared folder: lineage
stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgloom.operators.keys import own_shuffle
from kgloom.session import materialized


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(own_shuffle(F.col("a")).alias("key"), F.least("a", "m").alias("m"))
    joined = both.where("b > a").withColumn("key", own_shuffle(F.col("a"))).join(least, "key")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    keyed = least.select(own_shuffle(F.col("a")).alias("key"), "m")
    others = down.withColumn("key", own_shuffle(F.col("a"))).join(keyed, "key").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionAll(others).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node that has an edge, other than roots: the root is the smallest node of its component.

    ``edges`` has columns a and b of one ordered type; loops and repeats do no harm.
    """
    current = materialized(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if not mark[0] or mark == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        current = materialized(_small_star(_large_star(current)), "edges")
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
