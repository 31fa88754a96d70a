"""Connected components of an undirected graph, without gathering any component in one place.

Each round is a small-star step (every node hands its other smaller neighbours on to its smallest one)
followed by pointer jumping (every link moves to the smallest neighbour of its lower end). Both keep the
components, and both only lower the lower end of a link; rounds go on until nothing moves, when every node
hangs directly below the smallest one of its component. A path of n nodes takes about log2(n) rounds.

Links are stored with the larger end first, and grouped by it. A hub with a huge number of neighbours is
the lower end of its links, which only ever meets the single row of its own parent: a join that Spark can
split, never a group. Every round is a stored table, so that a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import cut
from lendspark.operators.skew import lookup


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: long) but the roots, the smallest nodes, themselves.

    Nulls and loops are ignored; links may be repeated and given in either direction. No links, no rows.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut(ordered.where((F.col("a") != F.col("b")) & links.a.isNotNull() & links.b.isNotNull()).distinct())
    while True:
        lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
        both = edges.join(lowest, "a")
        own = F.struct(F.col("a").alias("a"), F.col("low").alias("b"), F.lit(False).alias("moved"))
        other = F.struct(F.col("b").alias("a"), F.col("low").alias("b"), F.lit(True).alias("moved"))
        star = (
            both.select(F.explode(F.when(F.col("b") != F.col("low"), F.array(own, other)).otherwise(F.array(own))).alias("e"))
            .groupBy("e.a", "e.b")
            .agg(F.max("e.moved").alias("moved"))
        )
        parent = star.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("up"))
        jumped = lookup(star, parent, ["b"], "left").select(
            "a", F.coalesce("up", "b").alias("b"), (F.col("moved") | F.col("up").isNotNull()).alias("moved")
        )
        edges = cut(jumped.groupBy("a", "b").agg(F.max("moved").alias("moved")))
        if edges.where("moved").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = edges.select("a", "b")
