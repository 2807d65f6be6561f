"""Connected components of an edge table by alternating large and small stars.

Each star step is a minimum per node and a join back, so a node of many edges is never
gathered: its minimum is pre-aggregated and its edges are dealt by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with a > b. Large: every larger neighbour of a node joins the least of its
    neighbourhood. Small: the node and its smaller neighbours do."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both if large else edges
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = seen.join(least, "a")
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return out.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node with an edge (a, b): the component is its least node.

    Loops and repeated edges do no harm; without edges the result is empty. The number of
    rounds grows with the logarithm of the nodes."""
    now = scratch.write(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), f"{name}-0"
    )
    mark, round_ = _mark(now), 0
    while mark[0]:
        round_ += 1
        now = scratch.write(_star(_star(now, True), False), f"{name}-{round_}")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
