"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.tables import written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them and the node itself.

    The minimum is pre-aggregated in each task; the join back to the edges may be split by
    adaptive execution, so a node with very many neighbours needs no large group.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger \
        else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    met = both.join(low, "a")
    moved = met.where(F.col("b") > F.col("a")).select(F.col("low").alias("a"), "b") if larger \
        else met.select(F.col("low").alias("a"), "b").union(low.select(F.col("low").alias("a"), F.col("a").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): root is the smallest node reachable; nodes without an edge are left out.

    ``edges`` has columns a and b of an ordered type. Null ends and loops are ignored,
    repeated edges count once.
    """
    now = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = written(_star(_star(now, True), False), "stars")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
