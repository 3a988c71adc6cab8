"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievepoint.runtime import materialize


def components(edges: DataFrame) -> DataFrame:
    """Map every node of ``edges`` (long columns a, b) to the least node of its component: (node, root).

    Alternating stars: each node's neighbours are hung on the least of them, first the larger ones, then
    the smaller ones. The number of edges never grows and rounds grow with the logarithm of the longest
    path. Every round is a written table, so a lost executor costs one round at most. Self links and
    repeated links are allowed; NULL ends are ignored.
    """
    def hang(table: DataFrame) -> DataFrame:  # (child, parent) with child > parent
        return (table.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(table: DataFrame):
        return table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = materialize(hang(edges))
    before, after = None, state(now)
    while before != after:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = hang(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = hang(large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .union(lower.select("a", F.col("m").alias("b"))))
        now = materialize(small)
        before, after = after, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
