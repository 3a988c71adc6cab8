"""Empirical distribution function and interpolated lookup in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.operators.ordered import row_index, running_total
from sievepoint.operators.search import build_index, search
from sievepoint.runtime import BROADCAST_ROWS, materialize


def ecdf(df: DataFrame, column: str) -> DataFrame:
    """(v, p): for each distinct value, rows at or under it over ``n + 1``."""
    counts = materialize(df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v"))
                         .agg(F.count(F.lit(1)).alias("n")))
    n = counts.agg(F.sum("n")).first()[0] or 0
    return running_total(counts, [F.col("v")], F.col("n"), "below").select(
        "v", (F.col("below") / F.lit(n + 1.0)).alias("p"))


def ecdf_lookup(df: DataFrame, x: Column, knots: DataFrame, name: str = "p", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Linear interpolation between the neighbouring knots, clamped at both ends."""
    numbered = row_index(knots.select(F.col("v").cast("double").alias("v"), "p"), [F.col("v")])
    following = numbered.select((F.col("idx") - 1).alias("idx"), F.col("v").alias("v1"), F.col("p").alias("p1"))
    # Knot numbers are unique, so this join has no heavy key.
    segments = materialize(numbered.join(following, "idx", "left").select(F.col("v").alias("key"), F.struct("v", "p", "v1", "p1").alias("value")))
    lowest = segments.agg(F.min_by("value.p", "key")).first()[0]
    found = search(df.withColumn("_x", x.cast("double")), F.col("_x"), build_index(segments, max_rows), "_at")
    s = lambda c: F.col(f"_at.{c}")
    value = (F.when(F.col("_x").isNull(), F.lit(None)).when(F.col("_at").isNull(), F.lit(lowest))
             .when(s("v1").isNull(), s("p"))
             .otherwise(s("p") + (F.col("_x") - s("v")) * (s("p1") - s("p")) / (s("v1") - s("v"))))
    return found.select(*df.columns, value.cast("double").alias(name))
