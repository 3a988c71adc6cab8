"""Totals, positions and carried values over one global order, with no single-task window.

A window without ``partitionBy``, or with one huge group, puts its rows on one task. Here rows
are range-partitioned on the whole order, each range is summed by itself, and the ranges are
joined up through a table with one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sievepoint.runtime import materialize

PART, POS = "_part", "_pos"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def in_ranges(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """``df`` plus its range number and its position in the range; ``parts`` ranges, else as many as a shuffle has.

    ``order`` must be total, else equal keys make one range heavy. The result must be used once, or
    written: a second evaluation could draw other range bounds.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order)
    mark = F.monotonically_increasing_id()
    return (ordered.withColumn("_mark", mark)
            .withColumn(PART, F.shiftright("_mark", _ROW_BITS))
            .withColumn(POS, F.col("_mark").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
            .drop("_mark"))


def range_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    return materialize(in_ranges(df, order))


def row_index(df: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row in the global order."""
    parts = range_parts(df, order)
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("_n")).select(
        PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # One row per range, so the broadcast side is bounded by the partition count.
    return (parts.join(F.broadcast(offsets), PART)
            .withColumn(name, F.col("_base") + F.col(POS))
            .drop(PART, POS, "_base"))


def _group_key(group: list[str]) -> Column:
    return F.struct(*group) if group else F.lit(0)


def _by_range(df: DataFrame, group: list[str], order: list[Column]) -> tuple[DataFrame, W]:
    parts = in_ranges(df, [*(F.col(g) for g in group), *order]).withColumn("_g", _group_key(group))
    local = (W.partitionBy(PART, "_g").orderBy(POS)
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    return parts, local


def _link(summed: DataFrame, local: str) -> DataFrame:
    """Per range: its first and last group and the local value at its last row."""
    return summed.groupBy(PART).agg(
        F.min_by("_g", POS).alias("_first"),
        F.max_by("_g", POS).alias("_last"),
        F.max_by(local, POS).alias("_tail"),
    )


def running_total(df: DataFrame, order: list[Column], value: Column, name: str = "total",
                  group: list[str] | None = None) -> DataFrame:
    """Add the inclusive running sum of ``value``, restarted for each ``group``."""
    parts, local = _by_range(df, group or [], order)
    # Written with its sums, which the links and the rows are both read from.
    summed = materialize(parts.withColumn("_local", F.sum(value).over(local)))
    # A group that spans ranges is the last group of every range but its final one.
    so_far = W.partitionBy("_last").orderBy(PART).rowsBetween(W.unboundedPreceding, W.currentRow)
    links = (_link(summed, "_local")
             .withColumn("_sum", F.sum("_tail").over(so_far))
             .withColumn("_prev", F.lag(F.struct("_last", "_sum")).over(W.orderBy(PART)))
             .select(PART, "_first",
                     F.when(F.col("_prev._last") == F.col("_first"), F.col("_prev._sum"))
                     .alias("_carry")))
    carry = F.when(F.col("_g") == F.col("_first"), F.col("_carry"))
    zero = F.lit(0)
    return (summed.join(F.broadcast(links), PART)
            .withColumn(name, F.coalesce(F.col("_local"), zero) + F.coalesce(carry, zero))
            .drop(PART, POS, "_g", "_local", "_first", "_carry"))


def carry_last(df: DataFrame, order: list[Column], value: Column, name: str,
               group: list[str] | None = None) -> DataFrame:
    """Add the last non-NULL ``value`` at or before each row of the order, within ``group``."""
    parts, local = _by_range(df, group or [], order)
    seen = materialize(parts.withColumn("_local", F.last(value, ignorenulls=True).over(local)))
    so_far = W.partitionBy("_last").orderBy(PART).rowsBetween(W.unboundedPreceding, W.currentRow)
    links = (_link(seen, "_local")
             .withColumn("_held", F.last("_tail", ignorenulls=True).over(so_far))
             .withColumn("_prev", F.lag(F.struct("_last", "_held")).over(W.orderBy(PART)))
             .select(PART, "_first",
                     F.when(F.col("_prev._last") == F.col("_first"), F.col("_prev._held"))
                     .alias("_carry")))
    carry = F.when(F.col("_g") == F.col("_first"), F.col("_carry"))
    return (seen.join(F.broadcast(links), PART)
            .withColumn(name, F.coalesce("_local", carry))
            .drop(PART, POS, "_g", "_local", "_first", "_carry"))


def group_index(df: DataFrame, order: list[Column], group: list[str], name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row inside its ``group``; a group may span many tasks."""
    ranked = running_total(df, order, F.lit(1).cast("long"), name, group)
    return ranked.withColumn(name, F.col(name) - 1)
