"""Rows at given positions of an order, found by counting: no sort of all rows.

Every round draws some pivots from each group, counts the rows between them, and keeps the stretches that hold a wanted
position. These are the groups of the next round, each a small part of the last, until they are short enough to
be listed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from sievepoint.operators.lookup import lookup_join
from sievepoint.operators.search import build_index, search
from sievepoint.runtime import materialize

# Pivots that a group gets in a round, about, and rows of a stretch that is listed.
PIVOTS, LISTED = 256, 16_384


def select_positions(keys: DataFrame, wanted: DataFrame, pivots: int = PIVOTS, listed: int = LISTED) -> DataFrame:
    """(want, o) for each ``wanted`` (want, g, k): the value at the 0-based position k of group g in the order of ``o``.

    ``keys`` is (g, o); ``o`` can be compared, a struct as well, and equal values take as many positions as there are
    rows. Each round reads the keys a few times and writes what is left of them; with 256 pivots a round leaves some hundredth of
    a group for each position. A group may have any number of rows. Positions outside their group give no row.
    """
    found, keys = [], keys.select("g", "o")
    while True:
        sizes = keys.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        asked = materialize(wanted.join(sizes, "g").where("k >= 0 AND k < n"))
        more = asked.agg(F.count_if(F.col("n") <= listed).alias("short"), F.count_if(F.col("n") > listed).alias("long")).first()
        if more.short:
            groups = asked.where(F.col("n") <= listed).select("g", F.lit(True).alias("is_short")).distinct()
            lists = lookup_join(keys, groups, ["g"]).where("is_short").groupBy("g").agg(F.sort_array(F.collect_list("o")).alias("all"))
            found.append(materialize(asked.where(F.col("n") <= listed).join(lists, "g").select(
                "want", F.element_at("all", (F.col("k") + 1).cast("int")).alias("o"))))
        if not more.long:
            return reduce(DataFrame.unionByName, found) if found else asked.join(keys, "g").select("want", "o")
        asked = asked.where(F.col("n") > listed)
        long = lookup_join(keys, asked.select("g", "n").distinct(), ["g"]).where("n IS NOT NULL")
        drawn = long.where(F.rand() < pivots / F.col("n")).select(F.struct("g", "o").alias("key")).distinct()
        index = build_index(drawn.withColumn("value", F.col("key")))
        # Each row by the pivot at or under it, if its group has one: at the pivot itself, or in the stretch after it.
        placed = search(long.select("g", "o"), F.struct("g", "o"), index, "at")
        pivot = F.when(F.col("at.g") == F.col("g"), F.col("at.o"))
        placed = placed.select("g", "o", pivot.alias("p"), F.coalesce(F.col("o") == pivot, F.lit(False)).alias("is_pivot"))
        counts = materialize(placed.groupBy("g", "p", "is_pivot").agg(F.count(F.lit(1)).alias("c")))
        # A group's stretches are twice its pivots at most.
        order = W.partitionBy("g").orderBy(F.asc_nulls_first("p"), F.desc("is_pivot"))
        ended = counts.withColumn("end", F.sum("c").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
        hit = materialize(asked.select("want", "g", "k").join(ended, "g").where("k < end AND k >= end - c")
                          .withColumn("rank", F.col("k") - (F.col("end") - F.col("c"))))
        found.append(hit.where("is_pivot").select("want", F.col("p").alias("o")))
        inner = hit.where("NOT is_pivot")
        parts = materialize(inner.select("g", "p").distinct().withColumn("part", F.monotonically_increasing_id()).withColumn("cell", F.struct("g", "p")))
        if parts.isEmpty():
            return reduce(DataFrame.unionByName, found)
        cells = parts.select("cell", "part")
        left = lookup_join(placed.where("NOT is_pivot").withColumn("cell", F.struct("g", "p")), cells, ["cell"])
        keys = materialize(left.where("part IS NOT NULL").select(F.col("part").alias("g"), "o"))
        wanted = lookup_join(inner.withColumn("cell", F.struct("g", "p")), cells, ["cell"]).select(
            "want", F.col("part").alias("g"), F.col("rank").alias("k"))
