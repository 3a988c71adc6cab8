"""The entry with the greatest key at or under a number, found by halving a sorted array.

A short table is one array. A larger one is cut into leaves of few entries: the first keys of the leaves are the array that is
halved, and the leaf it gives is looked up and halved in turn. Numbers asked for are neither sorted nor made distinct, and no
bucket can hold many entries. The array is a constant of every step of the search, which the driver writes into each task's code
once a step, so its length has a bound of its own, whatever the table's size; only leaves grow with the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.operators.lookup import BROADCAST_ROWS, Sized, lookup_join
from sievepoint.operators.ordered import row_index
from sievepoint.runtime import PLAN_BYTES, materialize, measured_size

# Bounds of the array that is halved: its entries and their bytes.
TOP = 1 << 14
TOP_BYTES = 4 * 1024 * 1024
# Entries of a leaf, as long as the first keys of all leaves are few enough for the array.
LEAF = 64
# Entries in the leaves that are broadcast ahead of a shuffled lookup.
HOT_ENTRIES = 1 << 16


@dataclass(frozen=True)
class SortedIndex:
    """``top``: one row, (keys, values) of all entries, or with ``leaves`` (_leaf, keys, values) the leaves' first keys."""
    top: DataFrame
    n_top: int
    leaves: Sized | None = None
    leaf: int = 0

    @property
    def shuffled(self) -> bool:
        """Whether the leaves are too many for a broadcast, so that rows have to be counted and shuffled to look them up."""
        return self.leaves is not None and not self.leaves.small


def _packed(entries: DataFrame, *group: str) -> DataFrame:
    listed = F.sort_array(F.collect_list(F.struct("key", "value"))).alias("e")
    return entries.groupBy(*group).agg(listed).select(*group, F.col("e.key").alias("keys"), F.col("e.value").alias("values"))


def build_index(entries: DataFrame, max_rows: int = BROADCAST_ROWS) -> SortedIndex:
    """``entries``: (key, value), keys unique and without NULL."""
    entries = materialize(entries.select("key", "value"))
    n, size = measured_size(entries)
    if n <= min(max_rows, TOP) and size <= TOP_BYTES:
        return SortedIndex(materialize(_packed(entries)), n)
    leaf = max(LEAF, math.ceil(n / TOP), math.ceil(size / TOP_BYTES))
    numbered = row_index(entries, [F.col("key")]).withColumn("_leaf", F.expr(f"idx div {leaf}L"))
    leaves = materialize(_packed(numbered, "_leaf"))
    # One key for each leaf: as many as TOP at most.
    first = F.sort_array(F.collect_list(F.get("keys", F.lit(0)))).alias("keys")
    found = Sized(leaves, math.ceil(n / leaf) <= max_rows and size <= PLAN_BYTES, max(1, HOT_ENTRIES // leaf))
    return SortedIndex(materialize(leaves.agg(first)), math.ceil(n / leaf), found, leaf)


def _halved(df: DataFrame, keys: Column, n: int, name: str) -> DataFrame:
    """Add the position of the greatest of ``n`` sorted keys at or under ``_asked``; -1 if all are over it, or it is NULL.

    Each step is a projection of its own, which refers to the last position several times and so is not merged with it; all
    of them run in one generated loop, where reading an array element is an address.
    """
    df = df.withColumn(name, F.lit(-1))
    for bit in reversed(range(n.bit_length())):
        further = F.col(name) + (1 << bit)
        df = df.withColumn(name, F.when(F.get(keys, further) <= F.col("_asked"), further).otherwise(F.col(name)))
    return df


def _settled(df: DataFrame, columns: list[str], name: str, value: Column) -> DataFrame:
    """``columns`` and the value, behind a generator. A filter on the value would else be pushed through all steps of the search,
    and each step would be written into it several times."""
    return df.select(*columns, F.explode_outer(F.array(value)).alias(name))


def search(df: DataFrame, x: Column, index: SortedIndex, name: str) -> DataFrame:
    """Add the value of the entry with the greatest key at or under ``x``; NULL if there is none."""
    # The row rides along as one value: the driver plans each step for a few columns, however wide the rows are.
    columns = [c for c in df.columns if c != name]
    asked = _halved(df.select(F.struct(*columns).alias("_row"), x.alias("_asked")), index.top.select("keys").scalar(), index.n_top, "_at")
    if index.leaves is None:
        found = _settled(asked, ["_row"], name, F.when(F.col("_at") >= 0, F.get(index.top.select("values").scalar(), F.col("_at"))))
    else:
        found = _settled(asked, ["_row", "_asked"], "_leaf", F.col("_at").cast("long"))
        found = _halved(lookup_join(found, index.leaves, ["_leaf"]), F.col("keys"), index.leaf, "_in")
        found = _settled(found, ["_row"], name, F.when(F.col("_in") >= 0, F.get("values", F.col("_in"))))
    return found.select("_row.*", name)
