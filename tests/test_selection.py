"""Positions found by counting, against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from sievepoint.operators import splits as X
from sievepoint.operators.selection import select_positions


@pytest.mark.parametrize("pivots, listed", [(4, 3), (16, 50), (256, 4096)])
def test_positions(spark, rows, pivots, listed):
    pick = random.Random(pivots)
    groups = {"hot": [pick.choice([7, pick.randrange(500), 499]) for _ in range(1500)], "one": [5], "same": [3] * 700, "two": [9, None],
              "nulls": [None] * 40 + list(range(60))}
    data = [(g, v) for g, values in groups.items() for v in values]
    pick.shuffle(data)
    wanted, want = [], {}
    for g, values in groups.items():
        order = sorted(values, key=lambda v: (v is not None, v or 0))
        for k in {0, 1, len(values) // 3, len(values) // 2, len(values) - 1, len(values), -1, *(pick.randrange(len(values)) for _ in range(4))}:
            if 0 <= k < len(values):
                want[len(wanted)] = order[k]
            wanted.append((len(wanted), g, k))
    keys = rows(data, "g string, v long").select("g", F.struct(F.col("v").isNotNull().alias("known"), "v").alias("o"))
    got = select_positions(keys, rows(wanted, "want long, g string, k long"), pivots, listed).collect()
    assert len(got) == len(want) and {r.want: r.o.v for r in got} == want


def test_cuts_without_a_sort_of_all_rows(spark):
    """Folds, chunks and group cuts of more rows than are listed, with keys that repeat and keys that are NULL."""
    df = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"), (F.col("id") % 2).cast("string").alias("g"),
                                    F.timestamp_seconds(F.col("id") * 37 % 1000).alias("t"))
    folds = X.contiguous_folds(df, "k", 7)
    assert sorted(r["count"] for r in folds.groupBy("fold").count().collect()) == sorted(30_000 // 7 + (i < 30_000 % 7) for i in range(7))
    assert folds.where("k IS NULL").agg(F.max("fold")).first()[0] <= folds.where("k IS NOT NULL").agg(F.min("fold")).first()[0]
    edges = folds.groupBy("fold").agg(F.min(F.coalesce("k", F.lit(-1))).alias("a"), F.max(F.coalesce("k", F.lit(-1))).alias("b")).orderBy("fold").collect()
    assert all(x.b <= y.a for x, y in zip(edges, edges[1:]))
    split = X.split_chronological(df, "g", "t", "id", 0.8)
    assert {r["count"] for r in split.where("is_train").groupBy("g").count().collect()} == {12_000}
    ends = split.groupBy("g", "is_train").agg(F.min(F.struct("t", "id")).alias("a"), F.max(F.struct("t", "id")).alias("b")).collect()
    at = {(r.g, r.is_train): r for r in ends}
    assert all(at[g, True].b < at[g, False].a for g in "01")
    chunks = X.row_range_chunks(df, "id", 9).groupBy("chunk").count().collect()
    assert len(chunks) == 9 and sum(r["count"] for r in chunks) == 30_000
