"""What the lookups of one plan broadcast together has a bound of its own."""

from pyspark.sql import functions as F

from sievepoint.operators import fitted as T, search as S
from sievepoint.runtime import PLAN_BYTES


def test_columns_share_one_bound(spark):
    """Three columns, each under the bound alone: together they are not broadcast, and answers are the same."""
    names = ["a", "b", "c"]
    value = lambda c: F.concat(F.lit(c * 40), F.col("id").cast("string"))
    rows = spark.range(90_000).select("id", *(value(c).alias(c) for c in names))
    codes = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), (F.col("id") * 2).alias("code")) for c in names))).alias("s")).select("s.*")
    ready = T.prepare(codes, "code")
    assert set(ready.slices) == set(names)
    # 16 bytes a cell and the text
    assert sum(s.small for s in ready.slices.values()) * 90_000 * (32 + 41) <= PLAN_BYTES
    asked = rows.where("id % 9000 = 1").withColumn("b", F.when(F.col("id") > 80_000, F.lit("new")).otherwise(F.col("b")))
    asked = asked.withColumn("c", F.when(F.col("id") > 9_000, F.col("c")))
    got = sorted(tuple(r) for r in T.apply_codes(asked, ready, names).select("id", *names).collect())
    ids = range(1, 90_000, 9000)
    assert got == [(i, 2 * i, -1 if i > 80_000 else 2 * i, -1 if i < 9_001 else 2 * i) for i in ids]


def test_leaves_of_a_long_table_are_not_broadcast(spark):
    entries = spark.range(400_000).select((F.col("id") * 10).alias("key"), F.concat(F.lit("="), F.col("id").cast("string")).alias("value"))
    index = S.build_index(entries)
    assert not index.leaves.small
    asked = spark.range(-5, 4_000_000, 99_999).withColumnRenamed("id", "x")
    got = {r.x: r.found for r in S.search(asked, F.col("x"), index, "found").collect()}
    assert got == {x: f"={x // 10}" if x >= 0 else None for x in range(-5, 4_000_000, 99_999)}
