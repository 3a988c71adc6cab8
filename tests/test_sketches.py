"""Sketches of parts against exact counts."""

from pyspark.sql import functions as F

from sievepoint.operators.sketches import keep_low_variety_of_parts, low_variety, merged_variety, sketch_columns
from sievepoint.operators.trim import keep_low_variety, variety


def wide(spark, low, high):
    """Columns of 1 to some thousand values, with NULLs in every third."""
    kinds = [1, 2, 19, 20, 21, 990, 1000, 1001, 1010, 5000]
    ids = spark.range(low, high)
    return ids.select(*(F.when((F.col("id") % 7 > 0) | (F.lit(i % 3) > 0), F.concat(F.lit("v"), F.col("id") % k)).alias(f"c{k}") for i, k in enumerate(kinds)), "id")


def test_kept_columns_are_those_of_exact_counts(spark):
    parts = [wide(spark, 0, 4000), wide(spark, 4000, 9000), wide(spark, 100, 200)]
    whole = parts[0].union(parts[1]).union(parts[2])
    texts = [c for c in whole.columns if c != "id"]
    sketches = sketch_columns(parts[0], texts, "a").union(sketch_columns(parts[1], texts, "b"))
    later = sketches.union(sketch_columns(parts[2], texts, "c"))  # new data: no part is read again
    exact = {r.feature: r.n_values for r in variety(whole, texts).collect()}
    asked = []

    def count(near):
        asked.append(near)
        return variety(whole, near)
    for bound in (2, 20, 21, 22, 1000, 1001, 1002, 6000):
        asked.clear()
        assert low_variety(later, bound, count) == sorted(c for c, n in exact.items() if n < bound), bound
        assert all(abs(exact[c] - bound) <= 0.1 * bound + 2 for near in asked for c in near)
    assert keep_low_variety_of_parts(parts, later, 1000).columns == keep_low_variety(whole, 1000).columns


def test_a_part_twice_counts_once(spark):
    part = wide(spark, 0, 4000)
    once = sketch_columns(part, ["c19", "c1000"], "a")
    assert merged_variety(once.union(once)).orderBy("feature").collect() == merged_variety(once).orderBy("feature").collect()
    assert merged_variety(sketch_columns(part.where("false"), ["c19"], "e")).first().estimate == 0
    assert sketch_columns(part, [], "n").count() == 0
