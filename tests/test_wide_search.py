"""What the driver plans for a search does not grow with the number of columns times the number of steps."""

from pyspark.sql import functions as F

from sievepoint.operators import search as S


def _cells(df):
    """Columns of all nodes of the optimized plan."""
    total, todo = 0, [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        total += node.output().size()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_wide_rows_ride_through_the_steps_as_one(spark):
    entries = spark.range(5_000).select((F.col("id") * 10).alias("key"), F.concat(F.lit("="), F.col("id").cast("string")).alias("value"))
    for most in (1_000_000, 0):  # one array, then leaves that are shuffled
        index = S.build_index(entries, most)
        rows = spark.range(-5, 50_000, 997).select(F.col("id").alias("x"), *((F.col("id") + i).alias(f"c{i}") for i in range(59)),
                                                   F.lit(1).alias("keys"), F.when(F.col("id") > 9_000, "a").alias("values"))
        found = S.search(rows, F.col("x"), index, "found")
        assert found.columns == [*rows.columns, "found"]
        # 6 to 13 steps for an array or leaf: with the rows in each of them this would be over 800 or 1,300.
        assert _cells(found) < 700
        got = {r.x: (r.found, r.c58 - r.x, r["keys"], r["values"]) for r in found.collect()}
        assert got == {x: (f"={min(x // 10, 4_999)}" if x >= 0 else None, 58, 1, "a" if x > 9_000 else None) for x in range(-5, 50_000, 997)}
