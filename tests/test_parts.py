"""Rows of a fit in parts of bounded length."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sievepoint.models import classifiers as C, training as T


class Held:
    """A classifier that only notes the rows of its fullest partition."""
    fullest = 0

    def __init__(self, **params):
        pass

    def fit(self, rows):
        found = rows.groupBy(F.spark_partition_id().alias("p")).count()
        Held.fullest = found.agg(F.max("count")).first()[0]
        return self

    def transform(self, rows):
        return rows.withColumn("probability", F.col("features"))


def test_no_part_of_a_fit_grows_with_its_rows(spark, monkeypatch):
    rows = spark.range(0, 2_000_000, 1, 2).select(
        F.col("id").alias("app_id"), (F.col("id") % 2).cast("double").alias("label"), array_to_vector(F.array(F.lit(0.0), F.lit(1.0))).alias("features"))
    monkeypatch.setitem(C.KINDS, "decision_tree", Held)
    T.fit_score(rows, rows, "decision_tree")
    assert 0 < Held.fullest <= 300_000


def test_parts_keep_rows_and_leave_short_ones_alone(spark):
    rows = spark.range(0, 1000, 1, 2)
    assert C.in_parts(rows) is rows
    dealt = C.in_parts(rows, 100)
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
    assert dealt.rdd.glom().map(len).max() <= 130
    lopsided = rows.union(spark.range(1000, 3000, 1, 1))
    assert C.in_parts(lopsided, 1500).rdd.glom().map(len).max() <= 1500
    assert C.in_parts(rows.where("id < 0"), 1).count() == 0
