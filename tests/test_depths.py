"""A search over depths fits each tree once and scores it at every depth as if it were fitted for that depth."""

import json
from collections import Counter

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sievepoint.models import training as T


def made(spark, n=3000):
    """A label that no tree finds whole, so that every depth has a recall of its own."""
    rows = spark.range(n).withColumns({"a": F.pmod(F.xxhash64("id"), F.lit(50)), "b": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)),
                                       "e": F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10))})
    label = (((F.col("a") * F.col("b") % 17 < 8) & (F.col("a") > 12)) | (F.col("e") == 0)).cast("double")
    features = array_to_vector(F.array(*(F.col(c).cast("double") for c in "abe")))
    return rows.select(F.col("id").alias("app_id"), (F.col("id") % 3).cast("int").alias("fold"), label.alias("label"), features.alias("features"))


def test_depths_share_a_fit_and_keep_their_scores(spark, tmp_path, monkeypatch):
    rows = made(spark).cache()
    space = {"max_depth": [0, 1, 3, 6], "min_samples_leaf": [1, 40]}
    want = {r.params: (r.mean_test_score, r.std_test_score) for r in T.search(rows, "decision_tree", space)[2].collect()}
    assert len({m for m, _ in want.values()}) > 4
    fits, plain = Counter(), DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, data: (fits.update(n=1), plain(self, data))[1])
    left = []
    _, best, table = T.recoverable_search(rows, str(tmp_path / "s"), "decision_tree", space, parallelism=3, before=left.append)
    got = {r.params: (r.mean_test_score, r.std_test_score) for r in table.collect()}
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p], abs=1e-12) for p in want)
    assert got[json.dumps(best, sort_keys=True)][0] == max(m for m, _ in got.values())
    # two leaf sizes over three folds and the best point again, instead of eight points over three folds
    assert fits["n"] == 2 * 3 + 1 and left == [8, 4]


def test_folds_out_of_range_are_refused(spark, tmp_path):
    rows = made(spark, 30).withColumn("fold", F.when(F.col("app_id") == 7, None).otherwise(F.col("fold")))
    with pytest.raises(ValueError):
        T.recoverable_search(rows, str(tmp_path / "s"), "decision_tree", {"max_depth": [1]})
