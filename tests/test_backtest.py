"""A split of a backtest scores its rows in one pass, whether its train and test rows meet or not."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sievepoint.constants import SCORE_THRESHOLD
from sievepoint.models import training as T
from sievepoint.operators.metrics import evaluate


def test_one_pass_gives_both_scopes(spark, tmp_path, monkeypatch):
    rows = spark.range(600).withColumns({"a": F.pmod(F.xxhash64("id"), F.lit(50)), "b": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40))})
    rows = rows.select(F.col("id").alias("app_id"), (F.col("a") * F.col("b") % 17 < 8).cast("double").alias("label"),
                       F.when(F.col("id") != 5, F.col("id")).alias("t"), array_to_vector(F.array(*(F.col(c).cast("double") for c in "ab"))).alias("features"))
    t = F.col("t")
    splits = {"apart": (t < 300, t >= 400), "meeting": (t < 400, t >= 200), "twice": (t < 500, t < 500)}
    want = {}
    for tag, (known, held) in splits.items():
        model = T.fit(rows.where(known), "decision_tree", {"max_depth": 3})
        for scope, part in (("train", known), ("test", held)):
            r = evaluate(T.with_probability(model.transform(rows.where(part))), "label", "prob", SCORE_THRESHOLD).first()
            want[tag, scope] = tuple(round(x, 9) for x in (r.auc, r.accuracy, r.precision, r.recall))
    passes, plain = [], T.with_probability
    monkeypatch.setattr(T, "with_probability", lambda *a: (passes.append(1), plain(*a))[1])
    history = T.backtest(rows, [T.Split(tag, *parts) for tag, parts in splits.items()], "decision_tree", ["a", "b"], str(tmp_path / "b"), {"max_depth": 3})
    got = {(r.tag, r.scope): tuple(round(x, 9) for x in (r.AUC, r.Accuracy, r.Precision, r.Recall)) for r in history.collect()}
    assert got == want and len(passes) == len(splits)
