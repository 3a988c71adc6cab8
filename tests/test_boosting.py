"""Penalised boosting against an exhaustive search on a small table."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.pipeline import PipelineModel

from sievepoint.models import boosting as B
from sievepoint.models.classifiers import importance, make_classifier
from sievepoint.models.training import fit_score

RNG = np.random.default_rng(4)
X = np.column_stack([RNG.integers(0, 12, 600), RNG.integers(0, 5, 600), RNG.integers(0, 9, 600)]).astype(float)
Y = ((X[:, 0] > 6) ^ (X[:, 1] > 2)) | (RNG.random(600) < 0.1)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(int(i), float(y), Vectors.dense(x)) for i, (x, y) in enumerate(zip(X, Y))], ["id", "label", "features"])


def plain(trees, depth, rate, lam, alpha, least=1.0):
    """Margins by trying every value of every column at every node."""
    margin = np.zeros(len(Y))
    soft = lambda g: np.sign(g) * max(abs(g) - alpha, 0)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - Y, p * (1 - p)

        def grow(rows, level):
            best = (1e-9, None)
            for f in range(X.shape[1]) if level < depth else ():
                for v in np.unique(X[rows, f])[:-1]:
                    left = rows & (X[:, f] <= v)
                    right = rows & ~left
                    if min(h[left].sum(), h[right].sum()) < least:
                        continue
                    worth = lambda part: soft(g[part].sum()) ** 2 / (h[part].sum() + lam)
                    gain = (worth(left) + worth(right) - worth(rows)) / 2
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
            if best[1]:
                for part in best[1]:
                    grow(part, level + 1)
            else:
                margin[rows] += -rate * soft(g[rows].sum()) / (h[rows].sum() + lam)
        grow(np.ones(len(Y), bool), 0)
    return margin


@pytest.mark.parametrize("lam, alpha", [(1.0, 0.0), (30.0, 4.0)])
def test_margins(frame, lam, alpha):
    model = make_classifier("penalised_trees", {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.5, "reg_lambda": lam, "reg_alpha": alpha}).fit(frame.repartition(5))
    got = [r.margin for r in model.transform(frame).orderBy("id").collect()]
    assert np.allclose(got, plain(3, 2, 0.5, lam, alpha))


def test_written_margins_go_on(frame, monkeypatch):
    monkeypatch.setattr(B, "PENDING", 2)
    model = make_classifier("penalised_trees", {"n_estimators": 5, "max_depth": 1, "learning_rate": 0.5}).fit(frame)
    assert np.allclose([r.margin for r in model.transform(frame).orderBy("id").collect()], plain(5, 1, 0.5, 1.0, 0.0))


def test_column_samples():
    drawn = [B._sample(list(range(10)), 0.5, 42, t) for t in range(200)]
    assert {len(d) for d in drawn} == {5} and all(70 < sum(f in d for d in drawn) < 130 for f in range(10))
    levels = [B._sample(d, 0.7, 42, t, level) for t, d in enumerate(drawn) for level in range(3)]
    assert {len(x) for x in levels} == {4} and all(set(x) <= set(drawn[i // 3]) for i, x in enumerate(levels))


def test_only_drawn_columns_are_cut(frame):
    model = make_classifier("penalised_trees", {"n_estimators": 4, "max_depth": 2, "colsample_bytree": 0.3}).fit(frame)
    for t, tree in enumerate(model.listed()):
        assert {f for f, *_ in tree["cuts"].values()} <= set(B._sample([0, 1, 2], 0.3, 42, t))


def test_saved_model_and_importance(spark, frame, tmp_path):
    model, scored = fit_score(frame, frame, "penalised_trees", {"n_estimators": 2, "max_depth": 2})
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert again.listed() == model.listed() and scored.columns == ["id", "label", "features", "prob"]
    ranks = importance(spark, model, ["a", "b", "c"]).collect()
    assert {ranks[0].feature, ranks[1].feature} == {"a", "b"} and sum(r.score for r in ranks) == pytest.approx(1)


def test_little(frame):
    one = make_classifier("penalised_trees", {"n_estimators": 2}).fit(frame.where("id = 0"))
    assert one.listed()[0]["cuts"] == {} and len(one.transform(frame).select("margin").distinct().collect()) == 1
    none = make_classifier("penalised_trees", {"n_estimators": 2}).fit(frame.where("false"))
    assert none.listed() == [] and {r.margin for r in none.transform(frame).collect()} == {0.0}
