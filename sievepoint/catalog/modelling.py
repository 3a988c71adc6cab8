"""Training, search, curves, backtests and stream scoring.

Fitted trees have no SQL twin, so their labels are planted on one feature: what a right fit must answer is plain SQL.
"""

from __future__ import annotations

import json
import random
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from sievepoint.catalog.quality import AS_OF
from sievepoint.catalog.registry import (APPLICATION_COLUMNS, applications, area_codes, ip_ranges, query, table)
from sievepoint.catalog.screening import RULE_SQL
from sievepoint.models import classifiers as C, training as T
from sievepoint.operators import splits as X
from sievepoint.operators.rules import RuleOptions, decide
from sievepoint.plans import scoring as P, state as S
from sievepoint.plans.batch import BatchOptions, Noise, run_batch
from sievepoint.plans.features import FeatureOptions
from sievepoint.runtime import materialize, spread, state_dir
from sievepoint.streaming.scoring import json_lines, read_scored, score_stream

OPTIONS = FeatureOptions(as_of=AS_OF)
DECLARED_TEXT = {c for c, e in APPLICATION_COLUMNS.items() if "CASE" in e or "concat" in e}

# A label that is a range of one whole-number feature of 20 values. Any tree that weighs all features and splits
# exactly must find its bounds, whatever rows it sees, so scores, quality and ranks can be said in SQL.
FEATURES = ["step", "user_no", "value"]
ALL_FEATURES = {"max_features": "all"}


def _folder(spark):
    return f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"


def planted(spark, sf, low=12, high=20):
    """Assembled events whose label is ``low <= step < high``."""
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("app_id"), F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("C"), F.col("user_id") % 11).alias("college_id"),
        (F.col("event_id") * 7 % 20).alias("step"), (F.col("user_id") % 13).alias("user_no"), "value")
    rows = rows.withColumn("y", F.col("step").between(low, high - 1))
    return materialize(C.assemble(spread(rows, "app_id"), FEATURES, ("app_id", "college_id", "ts"), "y"))


def _planted_sql(low=12, high=20):
    return f"""p AS (SELECT event_id AS app_id, ts, concat('C', CAST(user_id % 11 AS STRING)) AS college_id,
  event_id * 7 % 20 >= {low} AND event_id * 7 % 20 < {high} AS y FROM events)"""


_MD5 = "md5(concat('42:', CAST(app_id AS STRING)))"


def _folded_sql(k, order=_MD5):
    return f"""f AS (SELECT *, CASE WHEN rn < (n % {k}) * (n // {k} + 1) THEN rn // (n // {k} + 1) ELSE (rn - n % {k}) // (n // {k}) END AS fold
  FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS rn, count(*) OVER () AS n FROM p))"""


_PLANTED_TEST = f"""t AS (SELECT y FROM (SELECT y, row_number() OVER (ORDER BY {_MD5}) AS rn, count(*) OVER () AS n FROM p)
  WHERE rn <= ceil(0.2::DOUBLE * n))"""
_ALL_RIGHT = """1.0::DOUBLE AS auc, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS "precision", 1.0::DOUBLE AS accuracy,
  count(*) FILTER (y) AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, count(*) FILTER (NOT y) AS tn"""


@query("boosted_tree_training", f"WITH {_planted_sql()}, {_PLANTED_TEST} SELECT {_ALL_RIGHT} FROM t")
def boosted_tree_training(spark, sf):
    rows = X.split_random(planted(spark, sf), "app_id", 0.2)
    return T.train(rows, "boosted_trees", {"n_estimators": 10, "max_depth": 3})[2]


# One cut parts the classes, so each side's margin goes its own way: its next step follows from the margin and its rows.
_PENALTIES = {"light": {"reg_lambda": 1, "reg_alpha": 0}, "heavy": {"reg_lambda": 200, "reg_alpha": 20}}


def _margins_sql(trees, rate):
    parts = []
    for name, p in _PENALTIES.items():
        parts.append(f"""{name}(y, n, t, m) AS (
  SELECT y, count(*)::DOUBLE, 0, 0.0::DOUBLE FROM p GROUP BY y
  UNION ALL SELECT y, n, t + 1, m + {rate} * (CASE WHEN y THEN 1 ELSE -1 END) * greatest(n * abs(y::INT - 1 / (1 + exp(-m))) - {p["reg_alpha"]}, 0)
    / (n * (1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m))) + {p["reg_lambda"]}) FROM {name} WHERE t < {trees})""")
    return ", ".join(parts)


@query("penalised_boosting", f"""
WITH RECURSIVE {_planted_sql()}, {_margins_sql(6, 0.3)}
SELECT app_id, p.y, round(1 / (1 + exp(-light.m)), 9) AS light, round(1 / (1 + exp(-heavy.m)), 9) AS heavy, abs(heavy.m) < abs(light.m) AS shrunk
FROM p JOIN light ON light.y = p.y AND light.t = 6 JOIN heavy ON heavy.y = p.y AND heavy.t = 6""")
def penalised_boosting(spark, sf):
    """Two trainings that differ in their leaf penalties: every row's probability by both."""
    rows = planted(spark, sf)
    scored = rows.withColumn("y", F.col("label") == 1)
    for name, penalty in _PENALTIES.items():
        model = C.fit(rows, "penalised_trees", {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, **penalty})
        scored = model.transform(scored).withColumnRenamed("margin", f"m_{name}").drop("probability")
    prob = lambda name: F.round(1 / (1 + F.exp(-F.col(f"m_{name}"))), 9).alias(name)
    return scored.select("app_id", "y", prob("light"), prob("heavy"), (F.abs("m_heavy") < F.abs("m_light")).alias("shrunk"))


@query("out_of_fold_scores", f"""
WITH {_planted_sql()}, {_folded_sql(3)} SELECT app_id, CAST(fold AS INT) AS fold, CAST(y AS DOUBLE) AS label, CAST(y AS INT) AS predicted FROM f""")
def out_of_fold_scores(spark, sf):
    rows = materialize(X.kfold(planted(spark, sf), "app_id", 3))
    scored = T.out_of_fold(rows, "boosted_trees", {"n_estimators": 5, "max_depth": 5}, folds=3)
    return scored.select("app_id", "fold", "label", decide(F.col("prob"), 0.5).alias("predicted"))


@query("classifier_kinds", f"""
WITH {_planted_sql()}, {_PLANTED_TEST}
SELECT kind, {_ALL_RIGHT} FROM t, (SELECT unnest(['random_forest', 'gradient_boosting', 'decision_tree']) AS kind) GROUP BY kind""")
def classifier_kinds(spark, sf):
    """One holdout quality row per tree kind, trained and evaluated in one run."""
    rows = materialize(X.split_random(planted(spark, sf), "app_id", 0.2))
    kinds = {"random_forest": {"n_estimators": 20, **ALL_FEATURES}, "gradient_boosting": {"n_estimators": 5}, "decision_tree": {}}
    return T.train_kinds(rows, kinds)[1].drop("split", "params")


def bayes_sql(rows: str) -> str:
    """Gaussian Bayes in SQL: ``rows`` defines r(id, split, is_train, a, b, y); adds scored(id, split, y, prob)."""
    return f"""
WITH {rows},
e AS (SELECT split, 1e-9 * greatest(var_pop(a), var_pop(b)) AS eps FROM r WHERE is_train GROUP BY split),
g AS (SELECT split, y, ln(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split)) AS prior, avg(a) AS ma,
             var_pop(a) + max(eps) AS va, avg(b) AS mb, var_pop(b) + max(eps) AS vb
      FROM r JOIN e USING (split) WHERE is_train GROUP BY split, y),
l AS (SELECT id, r.split, r.y, g.y AS k, prior - 0.5 * (ln(2 * pi() * va) + ln(2 * pi() * vb))
             - (a - ma) * (a - ma) / (2 * va) - (b - mb) * (b - mb) / (2 * vb) AS s
      FROM r JOIN g ON r.split = g.split WHERE NOT is_train),
scored AS (SELECT id, split, any_value(y) AS y, 1 / (1 + exp(max(s) FILTER (k = 0) - max(s) FILTER (k = 1))) AS prob
           FROM l GROUP BY id, split)
"""


_BAYES = "b0 AS (SELECT event_id AS id, user_id AS a, value AS b, CAST(value + event_id % 40 > 70 AS INT) AS y FROM events)"
_HASHED = "md5(concat('42:', CAST(id AS STRING)))"


def bayes_rows(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("app_id"), "user_id", "value", (F.col("value") + F.col("event_id") % 40 > 70).alias("y"))
    return materialize(C.assemble(spread(rows, "app_id"), ["user_id", "value"], ("app_id",), "y"))


@query("gaussian_bayes_scores", bayes_sql(f"""{_BAYES},
q AS (SELECT id, a, b, y, unnest([true, false]) AS is_train FROM b0), r AS (SELECT *, 0 AS split FROM q)""") + """
SELECT id AS app_id, round(prob, 6) AS prob FROM scored""")
def gaussian_bayes_scores(spark, sf):
    rows = bayes_rows(spark, sf)
    return T.fit_score(rows, rows, "gaussian_nb")[1].select("app_id", F.round("prob", 6).alias("prob"))


_FOLDED = """f AS (SELECT *, CASE WHEN rn < (n % {k}) * (n // {k} + 1) THEN rn // (n // {k} + 1) ELSE (rn - n % {k}) // (n // {k}) END AS fold
  FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS rn, count(*) OVER () AS n FROM b0)),
r AS (SELECT id, a, b, y, t.i AS split, fold <> t.i AS is_train FROM f, range({k}) t(i))"""


@query("out_of_fold_bayes_scores", bayes_sql(f"{_BAYES}, {_FOLDED.format(k=3, order=_HASHED)}") + """
SELECT id AS app_id, CAST(split AS INT) AS fold, round(prob, 6) AS prob FROM scored""")
def out_of_fold_bayes_scores(spark, sf):
    rows = materialize(X.kfold(bayes_rows(spark, sf), "app_id", 3))
    return T.out_of_fold(rows, "gaussian_nb", folds=3).select("app_id", "fold", F.round("prob", 6).alias("prob"))


@query("unshuffled_fold_bayes_classes", bayes_sql(f"{_BAYES}, {_FOLDED.format(k=5, order='id')}") + """
SELECT id AS app_id, CAST(split AS INT) AS fold, CAST(prob >= 0.5 AS INT) AS predicted FROM scored""")
def unshuffled_fold_bayes_classes(spark, sf):
    return T.cross_predict(bayes_rows(spark, sf), "gaussian_nb", k=5).select("app_id", "fold", "predicted")


_QUALITY = """count(*) FILTER (y = 1 AND p) AS tp, count(*) FILTER (y = 0 AND p) AS fp,
  count(*) FILTER (y = 1 AND NOT p) AS fn, count(*) FILTER (y = 0 AND NOT p) AS tn"""


@query("progressive_bayes_quality", bayes_sql(f"""{_BAYES},
c AS (SELECT *, (SELECT max(i) FROM range(4) t(i) WHERE i * (n + 1) // 4 <= rn) AS chunk
      FROM (SELECT *, row_number() OVER (ORDER BY id) - 1 AS rn, count(*) OVER () AS n FROM b0)),
r AS (SELECT id, a, b, y, t.i AS split, chunk = t.i AS is_train FROM c, range(3) t(i) WHERE chunk IN (t.i, 3))""") + f"""
SELECT CAST(split AS INT) AS chunk, tp, fp, fn, tn, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy
FROM (SELECT split, {_QUALITY} FROM (SELECT split, y, prob > 0.5 AS p FROM scored) GROUP BY split)""")
def progressive_bayes_quality(spark, sf):
    return T.progressive(bayes_rows(spark, sf), "gaussian_nb", 4)


_HELD_OUT = f"""{_BAYES}, r AS (SELECT id, a, b, y, 0 AS split, rn > ceil(0.2::DOUBLE * n) AS is_train
  FROM (SELECT *, row_number() OVER (ORDER BY {_HASHED}) AS rn, count(*) OVER () AS n FROM b0))"""


@query("holdout_bayes_evaluation", bayes_sql(_HELD_OUT) + f""",
o AS (SELECT prob, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY prob),
u AS (SELECT pos, neg, sum(neg) OVER (ORDER BY prob) - neg / 2.0::DOUBLE AS below FROM o)
SELECT round((SELECT sum(pos * below) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) FROM u), 6) AS auc, tp::DOUBLE / (tp + fn) AS recall,
       tp::DOUBLE / (tp + fp) AS "precision", (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, tp, fp, fn, tn
FROM (SELECT {_QUALITY} FROM (SELECT y, prob > 0.3 AS p FROM scored))""")
def holdout_bayes_evaluation(spark, sf):
    """Train with a random holdout and evaluate it at the scoring threshold."""
    rows = X.split_random(bayes_rows(spark, sf), "app_id", 0.2)
    return T.train(rows, "gaussian_nb")[2].withColumn("auc", F.round("auc", 6))


@query("repeated_holdout_bayes_quality", bayes_sql(_HELD_OUT) + f"""
SELECT CAST(tp AS DOUBLE) AS mean_tp, CAST(fp AS DOUBLE) AS mean_fp, CAST(fn AS DOUBLE) AS mean_fn, CAST(tn AS DOUBLE) AS mean_tn,
       round(2 * tp::DOUBLE / (2 * tp + fp + fn), 9) AS mean_f_beta
FROM (SELECT {_QUALITY} FROM (SELECT y, prob >= 0.5 AS p FROM scored))""")
def repeated_holdout_bayes_quality(spark, sf):
    out = T.repeated_holdout(bayes_rows(spark, sf), "gaussian_nb", repeats=2)
    return out.select("mean_tp", "mean_fp", "mean_fn", "mean_tn", F.round("mean_f_beta", 9).alias("mean_f_beta"))


@query("backtest_bayes_history", bayes_sql(f"""{_BAYES},
r AS (SELECT id, a, b, y, d AS split, id < d * (SELECT count(*) FROM b0) / 10 AS is_train FROM b0, (SELECT unnest([3, 6]) AS d))""") + f"""
SELECT concat('until_', CAST(split AS STRING)) AS tag, tp::DOUBLE / (tp + fn) AS "Recall", (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS "Accuracy"
FROM (SELECT split, {_QUALITY} FROM (SELECT split, y, prob > 0.3 AS p FROM scored) GROUP BY split)""")
def backtest_bayes_history(spark, sf):
    rows = bayes_rows(spark, sf)
    n = rows.count()
    splits = [T.Split(f"until_{d}", F.col("app_id") < d * n / 10, F.col("app_id") >= d * n / 10) for d in (3, 6)]
    history = T.backtest(rows, splits, "gaussian_nb", ["user_id", "value"], _folder(spark))
    return history.filter("scope = 'test'").select("tag", "Recall", "Accuracy")


_BAND = (8, 12)  # one split leaves the majority outside, two find the band


def _search_sql(points):
    """Rank, parameters and recall of given points: a single split finds no positive row, deeper trees all of them."""
    scored = sorted(((json.dumps(p, sort_keys=True), float(p["max_depth"] > 1)) for p in points), key=lambda x: -x[1])
    rows = ", ".join(f"({i}, '{p}', {s}::DOUBLE, 0.0::DOUBLE)" for i, (p, s) in enumerate(scored, 1))
    return f"""SELECT CAST(r AS INT) AS rank_test_score, p AS params, m AS mean_test_score, d AS std_test_score
FROM (VALUES {rows}) v(r, p, m, d) WHERE (SELECT count(*) FROM events) > 0"""


_GRID = {"max_depth": [1, 2, 3], "min_samples_leaf": [1, 5], "reg_alpha": [1, 3], "max_features": ["all"]}
_POINTS = T.parameter_grid(C.effective("random_forest", _GRID))


@query("parameter_grid_search", _search_sql(_POINTS))
def parameter_grid_search(spark, sf):
    """Recall over folds for each distinct grid point; the ignored penalty makes no point of its own."""
    rows = materialize(X.kfold(planted(spark, sf, *_BAND), "app_id", 2))
    return T.search(rows, "random_forest", {**_GRID, "n_estimators": [3]}, folds=2)[2].withColumn(
        "params", F.regexp_replace("params", '"n_estimators": 3, |, "n_estimators": 3', ""))


_WIDE = {"max_depth": [1, 2, 3, 4, 5], "min_samples_leaf": [1, 2, 5], "maxBins": [32, 48, 64, 96], "minInfoGain": [0.0, 1e-9]}
_WIDE_POINTS = T.parameter_grid(_WIDE)


@query("recoverable_parameter_search", _search_sql(_WIDE_POINTS))
def recoverable_parameter_search(spark, sf):
    """All 120 points of a grid, stopped after some and run again: the ranks of the whole."""
    rows, path, parts = materialize(X.kfold(planted(spark, sf, *_BAND), "app_id", 2)), _folder(spark), []

    def stop(left):
        parts.append(left)
        if len(parts) == 5:
            raise InterruptedError(left)

    def run(before):
        return T.recoverable_search(rows, path, "decision_tree", _WIDE, folds=2, before=before)[2]
    try:
        run(stop)
    except InterruptedError:
        return run(lambda left: parts.append(left))


@query("best_point_report", f"""
WITH {_planted_sql(*_BAND)} SELECT CAST(c AS INT) AS class, 1.0::DOUBLE AS "precision", 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1,
  count(*) FILTER (y = (c = 1)) AS support FROM p, range(2) r(c) GROUP BY c""")
def best_point_report(spark, sf):
    """The classification report of the point that a search chose, over the held-out folds."""
    rows = materialize(X.kfold(planted(spark, sf, *_BAND), "app_id", 2))
    best = T.search(rows, "decision_tree", {"max_depth": [1, 3], "minInfoGain": [0.0]}, folds=2)[1]
    return T.classification_report(T.out_of_fold(rows, "decision_tree", best, folds=2))


@query("random_parameter_search", _search_sql(random.Random(42).sample(_POINTS, 4)))
def random_parameter_search(spark, sf):
    rows = materialize(X.kfold(planted(spark, sf, *_BAND), "app_id", 2))
    return T.search(rows, "random_forest", {**_GRID, "n_estimators": [3]}, folds=2, n_iter=4)[2].withColumn(
        "params", F.regexp_replace("params", '"n_estimators": 3, |, "n_estimators": 3', ""))


@query("blended_predictions", f"""
WITH {_planted_sql()} SELECT app_id, CAST(y OR app_id % 10 = 0 AS DOUBLE) AS pred_fraud_prob, CAST(y OR app_id % 10 = 0 AS INT) AS pred_fraud FROM p""")
def blended_predictions(spark, sf):
    rows = planted(spark, sf)
    model = C.fit(rows, "decision_tree")
    return C.predict(rows.withColumn("y_rule", (F.col("app_id") % 10 == 0).cast("int")), model)


@query("feature_importances", """
SELECT CAST(r AS INT) AS rank, f AS feature, s AS score FROM (VALUES (0, 'step', 1.0::DOUBLE), (1, 'user_no', 0.0::DOUBLE), (2, 'value', 0.0::DOUBLE)) v(r, f, s)
WHERE (SELECT count(*) FROM events) > 0""")
def feature_importances(spark, sf):
    """All features of a forest, strongest first; the label depends on one."""
    model = C.fit(planted(spark, sf), "random_forest", {"n_estimators": 10, **ALL_FEATURES})
    return C.importance(spark, model, FEATURES)


@query("coefficient_importances", """
SELECT CAST(0 AS INT) AS rank, 'step' AS feature WHERE (SELECT count(*) FROM events) > 0""")
def coefficient_importances(spark, sf):
    """The strongest coefficient on standardised features."""
    model = C.fit(planted(spark, sf), "logistic", {"maxIter": 25})
    return C.importance(spark, model, FEATURES, 1).select("rank", "feature")


_CURVE_U = lambda r: f"(('0x' || substr(md5('{r}:curve:' || app_id), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496"


@query("learning_curve_scores", f"""
WITH p AS (SELECT event_id AS app_id FROM events),
h AS (SELECT app_id, row_number() OVER (ORDER BY md5(concat('4:', CAST(app_id AS STRING)))) > ceil(0.2::DOUBLE * count(*) OVER ()) AS known FROM p)
SELECT x, count(*) FILTER (known AND {_CURVE_U(4)} < x) AS n_train, 1.0::DOUBLE AS train_mean, 0.0::DOUBLE AS train_std,
       1.0::DOUBLE AS test_mean, 0.0::DOUBLE AS test_std
FROM h, (SELECT unnest([0.1, 0.325, 0.55, 0.775, 1.0]::DOUBLE[]) AS x) GROUP BY x""")
def learning_curve_scores(spark, sf):
    """Five training shares by five shuffle splits; the planted bound is found from any of them."""
    return T.learning_curve(planted(spark, sf), "decision_tree", {"max_depth": 2})


@query("validation_curve_scores", f"""
WITH {_planted_sql(*_BAND)}, {_folded_sql(3)},
a AS (SELECT i, avg(CASE WHEN y THEN 0.0::DOUBLE ELSE 1.0 END) FILTER (fold <> i) AS known, avg(CASE WHEN y THEN 0.0::DOUBLE ELSE 1.0 END) FILTER (fold = i) AS held,
             count(*) FILTER (fold <> i) AS n FROM f, range(3) t(i) GROUP BY i)
SELECT 1.0::DOUBLE AS x, max(n) FILTER (i = 2) AS n_train, round(avg(known), 9) AS train_mean, round(stddev_pop(known), 9) AS train_std,
       round(avg(held), 9) AS test_mean, round(stddev_pop(held), 9) AS test_std FROM a
UNION ALL SELECT 3.0::DOUBLE, max(n) FILTER (i = 2), 1.0, 0.0, 1.0, 0.0 FROM a""")
def validation_curve_scores(spark, sf):
    """One split cannot show the band, three levels can."""
    rows = materialize(X.kfold(planted(spark, sf, *_BAND), "app_id", 3))
    curve = T.validation_curve(rows, "decision_tree", "max_depth", [1, 3], folds=3)
    return curve.select("x", "n_train", *(F.round(c, 9).alias(c) for c in ("train_mean", "train_std", "test_mean", "test_std")))


@query("unshuffled_fold_predictions", f"""
WITH {_planted_sql()}, {_folded_sql(5, "app_id")}
SELECT app_id, CAST(fold AS INT) AS fold, CAST(y AS DOUBLE) AS prob, CAST(y AS INT) AS predicted FROM f""")
def unshuffled_fold_predictions(spark, sf):
    return T.cross_predict(planted(spark, sf), "decision_tree", k=5).select("app_id", "fold", "prob", "predicted")


@query("repeated_holdout_quality", f"""
WITH {_planted_sql()}, {_PLANTED_TEST}
SELECT count(*) FILTER (y)::DOUBLE AS mean_tp, 0.0::DOUBLE AS mean_fp, 0.0::DOUBLE AS mean_fn, count(*) FILTER (NOT y)::DOUBLE AS mean_tn,
       1.0::DOUBLE AS mean_f_beta FROM t""")
def repeated_holdout_quality(spark, sf):
    out = T.repeated_holdout(planted(spark, sf), "random_forest", {"n_estimators": 5, **ALL_FEATURES}, repeats=3)
    return out.select("mean_tp", "mean_fp", "mean_fn", "mean_tn", "mean_f_beta")


@query("progressive_chunk_quality", f"""
WITH {_planted_sql()},
c AS (SELECT y, (SELECT max(i) FROM range(4) t(i) WHERE i * (n + 1) // 4 <= rn) AS chunk
      FROM (SELECT *, row_number() OVER (ORDER BY app_id) - 1 AS rn, count(*) OVER () AS n FROM p))
SELECT CAST(i AS INT) AS chunk, count(*) FILTER (y) AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, count(*) FILTER (NOT y) AS tn, 1.0::DOUBLE AS accuracy
FROM c, range(3) t(i) WHERE chunk = 3 GROUP BY i""")
def progressive_chunk_quality(spark, sf):
    return T.progressive(planted(spark, sf), "decision_tree", 4, {"max_depth": 3})


_NOISES = [(level, share) for level in (0.25, 0.5, 1.0) for share in (0.3, 0.6)]


@query("time_and_college_backtest", """
WITH runs AS (
  SELECT concat('until_', CAST(d AS STRING)) AS tag FROM range(1, 35) t(d)
  UNION ALL SELECT concat('noise_', n) FROM (SELECT unnest(['0.25_0.3', '0.25_0.6', '0.5_0.3', '0.5_0.6', '1.0_0.3', '1.0_0.6']) AS n)
  UNION ALL SELECT 'college_80')
SELECT tag, scope, 'decision_tree' AS model, 1.0::DOUBLE AS "AUC", 1.0::DOUBLE AS "Accuracy", 1.0::DOUBLE AS "Precision", 1.0::DOUBLE AS "Recall",
       CASE WHEN scope = 'train' THEN 'step' END AS feature0
FROM runs, (SELECT unnest(['train', 'test']) AS scope) WHERE (SELECT count(*) FROM events) > 0""")
def time_and_college_backtest(spark, sf):
    """History rows, train and test: 34 time splits, 6 with noise on a feature that says nothing, one inside colleges.

    It stops after ten splits and goes on.
    """
    rows = X.split_chronological(planted(spark, sf), "college_id", "ts", "app_id", 0.8)
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    t, early = F.unix_micros("ts"), F.col("is_train")
    splits = [T.Split(f"until_{d}", t < first + (last - first) * d // 35, t >= first + (last - first) * d // 35) for d in range(1, 35)]
    splits += [T.Split(f"noise_{level}_{share}", early, ~early, T.noisy_vector(FEATURES, ["user_no"], "app_id", level, share, 7)) for level, share in _NOISES]
    splits.append(T.Split("college_80", early, ~early))
    path, seen = _folder(spark), []

    def run(stop=None):
        def before(tag):
            seen.append(tag)
            if len(seen) == stop:
                raise InterruptedError(tag)
        return T.backtest(rows, splits, "decision_tree", FEATURES, path, {"max_depth": 3}, before=before)
    try:
        run(11)
    except InterruptedError:
        history = run()
    return history.select("tag", "scope", "model", "AUC", "Accuracy", "Precision", "Recall", "feature0")


def _lookups(spark, sf):
    return {"area_codes": area_codes(spark, sf), "ip_ranges": ip_ranges(spark, sf)}


# The label of the end-to-end queries is a bound of one feature that goes through the step as it is; the rules
# stay out of the labels and come in again at the blend.
END_TO_END = replace(OPTIONS, rules=RuleOptions(override_tagging=False))
_MARKED = "coalesce(college_count >= 3, false)"


def marked(spark, sf):
    return applications(spark, sf).withColumn("confirmed_fraud", F.expr(_MARKED))


def fitted(spark, sf, path, version=1, turned=False, lookups=None):
    """Fit the tables and a tree on all applications and publish them under ``path``. Lookups that were made ready may be given."""
    known = marked(spark, sf).drop("fraud_status")
    known = known.withColumn("confirmed_fraud", ~F.col("confirmed_fraud")) if turned else known
    assembled, state, features = P.prepare_training(
        known, END_TO_END, lookups or _lookups(spark, sf), DECLARED_TEXT)
    rows = materialize(assembled)
    model = C.fit(rows, "decision_tree", {"max_depth": 4, "maxBins": 64})
    S.publish(spark, path, version, state, features, model)
    return S.load(spark, path)


_BLENDED_SQL = f"""
WITH s AS (SELECT app_id, {_MARKED} AS y, {_MARKED} OR ({RULE_SQL}) AS hit FROM applications)
"""


@query("scored_applications", _BLENDED_SQL + """
SELECT app_id, CAST(hit AS DOUBLE) AS pred_fraud_prob, CAST(hit AS INT) AS pred_fraud FROM s""")
def scored_applications(spark, sf):
    """Train on applications, publish the state, and score all of them, with a column the fit never saw."""
    lookups = S.ready_lookups(_lookups(spark, sf))
    state = fitted(spark, sf, f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}", lookups=lookups)
    return P.score(marked(spark, sf), END_TO_END, *S.ready(state, lookups), DECLARED_TEXT)


@query("replayed_evaluation", _BLENDED_SQL + """,
c AS (SELECT count(*) FILTER (y AND hit) AS tp, count(*) FILTER (NOT y AND hit) AS fp, count(*) FILTER (y AND NOT hit) AS fn,
             count(*) FILTER (NOT y AND NOT hit) AS tn FROM s)
SELECT round(1 - fp / 2.0::DOUBLE / (fp + tn), 9) AS auc, 1.0::DOUBLE AS recall, tp::DOUBLE / (tp + fp) AS "precision",
       (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, tp, fp, fn, tn FROM c""")
def replayed_evaluation(spark, sf):
    lookups = S.ready_lookups(_lookups(spark, sf))
    state = fitted(spark, sf, f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}", lookups=lookups)
    out = P.replay(marked(spark, sf), END_TO_END, *S.ready(state, lookups), DECLARED_TEXT)
    return out.withColumn("auc", F.round("auc", 9))


def _stream(spark, folder):
    """Applications of event files that arrive in ``folder``, one file to a batch."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    from sievepoint.catalog.registry import _SPARK_TIMES
    schema = spark.read.parquet(folder).schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rows = events.selectExpr(*(f"{e} AS {c}" for c, e in {**APPLICATION_COLUMNS, **_SPARK_TIMES}.items()))
    return rows.withColumn("confirmed_fraud", F.expr(_MARKED))


# Shifting ids by this keeps every remainder that the application columns and the rules use.
_SHIFT = 29_100_000


def run_stream(spark, sf, bypass=False, files=2, refresh=False):
    """Score the events as a stream of several files; with ``refresh`` a state fitted on turned labels comes on the way."""
    base = f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"
    events = table(spark, sf, "events")
    events.repartition(files, "event_id").write.parquet(f"{base}/in")
    # The fits and the streams share the lookups.
    lookups = None if bypass else S.ready_lookups(_lookups(spark, sf))
    if not bypass:
        fitted(spark, sf, f"{base}/state", lookups=lookups)

    def drain():
        score_stream(_stream(spark, f"{base}/in"), f"{base}/state", f"{base}/out", f"{base}/progress", END_TO_END,
                     lookups, DECLARED_TEXT, bypass=bypass, trigger={"availableNow": True}).awaitTermination()
    drain()
    if refresh:
        fitted(spark, sf, f"{base}/state", 2, turned=True, lookups=lookups)
        events.withColumn("event_id", F.col("event_id") + _SHIFT).write.mode("append").parquet(f"{base}/in")
        drain()
    return read_scored(spark, f"{base}/out").drop("version")


@query("stream_scored_applications", _BLENDED_SQL + """
SELECT app_id, CAST(hit AS DOUBLE) AS pred_fraud_prob, CAST(hit AS INT) AS pred_fraud FROM s""")
def stream_scored_applications(spark, sf):
    return run_stream(spark, sf)


@query("stream_refreshes_state", _BLENDED_SQL.replace("AS hit", f"AS hit, NOT {_MARKED} OR ({RULE_SQL}) AS turned") + f"""
SELECT app_id, CAST(hit AS INT) AS pred_fraud FROM s UNION ALL SELECT app_id + {_SHIFT}, CAST(turned AS INT) FROM s""")
def stream_refreshes_state(spark, sf):
    """Files that arrive after a second version was published are scored by it."""
    return run_stream(spark, sf, files=1, refresh=True).select("app_id", "pred_fraud")


_KINDS = {c: {"app_id": "int", "fraud_score": "float", "fraud_status": "int", "college_count": "int", "hispanic": "str"}.get(
    c, "bool" if c in ("confirmed_fraud", "integrity_fg_01") else "str") for c in APPLICATION_COLUMNS} | {
    "tstmp_submit": "datetime", "tstmp_create": "datetime"}


@query("running_json_stream", _BLENDED_SQL.replace("AS hit", f"AS hit, NOT {_MARKED} OR ({RULE_SQL}) AS turned") + f"""
SELECT app_id, CAST(hit AS INT) AS pred_fraud, 1 AS version, NULL::VARCHAR AS rejected FROM s
UNION ALL SELECT app_id + {_SHIFT}, CAST(turned AS INT), 2, NULL FROM s
UNION ALL SELECT NULL, NULL, v, '{{"app_id": ' || CAST(app_id AS VARCHAR) FROM s, range(1, 3) t(v) WHERE app_id % 50 = 0""")
def running_json_stream(spark, sf):
    """JSON lines scored by one running query; a second version is published while it runs. Broken lines come out beside the rows."""
    base = _folder(spark)
    lookups = S.ready_lookups(_lookups(spark, sf))
    fitted(spark, sf, f"{base}/state", lookups=lookups)
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("tstmp_submit", "tstmp_create")]
    rows = applications(spark, sf).select(*(c for c in APPLICATION_COLUMNS), *times)

    def send(shift):
        lines = rows.withColumn("app_id", F.col("app_id") + shift).select(F.to_json(F.struct("*")).alias("value"))
        broken = rows.where("app_id % 50 = 0").select(F.concat(F.lit('{"app_id": '), F.col("app_id").cast("string")).alias("value"))
        lines.union(broken).write.mode("append").text(f"{base}/in")
    send(0)
    job = score_stream(json_lines(spark, f"{base}/in"), f"{base}/state", f"{base}/out", f"{base}/progress", END_TO_END,
                       lookups, DECLARED_TEXT, trigger={"processingTime": "1 second"}, schema=_KINDS)
    try:
        job.processAllAvailable()
        fitted(spark, sf, f"{base}/state", 2, turned=True, lookups=lookups)
        send(_SHIFT)
        job.processAllAvailable()
    finally:
        job.stop()
    scored = read_scored(spark, f"{base}/out").select(F.col("app_id").cast("long").alias("app_id"), "pred_fraud", "version", F.lit(None).cast("string").alias("rejected"))
    rejects = read_scored(spark, f"{base}/out", "rejects").select(
        F.lit(None).cast("long").alias("app_id"), F.lit(None).cast("int").alias("pred_fraud"), "version", F.col("value").alias("rejected"))
    return scored.unionByName(rejects)


@query("bypassed_stream", "SELECT app_id, 0.0::DOUBLE AS pred_fraud_prob, CAST(0 AS INT) AS pred_fraud FROM applications")
def bypassed_stream(spark, sf):
    return run_stream(spark, sf, bypass=True)


_BATCH = BatchOptions(END_TO_END, frozenset(DECLARED_TEXT), scale=True, kind="decision_tree", params={"max_depth": 4, "maxBins": 64},
                      train_noise=Noise(("app_duration",), 0.5), test_noise=Noise(("app_duration",), 0.5))
_TEST_SQL = """, held AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5(concat('42:', CAST(app_id AS STRING)))) AS rn, count(*) OVER () AS n FROM s)
  WHERE rn <= ceil(0.2::DOUBLE * n))"""
_QUALITY_SQL = """, c AS (SELECT count(*) FILTER (y AND hit) AS tp, count(*) FILTER (NOT y AND hit) AS fp, count(*) FILTER (y AND NOT hit) AS fn,
             count(*) FILTER (NOT y AND NOT hit) AS tn FROM held)
SELECT round(1 - fp / 2.0::DOUBLE / (fp + tn), 9) AS auc, 1.0::DOUBLE AS recall, tp::DOUBLE / (tp + fp) AS "precision",
       (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, tp, fp, fn, tn"""


@query("batch_job", _BLENDED_SQL + _TEST_SQL + _QUALITY_SQL + " FROM c")
def batch_job(spark, sf):
    """Extract, report, transform, split, noise, scale, train and test applications in one run: quality on the test rows."""
    path = f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"
    done, _ = run_batch(spark, path, lambda: marked(spark, sf), _BATCH, _lookups(spark, sf))
    return done["test"].tables["results"].withColumn("auc", F.round("auc", 9))


@query("batch_job_resumed", _BLENDED_SQL + """
SELECT app_id, CAST(y AS DOUBLE) AS label, CAST(hit AS DOUBLE) AS pred_fraud_prob, CAST(hit AS INT) AS pred_fraud,
       'extract:saved,report:saved,transform:saved,split:ran,prepare:ran,train:ran,test:ran' AS second_run
FROM s WHERE app_id % 4 = 3""")
def batch_job_resumed(spark, sf):
    """The job with a test source of its own, stopped ahead of its split and run again: answers for the test rows."""
    path = f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"
    rows = marked(spark, sf)

    def run(before=None):
        return run_batch(spark, path, lambda: rows.where("app_id % 4 != 3"), _BATCH, _lookups(spark, sf),
                         lambda: rows.where("app_id % 4 = 3"), before=before)

    def stop(stage):
        if stage == "split":
            raise InterruptedError(stage)
    try:
        run(stop)
    except InterruptedError:
        done, log = run()
    return done["test"].tables["answers"].withColumn("second_run", F.lit(",".join(f"{s}:{how}" for s, how in log)))
