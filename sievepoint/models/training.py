"""Training, search, curves, holdouts and backtests on an assembled frame.

The frame is written once; each fit and score is a distributed job over it. Loops run over splits
and parameter sets only, whose number is a parameter.
"""

from __future__ import annotations

import json
import random
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.constants import SCORE_THRESHOLD
from sievepoint.functions.hashing import normal, uniform
from sievepoint.models.classifiers import effective, fit, importance, in_parts, make_classifier, spark_params, with_probability
from sievepoint.operators.metrics import confusion, evaluate, evaluate_groups, f_beta
from sievepoint.operators.rules import decide
from sievepoint.operators.splits import contiguous_folds, row_range_chunks, shuffle_marks, split_random
from sievepoint.runtime import materialize


def fit_score(train: DataFrame, test: DataFrame, kind: str, params: dict | None = None):
    model = fit(train, kind, params)
    return model, with_probability(model.transform(test))


def out_of_fold(df: DataFrame, kind: str, params: dict | None = None, fold: str = "fold",
                folds: int | None = None) -> DataFrame:
    """Every row scored by the model that did not see its fold."""
    k = folds if folds is not None else df.agg(F.max(fold)).first()[0] + 1
    parts = [fit_score(df.filter(F.col(fold) != i), df.filter(F.col(fold) == i), kind, params)[1]
             for i in range(k)]
    return reduce(DataFrame.unionByName, parts)


def train(df: DataFrame, kind: str, params: dict | None = None, fold: str | None = None,
          is_test: str | None = "is_test", threshold: float = SCORE_THRESHOLD, retrain: bool = True):
    """Score held-out rows per split, evaluate them together, then fit on everything.

    Returns (model, held-out scores, results of one row).
    """
    if fold:
        scored, model = out_of_fold(df, kind, params, fold), None
    else:
        model, scored = fit_score(df.filter(~F.col(is_test)), df.filter(F.col(is_test)), kind, params)
    if retrain or model is None:
        model = fit(df, kind, params)
    scored = materialize(scored.drop("features"))
    return model, scored, evaluate(scored, "label", "prob", threshold)


def train_kinds(df: DataFrame, kinds: dict[str, dict], fold: str | None = None, is_test: str = "is_test",
                threshold: float = SCORE_THRESHOLD) -> tuple[dict, DataFrame]:
    """Several kinds with their chosen parameters in one run: (models fitted on all rows, quality rows).

    The table has one row per kind and split, and with folds one more for all held-out rows together.
    """
    models, rows = {}, []
    for kind, params in kinds.items():
        if fold:
            scored = materialize(out_of_fold(df, kind, params, fold).drop("features"))
            splits = {str(r[fold]): scored.where(F.col(fold) == r[fold]) for r in scored.select(fold).distinct().collect()}
            splits["all"] = scored
        else:
            scored = fit_score(df.where(~F.col(is_test)), df.where(is_test), kind, params)[1]
            splits = {"holdout": materialize(scored.drop("features"))}
        models[kind] = fit(df, kind, params)
        rows += [evaluate(part, "label", "prob", threshold).withColumns({
            "kind": F.lit(kind), "split": F.lit(name), "params": F.lit(json.dumps(params, sort_keys=True))}) for name, part in splits.items()]
    return models, reduce(DataFrame.unionByName, rows)


def classification_report(scored: DataFrame, label: str = "label", prob: str = "prob", threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    counts = confusion(scored, label, decide(F.col(prob), threshold))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    each = F.explode(F.array(*(
        F.struct(F.lit(k).alias("class"), share(hit, hit + wrong).alias("precision"), share(hit, hit + lost).alias("recall"),
                 share(2 * hit, 2 * hit + wrong + lost).alias("f1"), (hit + lost).alias("support"))
        for k, hit, wrong, lost in ((0, tn, fn, fp), (1, tp, fp, fn)))))
    return counts.select(each.alias("r")).select("r.*")


def parameter_grid(space: dict[str, list]) -> list[dict]:
    names = sorted(space)
    return [dict(zip(names, values)) for values in product(*(space[n] for n in names))]


def search(df: DataFrame, kind: str, space: dict[str, list], fold: str = "fold", folds: int = 3,
           n_iter: int | None = None, seed: int = 42, parallelism: int = 4):
    """Grid search, or a random draw of ``n_iter`` grid points, scored by recall on given folds.

    Parameters without effect on ``kind`` are left out before the grid is built. Returns (best model refitted on all rows, best parameters, results table).
    """
    grid = parameter_grid(effective(kind, space))
    if n_iter is not None and n_iter < len(grid):
        grid = random.Random(seed).sample(grid, n_iter)
    estimator = make_classifier(kind)
    maps = [{estimator.getParam(n): v for n, v in spark_params(kind, p).items()} for p in grid]
    scorer = MulticlassClassificationEvaluator(labelCol="label", metricName="recallByLabel", metricLabel=1.0)
    found = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=scorer,
                           numFolds=folds, foldCol=fold, parallelism=parallelism).fit(in_parts(df))
    order = sorted(range(len(grid)), key=lambda i: -found.avgMetrics[i])
    rows = [(rank + 1, json.dumps(grid[i], sort_keys=True), float(found.avgMetrics[i]),
             float(found.stdMetrics[i])) for rank, i in enumerate(order)]
    table = df.sparkSession.createDataFrame(
        rows, "rank_test_score int, params string, mean_test_score double, std_test_score double")
    return found.bestModel, grid[order[0]], table


@contextmanager
def _held(df: DataFrame, *columns: str):
    """The columns that many fits read, dealt out and kept once for all of them; what does not fit into memory stays on disk."""
    rows = in_parts(df.select(*columns)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def _leaves(node, depths: list[int], level: int = 0, above: tuple = ()) -> list[tuple]:
    """For each leaf from left to right, the class that the tree cut at each depth gives its rows."""
    above = (*above, *(node.prediction() for d in depths if d == level))
    if "InternalNode" not in node.getClass().getName():
        return [(*above, *(node.prediction() for d in depths if d > level))]
    return _leaves(node.leftChild(), depths, level + 1, above) + _leaves(node.rightChild(), depths, level + 1, above)


def _by_depth(grid: list[dict], kind: str) -> list[tuple[dict, dict[int, list[int]]]]:
    """Points that differ in their depth alone share a fit: (other parameters of the estimator, positions in the grid by depth)."""
    groups: dict[str, tuple[dict, dict[int, list[int]]]] = {}
    default = make_classifier(kind).getMaxDepth()
    for i, point in enumerate(grid):
        others = spark_params(kind, point)
        depth = others.pop("maxDepth", default)
        groups.setdefault(json.dumps(others, sort_keys=True), (others, {}))[1].setdefault(depth, []).append(i)
    return list(groups.values())


def _tree_scores(rows: DataFrame, kind: str, part: list[tuple[dict, dict[int, list[int]]]], fold: str, folds: int, scorer,
                 parallelism: int) -> dict[int, list[float]]:
    """Recall of each point of ``part`` on each fold.

    A single tree grows level by level from all its rows and features, so that the tree of a lesser depth is the deepest one
    cut there. The deepest is fitted, and one pass over a fold scores all trees at all depths.
    """
    def fitted(job):
        (others, depths), i = job
        return make_classifier(kind, {**others, "maxDepth": max(depths)}).fit(rows.where(F.col(fold) != i))
    jobs = [(group, i) for i in range(folds) for group in part]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        models = pool.map(inheritable_thread_target(rows.sparkSession)(fitted), jobs, chunksize=1)
    scores: dict[int, list[float]] = {at: [] for _, depths in part for places in depths.values() for at in places}
    for i in range(folds):
        scored, sums = rows.where(F.col(fold) == i), []
        mine = [(group, m) for (group, k), m in zip(jobs, models) if k == i]
        for n, ((_, depths), model) in enumerate(mine):
            deep = sorted(depths)
            given = _leaves(model._java_obj.rootNode(), deep)
            scored = model.setLeafCol(f"_leaf{n}").transform(scored).drop("rawPrediction", "probability", "prediction")
            for k, d in enumerate(deep):
                answer = F.get(F.lit([leaf[k] for leaf in given]), F.col(f"_leaf{n}").cast("int"))
                scored = scored.withColumn(f"_p{n}_{d}", answer)
                sums.append(F.count(F.when((F.col("label") == 1.0) & (F.col(f"_p{n}_{d}") == 1.0), 1)).alias(f"_p{n}_{d}"))
        found = scored.agg(F.count(F.when(F.col("label") == 1.0, 1)).alias("_all"), *sums).first()
        for n, ((_, depths), _) in enumerate(mine):
            for d, places in depths.items():
                # Without any row of the class the evaluator says what its recall is.
                value = (found[f"_p{n}_{d}"] / found["_all"] if found["_all"]
                         else scorer.evaluate(scored.select("label", F.col(f"_p{n}_{d}").alias("prediction"))))
                for at in places:
                    scores[at].append(value)
    return scores


def _check_folds(rows: DataFrame, fold: str, folds: int) -> None:
    known = F.col(fold).between(0, folds - 1)
    found = rows.agg(F.count(F.when(~F.coalesce(known, F.lit(False)), 1)).alias("bad"),
                     *(F.count(F.when(F.col(fold) == i, 1)).alias(f"_{i}") for i in range(folds))).first()
    if found.bad:
        raise ValueError(f"{fold} must be in 0 to {folds - 1}")
    for i in range(folds):
        if found[f"_{i}"] in (0, sum(found[1:])):
            raise ValueError(f"the rows to fit or to score at fold {i} are none")


_SCORES = "tag string, run string, scope string, label double, prob double, n long"
_RANKS = "tag string, run string, strongest array<struct<rank: int, feature: string, score: double>>"
_POINTS = "point string, mean double, std double"


def recoverable_search(df: DataFrame, path: str, kind: str, space: dict[str, list], fold: str = "fold", folds: int = 3,
                       n_iter: int | None = None, seed: int = 42, parallelism: int = 8, before=None):
    """``search`` whose points are rows of a table under ``path``: (best model refitted on all rows, best parameters, results table).

    Points are fitted some at a time over the one frame that is kept, and their scores are appended when they are
    done. Single trees that differ in their depth alone are fitted once. A search that was stopped goes on with the points that
    have no score yet; with the same seed it gives the ranks of a search that was never stopped. ``before`` is told how many
    points are left ahead of each part.
    """
    spark = df.sparkSession
    grid = parameter_grid(effective(kind, space))
    if n_iter is not None and n_iter < len(grid):
        grid = random.Random(seed).sample(grid, n_iter)
    names = [json.dumps(p, sort_keys=True) for p in grid]
    spark.createDataFrame([], _POINTS).write.mode("append").parquet(f"{path}/points")
    scorer = MulticlassClassificationEvaluator(labelCol="label", metricName="recallByLabel", metricLabel=1.0)
    estimator = make_classifier(kind)
    known = lambda: {r.point: r for r in spark.read.schema(_POINTS).parquet(f"{path}/points").collect()}  # noqa: E731  one for each point
    done = known()
    left = [i for i, n in enumerate(names) if n not in done]
    trees = kind == "decision_tree"
    with _held(df, fold, "features", "label") as rows:
        if left and trees:
            _check_folds(rows, fold, folds)
        while left:
            if before:
                before(len(left))
            if trees:
                # A group is one fit for each fold.
                part = _by_depth([grid[i] for i in left], kind)[:max(1, parallelism // folds)]
                found = {left[at]: (fmean(s), pstdev(s)) for at, s in _tree_scores(rows, kind, part, fold, folds, scorer, parallelism).items()}
            else:
                part = left[:parallelism]
                maps = [{estimator.getParam(n): v for n, v in spark_params(kind, grid[i]).items()} for i in part]
                cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=scorer, numFolds=folds, foldCol=fold,
                                    parallelism=parallelism).fit(rows)
                found = {i: (float(m), float(s)) for i, m, s in zip(part, cv.avgMetrics, cv.stdMetrics)}
            written = [(names[i], *found[i]) for i in sorted(found)]
            spark.createDataFrame(written, _POINTS).coalesce(1).write.mode("append").parquet(f"{path}/points")
            left = [i for i in left if i not in found]
    scores = known()
    order = sorted(range(len(grid)), key=lambda i: -scores[names[i]].mean)
    table = spark.createDataFrame([(rank + 1, names[i], scores[names[i]].mean, scores[names[i]].std) for rank, i in enumerate(order)],
                                  "rank_test_score int, params string, mean_test_score double, std_test_score double")
    best = grid[order[0]]
    return fit(df, kind, best), best, table


def _accuracy(scored: DataFrame) -> float:
    return confusion(scored, "label", decide(F.col("prob"), 0.5)).first().accuracy


def _curve_row(x, n_train, train_scores, test_scores):
    return (float(x), int(n_train), fmean(train_scores), pstdev(train_scores), fmean(test_scores), pstdev(test_scores))


_CURVE = "x double, n_train long, train_mean double, train_std double, test_mean double, test_std double"


def learning_curve(df: DataFrame, kind: str, params: dict | None = None, key: str = "app_id",
                   shares=(0.1, 0.325, 0.55, 0.775, 1.0), repeats: int = 5, share: float = 0.2) -> DataFrame:
    """Accuracy on train and held-out rows for growing training shares, over shuffle splits."""
    # The draws are written with the marks: a fit passes over its rows several times.
    draws = F.array(*(uniform(F.col(key), r, "curve") for r in range(repeats)))
    split = materialize(shuffle_marks(df, key, repeats, share).withColumn("_draws", draws))
    rows = []
    for size in shares:
        n, on_train, on_test = 0, [], []
        for r in range(repeats):
            held = F.col("is_test")[r]
            known = ~held & (F.col("_draws")[r] < size)
            model = fit(split.filter(known), kind, params)
            # Train and held-out rows in one pass.
            scored = with_probability(model.transform(split.filter(known | held).withColumn("_held", held)))
            right = F.avg((decide(F.col("prob"), 0.5) == F.col("label")).cast("double"))
            found = {s["_held"]: s for s in scored.groupBy("_held").agg(F.count(F.lit(1)).alias("n"), right.alias("accuracy")).collect()}
            n = found[False].n
            on_train.append(found[False].accuracy)
            on_test.append(found[True].accuracy)
        rows.append(_curve_row(size, n, on_train, on_test))
    return df.sparkSession.createDataFrame(rows, _CURVE)


def validation_curve(df: DataFrame, kind: str, name: str, values: list, params: dict | None = None,
                     fold: str = "fold", folds: int = 3) -> DataFrame:
    """Accuracy on train and held-out folds for each value of one parameter."""
    rows = []
    for value in values:
        n, on_train, on_test = 0, [], []
        for i in range(folds):
            known = df.filter(F.col(fold) != i)
            model, scored = fit_score(known, df.filter(F.col(fold) == i), kind, {**(params or {}), name: value})
            n = known.count()
            on_train.append(_accuracy(with_probability(model.transform(known))))
            on_test.append(_accuracy(scored))
        rows.append(_curve_row(value, n, on_train, on_test))
    return df.sparkSession.createDataFrame(rows, _CURVE)


def cross_predict(df: DataFrame, kind: str, params: dict | None = None, key: str = "app_id", k: int = 5,
                  threshold: float = 0.5) -> DataFrame:
    """Unshuffled k-fold predictions; a probability at the threshold is class 1."""
    scored = out_of_fold(contiguous_folds(df, key, k), kind, params, folds=k)
    return scored.withColumn("predicted", decide(F.col("prob"), threshold, strict=False))


def holdout(train_rows: DataFrame, test_rows: DataFrame, kind: str | None = None, params: dict | None = None,
            threshold: float = 0.5, model=None) -> DataFrame:
    """Train and predict, or predict by a given model."""
    scored = (with_probability(model.transform(test_rows)) if model is not None
              else fit_score(train_rows, test_rows, kind, params)[1])
    return scored.withColumn("predicted", decide(F.col("prob"), threshold, strict=False))


def repeated_holdout(df: DataFrame, kind: str, params: dict | None = None, key: str = "app_id",
                     repeats: int = 1, share: float = 0.2, beta: float = 1.0, threshold: float = 0.5) -> DataFrame:
    """Confusion counts and F-beta on one random holdout, averaged over refits with other seeds."""
    split = materialize(split_random(df, key, share))
    seeded = kind not in ("logistic", "gaussian_nb")
    runs = []
    for r in range(repeats):
        extra = {"seed": 42 + r} if seeded else {}
        runs.append(holdout(split.filter("not is_test"), split.filter("is_test"), kind,
                            {**(params or {}), **extra}, threshold)
                    .select(F.lit(r).alias("repeat"), "label", "predicted"))
    return f_beta(reduce(DataFrame.unionByName, runs), "repeat", "label", "predicted", beta)


def progressive(df: DataFrame, kind: str, n_chunks: int, params: dict | None = None,
                key: str = "app_id") -> DataFrame:
    """Train on each of the first chunks by itself, test on the last; one quality row per chunk."""
    if n_chunks < 2:
        raise ValueError("at least 2 chunks are needed")
    cut = materialize(row_range_chunks(df, key, n_chunks))
    last = cut.filter(F.col("chunk") == n_chunks - 1)
    rows = [confusion(fit_score(cut.filter(F.col("chunk") == i), last, kind, params)[1], "label",
                      decide(F.col("prob"), 0.5)).withColumn("chunk", F.lit(i)) for i in range(n_chunks - 1)]
    return reduce(DataFrame.unionByName, rows)


@dataclass(frozen=True)
class Split:
    """One run of a backtest: the rows to train on, the rows to test on, and what is done to the training features."""
    tag: str
    train: Column
    test: Column
    features: Column | None = None


def noisy_vector(features: list[str], columns: list[str], key: str, level: float, share: float, seed: int) -> Column:
    """The feature vector with factors N(1, level) on some columns, for a ``share`` of the rows by hash of the key."""
    picked = uniform(F.col(key), seed, "noise") < share
    factor = F.lit(1.0) + F.lit(float(level)) * normal(F.col(key), seed)
    values = vector_to_array("features")
    return array_to_vector(F.array(*(
        F.when(picked, F.get(values, F.lit(i)) * factor).otherwise(F.get(values, F.lit(i))) if c in columns else F.get(values, F.lit(i))
        for i, c in enumerate(features))))


def backtest(df: DataFrame, splits: list[Split], kind: str, features: list[str], path: str, params: dict | None = None,
             threshold: float = SCORE_THRESHOLD, before=None) -> DataFrame:
    """Train and score over many splits of one frame and give their history rows, train and test.

    The frame is written once and kept; a split is two conditions on its rows. Each split's scores, counted by label and probability, and its
    strongest features are appended when it is done, so that a backtest that was stopped goes on with the splits that are left
    (``before`` is told each tag that runs). Quality is worked out for all splits together.
    """
    from sievepoint.sources.sinks import history_rows
    spark = df.sparkSession
    scores, ranks = f"{path}/scores", f"{path}/ranks"
    spark.createDataFrame([], _SCORES).write.mode("append").parquet(scores)
    spark.createDataFrame([], _RANKS).write.mode("append").parquet(ranks)
    read = lambda where, schema: spark.read.schema(schema).parquet(where)
    done = {r.tag for r in read(ranks, _RANKS).select("tag").distinct().collect()}
    with _held(materialize(df), *df.columns) as rows:
        for split in splits:
            if split.tag in done:
                continue
            if before:
                before(split.tag)
            known = rows.where(split.train)
            model = fit(known if split.features is None else known.withColumn("features", split.features), kind, params)
            # Train and test rows in one pass; a row may be both.
            parts = F.array(*(F.when(part, F.lit(scope)) for scope, part in (("train", split.train), ("test", split.test))))
            scored = with_probability(model.transform(rows.where(split.train | split.test).withColumn("_parts", parts)))
            counted = scored.groupBy("_parts", "label", "prob").agg(F.count(F.lit(1)).alias("n"))
            counted = (counted.select(F.explode("_parts").alias("scope"), "label", "prob", "n").where("scope IS NOT NULL")
                       .groupBy("scope", "label", "prob").agg(F.sum("n").alias("n")))
            run = uuid.uuid4().hex  # scores of a run that stopped before its mark are not read
            counted.select(F.lit(split.tag).alias("tag"), F.lit(run).alias("run"), *counted.columns).write.mode("append").parquet(scores)
            strongest = (importance(spark, model, features, 10).collect()
                         if hasattr(model, "featureImportances") or hasattr(model, "coefficients") else [])
            mark = [(split.tag, run, [(r["rank"], r.feature, float(r.score)) for r in strongest])]
            spark.createDataFrame(mark, _RANKS).coalesce(1).write.mode("append").parquet(ranks)
    order = {s.tag: i for i, s in enumerate(splits)}
    marks = read(ranks, _RANKS).where(F.col("tag").isin(list(order)))
    scored = read(scores, _SCORES).join(F.broadcast(marks.select("tag", "run")), ["tag", "run"])  # a mark for each split
    quality = evaluate_groups(scored, ["tag", "scope"], "label", "prob", threshold, weight="n").join(marks, "tag")
    quality = quality.select(
        "tag", "scope", F.lit(kind).alias("model"), F.col("auc").alias("AUC"), F.col("accuracy").alias("Accuracy"),
        F.col("precision").alias("Precision"), F.col("recall").alias("Recall"),
        *(c for i in range(10) for c in (
            F.when(F.col("scope") == "train", F.get("strongest", F.lit(i))["feature"]).alias(f"feature{i}"),
            F.when(F.col("scope") == "train", F.get("strongest", F.lit(i))["score"]).alias(f"feature{i}_score"))))
    return history_rows(quality, None, scope=None)
