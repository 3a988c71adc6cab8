"""Model properties on a planted signal, and stream scoring against batch scoring."""

from pyspark.sql import functions as F

from sievepoint.catalog import modelling as Q
from sievepoint.models import classifiers as C, training as T
from sievepoint.operators import splits as X
from sievepoint.plans import scoring as P, state as S

SF = "/root/testdata/sf0.001"


def planted(spark, n=1500):
    rows = spark.range(n).select(F.col("id").alias("app_id"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    rows = rows.withColumn("y", (F.col("a") > 0.5))
    return X.split_random(C.assemble(rows, ["a", "b"], ("app_id",), "y").cache(), "app_id", 0.3, "label")


def test_trees_find_the_signal(spark):
    rows = planted(spark)
    model, scored, result = T.train(rows, "boosted_trees", {"n_estimators": 3, "max_depth": 2})
    got = result.first()
    assert got.auc > 0.97 and scored.count() == 450
    top = C.importance(spark, model, ["a", "b"], 1).first()
    assert top.feature == "a"
    assert C.spark_params("boosted_trees", {"colsample_bytree": 0.5, "colsample_bylevel": 0.5}) == {"featureSubsetStrategy": "0.25"}


def test_grid_and_search(spark):
    assert len(T.parameter_grid({"a": [1, 2], "b": [3, 4, 5]})) == 6
    rows = X.kfold(planted(spark), "app_id", 2)
    _, best, table = T.search(rows, "decision_tree", {"max_depth": [1, 2]}, folds=2)
    assert table.count() == 2 and table.filter("rank_test_score = 1").first().mean_test_score > 0.9


def test_given_model_and_bypass(spark):
    rows = planted(spark, 300)
    model = C.make_classifier("decision_tree").fit(rows)
    own = {r.app_id: int(r.prediction) for r in model.transform(rows).collect()}
    assert {r.app_id: r.predicted for r in T.holdout(None, rows, model=model).collect()} == own
    off = C.bypass(rows).first()
    assert (off.pred_fraud_prob, off.pred_fraud) == (0.0, 0)


def test_search_drops_parameters_without_effect(spark):
    rows = X.kfold(planted(spark, 400), "app_id", 2)
    _, _, table = T.search(rows, "decision_tree", {"max_depth": [1, 2], "reg_alpha": [1, 3, 5], "reg_lambda": [1, 3]}, folds=2)
    assert table.count() == 2


def test_kinds_and_report(spark):
    rows = X.kfold(planted(spark, 600), "app_id", 2)
    models, table = T.train_kinds(rows, {"decision_tree": {"max_depth": 2}, "random_forest": {"n_estimators": 3}}, fold="fold")
    assert set(models) == {"decision_tree", "random_forest"}
    assert sorted((r.kind, r.split) for r in table.collect()) == [(k, s) for k in sorted(models) for s in ("0", "1", "all")]
    scored = T.out_of_fold(rows, "decision_tree", {"max_depth": 2}, folds=2)
    report = {r["class"]: r for r in T.classification_report(scored).collect()}
    assert report[0].support + report[1].support == 600 and report[1].f1 > 0.9


def test_stream_equals_batch_and_newest_state_is_used(spark, tmp_path):
    path = str(tmp_path / "state")
    first = Q.fitted(spark, SF, path, 1)
    assert first["version"] == 1
    state, lookups = S.ready(first, Q._lookups(spark, SF))
    batch = P.score(Q.marked(spark, SF), Q.END_TO_END, state, lookups, Q.DECLARED_TEXT)
    want = sorted(map(tuple, batch.collect()))
    from sievepoint.streaming.scoring import FreshState, read_scored, score_stream
    fresh = FreshState(path, lookups)
    held = fresh.get(spark)
    assert fresh.get(spark) is held
    events = str(tmp_path / "in")
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(events)
    job = score_stream(Q._stream(spark, events), path, str(tmp_path / "out"), str(tmp_path / "progress"),
                       Q.END_TO_END, lookups, Q.DECLARED_TEXT, trigger={"availableNow": True})
    job.awaitTermination()
    assert len(list((tmp_path / "out" / "scored").glob("batch=*"))) == 3
    got = read_scored(spark, str(tmp_path / "out")).drop("version")
    assert sorted(map(tuple, got.collect())) == want and len(want) == 1000
    S.publish(spark, path, 2, {k: first[k] for k in ("inputs", "ranks", "codes")}, first["features"], first["model"].stages[0])
    assert fresh.get(spark)[0]["version"] == 2 and fresh.get(spark)[1]["ip_ranges"] is held[1]["ip_ranges"]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The query's own progress is lost, a newer version has come: batches with a mark stay as they are."""
    from sievepoint.streaming.scoring import read_scored, score_stream
    path, events, out = (str(tmp_path / x) for x in ("state", "in", "out"))
    first = Q.fitted(spark, SF, path, 1)
    spark.read.parquet(f"{SF}/events.parquet").coalesce(1).write.parquet(events)

    def run(progress):
        score_stream(Q._stream(spark, events), path, out, str(tmp_path / progress), Q.END_TO_END, Q._lookups(spark, SF), Q.DECLARED_TEXT,
                     trigger={"availableNow": True}).awaitTermination()
        return sorted(map(tuple, read_scored(spark, out).collect()))
    want = run("a")
    S.publish(spark, path, 2, {k: first[k] for k in ("inputs", "ranks", "codes")}, first["features"], first["model"].stages[0])
    assert run("b") == want and len(want) == 1000 and {r[-1] for r in want} == {1}


def test_scoring_with_ready_state(spark, tmp_path):
    """No job before the answer is asked for, and unknown columns or the size of a batch change nothing."""
    state, lookups = S.ready(Q.fitted(spark, SF, str(tmp_path / "state")), Q._lookups(spark, SF))
    few = Q.marked(spark, SF).where("app_id < 40").cache()
    few.count()
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    plain = P.score(few, Q.END_TO_END, state, lookups, Q.DECLARED_TEXT)
    assert len(jobs.getJobIdsForGroup("plan")) == 0
    spark.sparkContext.setJobGroup("rest", "rest")
    more = few.withColumns({"surprise": F.lit(None).cast("int"), "another": F.lit(0)})
    want = sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, P.score(more, Q.END_TO_END, state, lookups, Q.DECLARED_TEXT).collect())) == want
    one = P.score(few.where("app_id = 7"), Q.END_TO_END, state, lookups, Q.DECLARED_TEXT)
    assert [tuple(r) for r in one.collect()] == [w for w in want if w[0] == 7]


def test_kept_columns_do_not_depend_on_the_batch(spark, tmp_path):
    from dataclasses import replace
    opts = replace(Q.END_TO_END, unique_bound=50, cardinality_thresh=3)
    small = Q.marked(spark, SF).where("app_id < 60").cache()
    assembled, state, features = P.prepare_training(small, opts, Q._lookups(spark, SF), Q.DECLARED_TEXT)
    model = C.make_classifier("decision_tree", {"maxBins": 64}).fit(assembled.cache())
    S.publish(spark, str(tmp_path / "s"), 1, state, features, model)
    held, lookups = S.ready(S.load(spark, str(tmp_path / "s")), Q._lookups(spark, SF))
    whole = P.score(Q.marked(spark, SF), opts, held, lookups, Q.DECLARED_TEXT)
    assert whole.count() == 1000
