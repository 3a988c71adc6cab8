"""Jobs whose only use is to find again what is known: each takes the driver a few broadcasts of 4 MB, however short its table."""

from contextlib import contextmanager

import pytest
from pyspark.ml.linalg import Vectors

from sievepoint.catalog import modelling as Q
from sievepoint.models import classifiers as C
from sievepoint.operators import fitted as T
from sievepoint.plans import batch as B, features as P, state as S
from sievepoint.plans.stages import Stages

SF = "/root/testdata/sf0.001"


@contextmanager
def _jobs(spark, group):
    """A list that holds, on leaving, the jobs run inside."""
    found = []
    spark.sparkContext.setJobGroup(group, group)
    try:
        yield found
        found += spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def _prepared(monkeypatch):
    """Counts how often ranges are sorted, wherever that is called."""
    calls, true = [], S.prepare_ranges

    def counted(*args):
        calls.append(args)
        return true(*args)
    monkeypatch.setattr(S, "prepare_ranges", counted)
    monkeypatch.setattr(P, "prepare_ranges", counted)
    monkeypatch.setattr("sievepoint.operators.ranges.prepare_ranges", counted)
    return calls


def test_saved_tables_are_found_without_jobs(spark, tmp_path, rows):
    path = str(tmp_path / "job")
    data = [(1, "a", [1.5]), (None, None, None)]
    made = lambda: ({f"t{i}": rows(data, "a int, b string, c array<double>") for i in range(5)}, {})
    ran = Stages(spark, path).run("s", "", made)
    with _jobs(spark, "load") as jobs:
        saved = Stages(spark, path).load("s")
    # An empty list of marks is written and the marks are read; no table is opened.
    assert len(jobs) <= 3
    for name, table in saved.tables.items():
        assert table.schema == ran.tables[name].schema == spark.read.parquet(f"{path}/s/{saved.version}/{name}").schema
        assert sorted(table.collect(), key=str) == sorted(ran.tables[name].collect(), key=str)


def test_marks_without_schemas_still_count(spark, tmp_path):
    """A job that was stopped before marks had schemas goes on."""
    path = str(tmp_path / "job")
    Stages(spark, path).run("s", "", lambda: ({"t": spark.range(3)}, {}))
    marks = spark.read.parquet(f"{path}/commits").drop("schemas").collect()
    old = str(tmp_path / "old")
    spark.createDataFrame(marks, "stage string, number long, version string, fingerprint string, tables map<string, long>, models array<string>"
                          ).write.parquet(f"{old}/commits")
    spark.read.parquet(f"{path}/s/{marks[0].version}/t").write.parquet(f"{old}/s/{marks[0].version}/t")
    assert sorted(r.id for r in Stages(spark, old).load("s").tables["t"].collect()) == [0, 1, 2]


def test_the_batch_job_sorts_ranges_once(spark, tmp_path, monkeypatch):
    calls = _prepared(monkeypatch)
    known = Q.marked(spark, SF)

    def stop(stage):
        if stage == "split":
            raise InterruptedError
    with pytest.raises(InterruptedError):
        B.run_batch(spark, str(tmp_path), lambda: known.where("app_id % 4 != 3"), Q._BATCH, Q._lookups(spark, SF),
                    lambda: known.where("app_id % 4 = 3"), before=stop)
    assert len(calls) == 1 and {"train", "test"} <= set(Stages(spark, str(tmp_path)).load("transform").tables)


def test_a_fit_and_its_stream_sort_ranges_once(spark, monkeypatch):
    calls = _prepared(monkeypatch)
    assert Q.run_stream(spark, SF).count() == Q.marked(spark, SF).count()
    assert len(calls) == 1


def test_a_published_state_lists_its_schemas(spark, tmp_path, rows):
    tables = {"ranks": rows([("a", "x", 0, 3), ("a", None, 1, None), ("b", None, 0, None)], "feature string, value string, rank long, n long")}
    model = C.fit(spark.createDataFrame([(Vectors.dense([float(i)]), float(i % 2)) for i in range(20)], ["features", "label"]), "decision_tree")
    S.publish(spark, str(tmp_path), 1, tables, ["f"], model)
    listed = spark.read.parquet(f"{tmp_path}/version=1/tables").collect()
    assert [(r.name, r.schema) for r in listed] == [("ranks", tables["ranks"].schema.json())]
    back = S.load(spark, str(tmp_path))
    assert back["features"] == ["f"] and sorted(map(tuple, back["ranks"].collect()), key=str) == sorted(map(tuple, tables["ranks"].collect()), key=str)
    with _jobs(spark, "prepare") as jobs:
        ready = T.prepare(tables["ranks"], "rank")
    assert ready.lengths == {"a": 1, "b": 0} and ready.features == {"a", "b"}
    # Sizes and lengths by one pass, small columns by another.
    with _jobs(spark, "two") as two:
        tables["ranks"].groupBy("feature").count().collect()
        tables["ranks"].collect()
    assert len(jobs) <= len(two)
