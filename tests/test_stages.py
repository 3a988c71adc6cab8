"""Saved stages: what counts, what runs again, what a stop leaves."""

import pytest
from conftest import values

from sievepoint.plans.stages import Stages


@pytest.fixture
def job(spark, tmp_path, rows):
    calls = []

    def run(settings="a", fail=None, before=None):
        store = Stages(spark, str(tmp_path / "job"), before)

        def first():
            calls.append("first")
            return {"t": rows([(1,), (2,)], "a int")}, {}

        def second():
            calls.append("second")
            if fail == "second":
                # Half of the stage is written when it fails.
                return {"t": one.tables["t"], "u": one.tables["t"].selectExpr("raise_error('lost') AS x")}, {}
            return {"t": one.tables["t"].selectExpr("a * 10 AS a")}, {}
        one = store.run("first", settings, first)
        two = store.run("second", "s", second, (one,))
        return store, one, two
    return run, calls


def test_second_run_uses_what_is_saved(job):
    run, calls = job
    store, _, two = run()
    again, _, same = run()
    assert calls == ["first", "second"] and [how for _, how in store.log + again.log] == ["ran", "ran", "saved", "saved"]
    assert same.version == two.version and values(same.tables["t"]) == [(10,), (20,)]


def test_changed_settings_run_that_stage_and_later_ones(job):
    run, calls = job
    _, one, two = run()
    store, newer, latest = run("b")
    assert calls == ["first", "second"] * 2 and newer.version != one.version and latest.version != two.version
    assert store.load("second").version == latest.version


def test_a_failed_stage_is_not_committed(job):
    run, calls = job
    with pytest.raises(Exception, match="lost"):
        run(fail="second")
    store, _, two = run()
    assert store.log == [("first", "saved"), ("second", "ran")] and values(two.tables["t"]) == [(10,), (20,)]
    assert calls == ["first", "second", "second"]


def test_a_stop_ahead_of_a_stage(job):
    run, calls = job

    def stop(stage):
        if stage == "second":
            raise InterruptedError
    with pytest.raises(InterruptedError):
        run(before=stop)
    assert calls == ["first"]


def test_rows_are_counted_while_they_are_written(spark, tmp_path, rows):
    store = Stages(spark, str(tmp_path / "job"))
    saved = store.run("s", "", lambda: ({"some": spark.range(1234), "none": rows([], "a int"), "cut": spark.range(50).where("id < 0")}, {}))
    assert saved.rows == {"some": 1234, "none": 0, "cut": 0}
    assert Stages(spark, str(tmp_path / "job")).load("s").rows == saved.rows and saved.tables["some"].count() == 1234


def test_missing_stage(spark, tmp_path):
    with pytest.raises(LookupError, match="never"):
        Stages(spark, str(tmp_path)).load("never")
