"""Inputs that used to be dropped, cut or answered differently by size."""

from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F

from sievepoint.operators import fitted as M, lookup as L, ranges as N, splits as X
from sievepoint.runtime import materialize, measured_size, scratch
from sievepoint.sources import readers as S, sinks as W

KINDS = {"a": "int", "b": "str"}


def test_line_breaks_and_missing_words(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    W.write_csv(rows([(1, "x\ny"), (2, 'q"r", s'), (3, "NA"), (4, "n/a"), (5, "nap"), (6, "None")], "a int, b string"), path)
    want = [(1, "x\ny"), (2, 'q"r", s'), (3, None), (4, None), (5, "nap"), (6, None)]
    assert values(S.read_typed_csv(spark, path, KINDS), "a", "b") == want
    assert values(S.read_inferred_csv(spark, path), "a", "b") == want


def test_header_orders(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    df = rows([(1, "x"), (2, "y")], "a int, b string")
    W.write_csv(df.coalesce(1), path)
    W.write_csv(df.select(F.col("b"), (F.col("a") + 10).alias("a"), F.lit(1).alias("c")).coalesce(1), path, "append")
    assert values(S.read_typed_csv(spark, path, KINDS, mixed_headers=True), "a", "b") == [(1, "x"), (2, "y"), (11, "x"), (12, "y")]
    with pytest.raises(Exception):
        S.read_typed_csv(spark, path, KINDS).collect()


def test_inferred_kinds(spark, tmp_path):
    (tmp_path / "f.csv").write_text("i,l,d,f,t,n\n1,9000000000,1.5,t,a,\nNA,2,1e3,F,1,NULL\n")
    got = S.read_inferred_csv(spark, str(tmp_path / "f.csv"))
    assert dict(got.dtypes) == {"i": "int", "l": "bigint", "d": "double", "f": "boolean", "t": "string", "n": "string"}


def test_bodies_that_do_not_parse(rows):
    df = rows([(1, '{"a": 1}'), (2, '{"a": 2'), (3, "oops"), (4, "[]"), (5, '[{"a": 5}, {"a": 6}]'), (6, None)], "k int, j string")
    got = S.json_records(df, "j", {"a": "int"}, ("k",), reject="bad")
    assert sorted(((r.k, r.a, r.bad) for r in got.collect()), key=str) == sorted(
        [(1, 1, None), (2, None, '{"a": 2'), (3, None, "oops"), (5, 5, None), (5, 6, None), (6, None, None)], key=str)


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_ranges_settle_before_the_plan_is_chosen(rows, max_rows):
    big = 1 << 60
    ranges = rows([(None, "XX"), (10, "A"), (10, "B"), (20, None), (30, "C"), (big, "D"), (big + 7, "E")], "start long, country string")
    df = rows([(5,), (10,), (25,), (31,), (1 << 40,), (big + 3,), (big + 7,), (None,)], "x long")
    got = {r.x: r.country for r in N.range_lookup(df, F.col("x"), ranges, max_rows=max_rows).collect()}
    assert got == {5: "-", 10: "B", 25: "ZZ", 31: "C", 1 << 40: "C", big + 3: "D", big + 7: "-", None: "ZZ"}


def test_large_merge_keeps_null_groups(rows):
    df = rows([(i, "a" if i % 3 else None, i % 2) for i in range(60)], "i int, k string, m int")
    stats = df.groupBy("k", "m").agg(F.sum("i").alias("s"))
    assert values(L.merge_on(df, stats, ["k", "m"], max_rows=0), "i", "s") == values(L.merge_on(df, stats, ["k", "m"]), "i", "s")


def test_folds_over_repeated_and_missing_keys(rows):
    df = rows([(i, k) for i, k in enumerate([1, 2, 2, 2, 3, None, None, 2, 2, 2])], "i int, k int")
    got = X.contiguous_folds(df, "k", 5)
    assert sorted(r["count"] for r in got.groupBy("fold").count().collect()) == [2] * 5
    folds = sorted((r.fold, r.k is not None, r.k or 0) for r in got.collect())
    assert [f[1:] for f in folds] == sorted(f[1:] for f in folds)


def test_indicators_of_any_number_of_values(rows):
    df = rows([(i, f"v{i}") for i in range(1500)] + [(2000, None)], "i int, c string")
    state = M.fit_codes(df, ["c"], "i")
    with pytest.raises(ValueError):
        M.one_hot(df, state, "c")
    got = {r.i: r.c_flags for r in M.one_hot_vector(df, state, "c").collect()}
    assert got[7].size == 1500 and list(got[7].indices) == [7] and len(got[2000].indices) == 0


def test_leave_one_out_on_new_rows(rows):
    df = rows([(1, "a", 1.0), (2, "a", 0.0), (3, "b", 1.0)], "i int, c string, y double")
    state = M.fit_leave_one_out(df, ["c"], "y")
    new = rows([(1, "a"), (2, "zz"), (3, None)], "i int, c string")
    assert {r.i: round(r.c_loo, 6) for r in M.apply_leave_one_out(new, state, "c").collect()} == {1: 0.5, 2: 0.666667, 3: 0.666667}


def test_nested_payload_is_measured(rows):
    df = rows([([1.5] * 1000,)], "v array<double>")
    assert measured_size(df)[1] > 3000


def test_scratch_leaves_nothing(spark, rows):
    df = rows([(1,), (2,)], "a int")
    with scratch(spark) as folder:
        assert folder.split("/")[-1] in materialize(df).inputFiles()[0]
    assert not Path(folder.removeprefix("file:")).exists()
