"""Operators against brute force on small fixtures, with hot keys and forced large-table paths."""

import random
from datetime import date, datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from sievepoint.operators import (distribution as E, fitted as M, logs as G, lookup as L, metrics as Q, ordered as O, ranges as N,
                                  reports as R, splits as X)
from sievepoint.operators.search import build_index, search


@pytest.fixture(params=["1", "16"])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield int(request.param)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot_rows(n=600, seed=3):
    """Group 0 holds well over a third of the rows."""
    rng = random.Random(seed)
    return [(i, 0 if rng.random() < 0.5 else rng.randrange(1, 30), rng.randrange(-5, 6)) for i in range(n)]


def test_running_total_over_hot_groups(rows, partitions):
    data = hot_rows()
    got = O.running_total(rows(data, "id long, g long, v long"), [F.col("id")], F.col("v"), "t", ["g"])
    want, sums = [], {}
    for i, g, v in data:
        sums[g] = sums.get(g, 0) + v
        want.append((i, sums[g]))
    assert values(got, "id", "t") == want


def test_row_and_group_index(rows, partitions):
    data = hot_rows()
    df = rows(data, "id long, g long, v long")
    assert values(O.row_index(df, [F.col("v"), F.col("id")]), "idx", "id") == [
        (i, r[0]) for i, r in enumerate(sorted(data, key=lambda r: (r[2], r[0])))]
    want, seen = [], {}
    for i, g, _ in data:
        want.append((i, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + 1
    assert values(O.group_index(df, [F.col("id")], ["g"]), "id", "idx") == want


def test_carry_last_crosses_ranges(rows, partitions):
    data = [(i, g, v if v == 5 else None) for i, g, v in hot_rows()]
    got = O.carry_last(rows(data, "id long, g long, v long"), [F.col("id")], F.when(F.col("v").isNotNull(), F.col("id")), "held", ["g"])
    want, held = [], {}
    for i, g, v in data:
        held[g] = i if v is not None else held.get(g, -1)
        want.append((i, held[g]))
    assert values(got.withColumn("held", F.coalesce("held", F.lit(-1))), "id", "held") == want


def test_large_table_lookup(rows, partitions):
    data = [(i, None if i % 11 == 0 else g) for i, g, _ in hot_rows()]
    table = [(g, f"n{g}") for g in range(0, 25)]
    got = L._shuffled_lookup(rows(data, "id long, g long"), rows(table, "g long, name string"), ["g"], hot_keys=3)
    names = dict(table)
    assert values(got.fillna("-", ["name"]), "id", "name") == [(i, names.get(g, "-")) for i, g in data]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_range_lookup_edges(rows, max_rows):
    ranges = rows([(100, "A"), (65536 * 3, "B"), (65536 * 3 + 5, None), (65536 * 4, "D")], "start long, country string")
    cases = {50: "-", 100: "A", 65536 * 2: "A", 65536 * 3: "B", 65536 * 3 + 4: "B", 65536 * 3 + 5: "ZZ", 65536 * 4: "-", 1 << 40: "-"}
    df = rows([*((x,) for x in cases), (None,)], "x long")
    got = {r.x: r.country for r in N.range_lookup(df, F.col("x"), ranges, max_rows=max_rows).collect()}
    assert got == {**cases, None: "ZZ"}


@pytest.mark.parametrize("n, max_rows", [(0, 9), (1, 9), (2, 9), (1000, 2000), (1000, 0), (0, 0), (1, 0), (64, 0), (65, 0)])
def test_search_in_sorted_index(spark, rows, n, max_rows):
    """Every number between and beside the keys, with one number asked for by half of all rows."""
    entries = spark.range(n).select((F.col("id") * 3).alias("key"), F.struct((F.col("id") * 10).alias("v")).alias("value"))
    asked = spark.range(-2, 3 * n + 5).select(F.col("id").alias("x")).union(spark.range(2 * n).select(F.lit(n).cast("long").alias("x")))
    index = build_index(entries, max_rows)
    got = {r.x: r.found.v if r.found else None for r in search(asked, F.col("x"), index, "found").collect()}
    assert got == {x: (min(x // 3, n - 1) * 10 if x >= 0 and n else None) for x in {*range(-2, 3 * n + 5), *([n] if n else [])}}
    assert search(asked, F.col("x"), index, "found").where("found.v = 10").count() == got_rows(asked, lambda x: n > 1 and (3 <= x < 6 or (n == 2 and x >= 3)))


def test_search_array_keeps_its_bound(spark):
    """The array that goes with every task does not grow with the table, though the table may be broadcast."""
    n = 40_000
    entries = spark.range(n).select((F.col("id") * 3).alias("key"), F.col("id").alias("value"))
    index = build_index(entries)
    assert index.n_top <= 1 << 14 and index.leaves.hot_keys * index.leaf <= 1 << 16
    asked = spark.range(-7, 3 * n + 7, 11).select(F.col("id").alias("x"))
    assert search(asked, F.col("x"), index, "found").where(
        "NOT (found <=> if(x < 0, NULL, least(x div 3, 39999)))").count() == 0
    wide = spark.range(300).select("id", F.repeat(F.lit("k"), 100_000).alias("text"))
    keyed = wide.select(F.format_string("%s%05d", "text", "id").alias("key"), F.col("id").alias("value"))
    assert build_index(keyed).n_top <= 64


def got_rows(asked, test):
    return sum(map(test, (r.x for r in asked.collect())))


def test_area_states(rows):
    df = rows([(1, "(916)"), (2, "(702)"), (3, "(000)"), (4, "916"), (5, None)], "i int, area_code string")
    codes = rows([("916", "CA"), ("702", "NV")], "code string, state string")
    assert values(L.area_state(df, codes), "i", "area_code_state") == [(1, "CA"), (2, "non-CA"), (3, "unknown"), (4, "na"), (5, "na")]


def test_rank_ties_and_lengths(rows):
    df = rows([(v,) for v in "bbbaaaccd"] + [(None,)], "c string")
    state = M.fit_rank(df, ["c"], 0.5)
    assert values(state.filter("value is not null"), "value", "rank") == [("a", 0), ("b", 1)]
    got = M.apply_rank(df, state, ["c"]).distinct()
    assert {r.c: r.c_rank for r in got.collect()} == {"a": 0, "b": 1, "c": 2, "d": 2, None: None}


def test_codes_first_appearance_and_unseen(rows):
    df = rows([(3, "x"), (1, "y"), (2, "x"), (4, "z")], "id int, c string")
    state = M.fit_codes(df, ["c"], "id")
    new = rows([("x",), ("y",), ("z",), ("w",), (None,)], "c string")
    assert [r.c for r in M.apply_codes(new, state, ["c"]).collect()] == [1, 0, 2, -1, -1]
    assert M.apply_codes(df, state, ["c"]).filter("c = -1").count() == 0


def test_codes_of_many_values_use_the_join(rows):
    data = [(i, f"v{i % 200}") for i in range(1000)]
    df = rows(data, "id int, c string")
    got = M.apply_codes(df, M.fit_codes(df, ["c"], "id"), ["c"])
    assert values(got, "id", "c") == [(i, i % 200) for i in range(1000)]


def test_rare_threshold_is_inclusive(rows):
    df = rows([(v,) for v in ["A", "a", "B", None]], "c string")
    assert sorted(str(r.c) for r in M.collapse_rare(df, M.fit_common(df, ["c"], 1), ["c"]).collect()) == ["None", "Other", "a", "a"]


def test_scale_uses_population_deviation_and_training_rows(rows):
    train = rows([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, k double")
    state = M.fit_scale(train, ["a", "k"])
    got = M.apply_scale(rows([(1.0, 6.0)], "a double, k double"), state, ["a", "k"]).first()
    assert got.a == pytest.approx((1 - 7 / 3) / 1.247219128924647) and got.k == 1.0


def test_leave_one_out_lone_row(rows):
    df = rows([(1, "a", 1), (2, "a", 0), (3, "b", 1), (4, None, 0)], "i int, c string, y int")
    assert {r.i: r.loo for r in M.leave_one_out(df, "c", "y", "loo").collect()} == {1: 0.0, 2: 1.0, 3: 0.5, 4: 0.5}


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_ecdf_and_interpolation(rows, partitions, max_rows):
    knots = E.ecdf(rows([(v,) for v in (1.0, 1.0, 2.0, 4.0)], "x double"), "x")
    assert values(knots, "v", "p") == [(1.0, 0.4), (2.0, 0.6), (4.0, 0.8)]
    asked = rows([(0.0,), (1.0,), (1.5,), (3.0,), (4.0,), (9.0,), (None,)], "x double")
    got = {r.x: r.p for r in E.ecdf_lookup(asked, F.col("x"), knots, max_rows=max_rows).collect()}
    want = {0.0: 0.4, 1.0: 0.4, 1.5: 0.5, 3.0: 0.7, 4.0: 0.8, 9.0: 0.8}
    assert got.pop(None) is None and got == pytest.approx(want)


def test_holdouts_are_disjoint_and_proportional(spark, partitions):
    df = spark.range(1003).select("id", (F.col("id") % 3 == 0).alias("y"))
    got = X.split_random(df, "id", 0.2, "y").groupBy("y", "is_test").count().collect()
    counts = {(r.y, r.is_test): r["count"] for r in got}
    assert sum(counts.values()) == 1003 and counts[True, True] + counts[False, True] == 201
    assert counts[True, True] == 67


def test_folds_cover_everything_once(spark, partitions):
    df = spark.range(1001).withColumn("v", F.col("id") % 17)
    sizes = lambda d, c: [r["count"] for r in d.groupBy(c).count().orderBy(c).collect()]
    assert sizes(X.kfold(df, "id", 4), "fold") == [251, 250, 250, 250]
    assert sizes(X.contiguous_folds(spark.range(12), "id", 5), "fold") == [3, 3, 2, 2, 2]
    by_value = X.kfold_by_value(df, "v", 3).select("v", "fold").distinct()
    assert by_value.count() == 17 and sizes(by_value, "fold") == [6, 6, 5]
    chunks = X.row_range_chunks(spark.range(10), "id", 3)
    assert sizes(chunks, "chunk") == [3, 4, 3]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500)
    one = values(X.split_random(df.coalesce(1), "id", 0.3).filter("is_test"), "id")
    assert one == values(X.split_random(df.repartition(13), "id", 0.3).filter("is_test"), "id") and len(one) == 150


def test_chronological_split_in_hot_group(rows, partitions):
    data = [(i, None if i % 50 == 0 else f"g{g}", datetime(2024, 1, 1 + abs(v))) for i, g, v in hot_rows()] + [(9999, "solo", datetime(2024, 1, 1))]
    got = X.split_chronological(rows(data, "id long, g string, t timestamp"), "g", "t", "id", 0.8)
    groups, want = {}, []
    for i, g, t in data:
        if g is not None:
            groups.setdefault(g, []).append((t, i))
    for members in groups.values():
        members.sort()
        want += [(i, k < int(0.8 * len(members))) for k, (_, i) in enumerate(members)]
    assert values(got, "id", "is_train") == sorted(want)


def test_auc_matches_pair_counting(rows, partitions):
    rng = random.Random(1)
    data = [(rng.random() < 0.4, round(rng.random(), 1)) for _ in range(200)]
    got = Q.evaluate(rows(data, "y boolean, p double"), "y", "p", 0.5).first()
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert got.auc == pytest.approx(want) and got.tp + got.fp + got.fn + got.tn == 200
    assert got.tp == sum(p > 0.5 for p in pos)


def test_undefined_quality(rows):
    got = Q.evaluate(rows([(False, 0.1)], "y boolean, p double"), "y", "p").first()
    assert (got.auc, got.recall, got.precision, got.accuracy) == (-1.0, 0.0, 0.0, 1.0)


def test_report_edges(rows):
    t = lambda *a: datetime(*a)
    df = rows([(t(2024, 1, 8), 5, 0.3), (t(2024, 1, 14, 23, 59, 59, 999999), 4, None), (t(2024, 1, 15), 5, float("nan")), (t(2024, 1, 9), 3, 0.9)],
              "tstmp_submit timestamp, fraud_status int, fraud_score double")
    got = {r.period: r for r in R.quality_report(df, date(2024, 2, 1), "week", 3, 1).collect()}
    assert sorted(got) == [date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 15)]
    week = got[date(2024, 1, 8)]
    assert (week.n_apps, week.n_fraud, week.tp, week.fp, week.fn, week.accuracy) == (2, 1, 1, 0, 0, 1.0)
    assert (got[date(2024, 1, 15)].fn, got[date(2024, 1, 15)].precision) == (1, 1.0)
    empty = got[date(2024, 1, 1)]
    assert (empty.n_apps, empty.accuracy, empty.precision, empty.recall) == (0, 1.0, 1.0, 1.0)


def test_calendars():
    assert R.week_starts(date(2024, 2, 8), 2, 1) == [date(2024, 1, 15), date(2024, 1, 22)]
    assert R.month_starts(date(2024, 1, 3), 3, 1, 5) == [date(2023, 9, 1), date(2023, 10, 1), date(2023, 11, 1)]


def test_mode_ties(rows):
    df = rows([(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, "c")], "pos int, v string")
    assert [r.v for r in R.most_common(df, "v", "pos", 2).collect()] == ["b", "a"]


def log(rows, *lines):
    head = "[m: f(): 2024-01-01 00:00:00,000] INFO: "
    return rows([("r", i, t if t.startswith("[") else head + t) for i, t in enumerate(lines)], "run string, pos int, line string")


def test_metric_lines(rows):
    lines = log(rows, "run_metrics: ETL_Duration - 1.5", "run_metrics: etl_duration - 2.5", "noise - run_metrics",
                "run_metrics: model_params - {'Depth': 5, 'Warm': True, 'x': None}", "run_metrics: test_performance - {'AUC': 0.9}",
                "run_metrics: feature_importances: [0.5, 0.25]", "run_metrics: a - b - c")
    got = {r.name: r.value for r in G.run_metrics(lines).collect()}
    assert got == {"etl_duration": "2.5", "depth": "5", "warm": "true", "x": None, "test_auc": "0.9",
                   "feature_0": "0.5", "feature_1": "0.25", "a - b": "c"}


def test_spans_keep_equal_times_and_open_spans(rows, partitions):
    at = lambda ms, name, state: f"[m: {name}(): 2024-01-01 00:00:00,{ms:03d}] INFO: Function {state}"
    lines = log(rows, at(0, "a", "Start"), at(0, "b", "Start"), at(5, "b", "End"), at(5, "c", "Start"), at(9, "c", "End"), at(9, "a", "End"),
                at(20, "d", "Start"))
    got = [(r.level, r.func, r.state, r.delta, r.elapsed) for r in G.spans(lines).orderBy("pos").collect()]
    assert got == [(1, "a()", "Start", None, 0.0), (2, "b()", "Start", None, 0.0), (2, "b()", "End", 0.005, 0.005), (2, "c()", "Start", None, 0.005),
                   (2, "c()", "End", 0.004, 0.009), (1, "a()", "End", 0.009, 0.009), (1, "d()", "Start", None, 0.02)]


def test_label_noise_rate(spark):
    import math
    df = spark.range(20000).withColumn("y", F.lit(False))
    share = X.noise_label(df, "id", "y", 0.5).agg(F.avg(F.col("y").cast("int"))).first()[0]
    assert abs(share - (1 - math.exp(-0.5))) < 0.015


@pytest.mark.parametrize("max_rows", [100, 0])
def test_merge_keeps_null_keys_and_copies(rows, max_rows):
    left = rows([(1, 1, None), (2, 1, None), (3, 2, 5)], "id int, year int, week int")
    stats = rows([(1, None, 2, 0), (1, None, 3, 1), (2, 6, 1, 2)], "year int, week int, n int, no int")
    got = L.merge_on(left, stats, ["year", "week"], max_rows)
    assert values(got, "id", "n", "no") == [(1, 2, 0), (1, 3, 1), (2, 2, 0), (2, 3, 1)]


def test_membership_table(rows):
    df = rows([("a",), ("b",), (None,)], "v string")
    got = L.in_table(df, F.col("v"), rows([("a",), ("a",)], "w string"), "w", "listed")
    assert sorted((str(r.v), r.listed) for r in got.collect()) == [("None", False), ("a", True), ("b", False)]


def test_remainder_and_sample(spark):
    df = spark.range(1000)
    sample = X.simple_sample(df, "id")
    assert sample.filter("in_sample").count() == 995
    assert L.remainder(df, sample.filter("in_sample"), "id").count() == 5


def test_noise_hits_a_fixed_share_with_shared_factors(spark):
    df = spark.range(1000).select("id", F.lit(1.0).alias("a"), F.lit(2.0).alias("b"))
    got = X.noise_features(df, "id", ["a", "b"], 0.5, 0.6)
    assert got.filter("a <> 1.0").count() == 600
    assert got.filter("abs(b - 2 * a) > 1e-12").count() == 0


def test_hash_encoder_counts(rows):
    got = M.hash_encode(rows([("x", "y"), (None, "y")], "a string, b string"), ["a", "b"], 8)
    assert all(sum(r) == 2 for r in got.collect()) and len(got.columns) == 8
