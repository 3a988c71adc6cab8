"""Splits, folds, chunks, samples and noise, all in hash order of the row key."""

from datetime import datetime

from pyspark.sql import functions as F

from sievepoint.catalog.registry import applications, query, table
from sievepoint.operators import lookup as L, reports as R, splits as X

_H = "md5(concat('{seed}:', CAST({key} AS STRING)))"


def _hash(key: str, seed: int = 42) -> str:
    return _H.format(seed=seed, key=key)


@query("stratified_holdout", f"""
WITH h AS (SELECT app_id, confirmed_fraud, {_hash("app_id")} AS h FROM applications),
s AS (SELECT confirmed_fraud, count(*) AS n, sum(count(*)) OVER () AS total FROM h GROUP BY 1),
q AS (SELECT *, CAST(ceil(0.2::DOUBLE * total) AS BIGINT) AS take, n * ceil(0.2::DOUBLE * total) / total AS q FROM s),
b AS (SELECT *, CAST(floor(q) AS BIGINT) + CAST(row_number() OVER (ORDER BY q - floor(q) DESC, confirmed_fraud)
             <= take - sum(CAST(floor(q) AS BIGINT)) OVER () AS INT) AS k FROM q),
r AS (SELECT app_id, confirmed_fraud, row_number() OVER (PARTITION BY confirmed_fraud ORDER BY h) AS rn FROM h)
SELECT app_id, rn <= k AS is_test FROM r JOIN b USING (confirmed_fraud)""")
def stratified_holdout(spark, sf):
    rows = applications(spark, sf, "app_id", "confirmed_fraud")
    return X.split_random(rows, "app_id", 0.2, "confirmed_fraud").select("app_id", "is_test")


@query("empty_holdout", "SELECT app_id, false AS is_test FROM applications")
def empty_holdout(spark, sf):
    return X.split_data(applications(spark, sf, "app_id"), key="app_id", share=0)


_FOLD = lambda n, k: f"CASE WHEN rn < ({n} % {k}) * ({n} // {k} + 1) THEN rn // ({n} // {k} + 1) ELSE (rn - {n} % {k}) // ({n} // {k}) END"


@query("shuffled_folds", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_hash("o_orderkey")}) - 1 AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST({_FOLD("n", 3)} AS INT) AS fold FROM r""")
def shuffled_folds(spark, sf):
    return X.kfold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 3)


_VALUE = "coalesce(college_id, 'nan')"


@query("holdout_by_college", f"""
WITH v AS (SELECT DISTINCT {_VALUE} AS v FROM applications),
r AS (SELECT v, row_number() OVER (ORDER BY {_hash("v")}) AS rn, count(*) OVER () AS n FROM v)
SELECT app_id, rn <= ceil(0.2::DOUBLE * n) AS is_test FROM applications JOIN r ON v = {_VALUE}""")
def holdout_by_college(spark, sf):
    rows = applications(spark, sf, "app_id", "college_id")
    return X.split_data(rows, "split_by_feature", key="app_id", column="college_id", share=0.2).drop("college_id")


@query("folds_by_college", f"""
WITH v AS (SELECT DISTINCT {_VALUE} AS v FROM applications),
r AS (SELECT v, row_number() OVER (ORDER BY {_hash("v")}) - 1 AS rn, count(*) OVER () AS n FROM v)
SELECT app_id, CAST({_FOLD("n", 3)} AS INT) AS fold FROM applications JOIN r ON v = {_VALUE}""")
def folds_by_college(spark, sf):
    rows = applications(spark, sf, "app_id", "college_id")
    return X.split_data(rows, "split_by_feature", key="app_id", column="college_id", folds=3).drop("college_id")


@query("split_at_time", "SELECT app_id, tstmp_submit >= TIMESTAMP '2024-01-20' AS is_test FROM applications")
def split_at_time(spark, sf):
    rows = applications(spark, sf, "app_id", "tstmp_submit")
    return X.split_data(rows, "split_by_time", key="app_id", ts="tstmp_submit", marker=datetime(2024, 1, 20)).drop("tstmp_submit")


@query("simple_sample", f"""
WITH r AS (SELECT app_id, row_number() OVER (ORDER BY {_hash("app_id")}) AS rn, count(*) OVER () AS n FROM applications)
SELECT app_id, rn <= round_even(0.995::DOUBLE * n, 0) AS in_sample FROM r""")
def simple_sample(spark, sf):
    return X.simple_sample(applications(spark, sf, "app_id"), "app_id")


@query("sample_remainder", f"""
WITH r AS (SELECT app_id, row_number() OVER (ORDER BY {_hash("app_id")}) AS rn, count(*) OVER () AS n FROM applications)
SELECT app_id FROM r WHERE rn > round_even(0.995::DOUBLE * n, 0)""")
def sample_remainder(spark, sf):
    rows = applications(spark, sf, "app_id")
    return L.remainder(rows, X.simple_sample(rows, "app_id").filter("in_sample"), "app_id")


_REPEAT = "md5(concat(CAST(repeat AS STRING), ':', CAST(app_id AS STRING)))"


@query("repeated_shuffle_splits", f"""
WITH m AS (SELECT app_id, repeat FROM applications, (SELECT unnest([0, 1, 2]) AS repeat)),
r AS (SELECT app_id, repeat, row_number() OVER (PARTITION BY repeat ORDER BY {_REPEAT}) AS rn,
             count(*) OVER (PARTITION BY repeat) AS n FROM m)
SELECT app_id, repeat, rn <= ceil(0.2::DOUBLE * n) AS is_test FROM r""")
def repeated_shuffle_splits(spark, sf):
    return X.shuffle_splits(applications(spark, sf, "app_id"), "app_id", 3)


@query("contiguous_folds", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST({_FOLD("n", 5)} AS INT) AS fold FROM r""")
def contiguous_folds(spark, sf):
    return X.contiguous_folds(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5)


@query("contiguous_fold_sizes", f"""
WITH r AS (SELECT row_number() OVER () - 1 AS rn, count(*) OVER () AS n FROM orders)
SELECT CAST({_FOLD("n", 5)} AS INT) AS fold, count(*) AS n_rows FROM r GROUP BY 1""")
def contiguous_fold_sizes(spark, sf):
    """A key with few values and NULLs: folds are of one size all the same."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey") % 3).alias("k"))
    return X.contiguous_folds(rows, "k", 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query("row_range_chunks", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST((SELECT max(i) FROM range(7) t(i) WHERE i * (n + 1) // 7 <= rn) AS INT) AS chunk FROM r""")
def row_range_chunks(spark, sf):
    return X.row_range_chunks(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 7)


@query("chronological_split_by_college", """
WITH r AS (SELECT app_id, college_id, row_number() OVER (PARTITION BY college_id ORDER BY tstmp_submit, app_id) AS rn,
                  count(*) OVER (PARTITION BY college_id) AS n FROM applications WHERE college_id IS NOT NULL)
SELECT app_id, college_id, rn <= floor(0.8::DOUBLE * n) AS is_train FROM r""")
def chronological_split_by_college(spark, sf):
    rows = applications(spark, sf, "app_id", "college_id", "tstmp_submit")
    return X.split_chronological(rows, "college_id", "tstmp_submit", "app_id").select("app_id", "college_id", "is_train")


@query("chronological_split_by_priority", """
WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn,
                  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderkey, rn <= floor(0.6::DOUBLE * n) AS is_train FROM r""")
def chronological_split_by_priority(spark, sf):
    """Five groups only, so every group spans many tasks."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return X.split_chronological(rows, "o_orderpriority", "o_orderdate", "o_orderkey", 0.6).select("o_orderkey", "is_train")


_WEEKS = """
o AS (SELECT o_orderkey, CAST(isoyear(o_orderdate) AS INT) AS year, CAST(week(o_orderdate) AS INT) AS week, o_orderstatus = 'F' AS late FROM orders),
g AS (SELECT year, week, count(*) AS "count", avg(CAST(late AS INT)) AS mean, row_number() OVER (ORDER BY year, week) - 1 AS slice_no FROM o GROUP BY 1, 2)"""


def _weeks(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("extract(YEAROFWEEK FROM o_orderdate)").alias("year"),
        F.weekofyear("o_orderdate").alias("week"), (F.col("o_orderstatus") == "F").alias("late"))
    return rows, R.group_rates(rows.withColumn("slice", F.col("year") * 100 + F.col("week")), ["year", "week", "slice"], "late")


@query("rolling_time_slices", f"""
WITH {_WEEKS} SELECT o_orderkey, slice_no, slice_no <= 50 AS is_train FROM o JOIN g USING (year, week) WHERE slice_no <= 52""")
def rolling_time_slices(spark, sf):
    rows, stats = _weeks(spark, sf)
    return R.rolling_split(rows, stats, ["year", "week"], ["year", "week", "slice"], 50).select("o_orderkey", "slice_no", "is_train")


@query("weekly_rates_on_rows", f"""
WITH {_WEEKS} SELECT o_orderkey, year, week, "count", mean FROM o JOIN g USING (year, week)""")
def weekly_rates_on_rows(spark, sf):
    rows, stats = _weeks(spark, sf)
    return L.merge_on(rows.drop("late"), stats.drop("slice"), ["year", "week"])


@query("union_of_parts", """
SELECT app_id, 'train' AS part, CAST(NULL AS DOUBLE) AS fraud_score FROM applications WHERE tstmp_submit < TIMESTAMP '2024-01-20'
UNION ALL SELECT app_id, 'test', fraud_score FROM applications WHERE tstmp_submit >= TIMESTAMP '2024-01-20'""")
def union_of_parts(spark, sf):
    rows = X.split_by_time(applications(spark, sf, "app_id", "tstmp_submit", "fraud_score"), "tstmp_submit", datetime(2024, 1, 20))
    train = rows.filter("not is_test").select("app_id", F.lit("train").alias("part"))
    return L.union_rows(train, rows.filter("is_test").select("app_id", F.lit("test").alias("part"), "fraud_score"))


_UNIT = lambda key, seed, stream: (f"((('0x' || substr(md5(concat('{seed}:{stream}:', CAST({key} AS STRING))), 1, 13))::BIGINT)::DOUBLE"
                                   f" + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE")


@query("feature_noise", f"""
WITH d AS (SELECT event_id, user_id, value, row_number() OVER (ORDER BY {_hash("event_id", 0)}) AS rn, count(*) OVER () AS n FROM events),
f AS (SELECT *, CASE WHEN rn <= floor(0.6::DOUBLE * n) THEN 1 + 0.5::DOUBLE * (sqrt(-2 * ln({_UNIT("event_id", 0, "a")})) * cos(2 * pi() * {_UNIT("event_id", 0, "b")})) ELSE 1 END AS f FROM d)
SELECT event_id, round(value * f, 4) + 0.0::DOUBLE AS value, round(user_id * f, 4) + 0.0::DOUBLE AS user_id FROM f""")
def feature_noise(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "value", "user_id")
    noisy = X.noise_features(rows, "event_id", ["value", "user_id"], 0.5, 0.6)
    return noisy.select("event_id", *((F.round(c, 4) + 0.0).alias(c) for c in ("value", "user_id")))


@query("label_noise", f"""
SELECT app_id, CASE WHEN {_UNIT("app_id", 0, "label")} < 1 - exp(-0.5::DOUBLE) THEN NOT confirmed_fraud ELSE confirmed_fraud END AS confirmed_fraud FROM applications""")
def label_noise(spark, sf):
    return X.noise_label(applications(spark, sf, "app_id", "confirmed_fraud"), "app_id", "confirmed_fraud", 0.5)
