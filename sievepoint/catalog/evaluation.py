"""Quality of scores that lie in the given tables: report scores, document labels, discounts."""

from pyspark.sql import functions as F

from sievepoint.catalog.registry import applications, query, table
from sievepoint.operators import metrics as M
from sievepoint.operators.rules import decide

_SCORED = "s AS (SELECT app_id, confirmed_fraud AS y, fraud_score AS p FROM applications WHERE fraud_score IS NOT NULL)"


def _scored(spark, sf):
    rows = applications(spark, sf, "app_id", "confirmed_fraud", "fraud_score").filter("fraud_score is not null")
    return rows.select("app_id", F.col("confirmed_fraud").alias("y"), F.col("fraud_score").alias("p"))


def _evaluate_sql(scored: str, t: float) -> str:
    return f"""
WITH {scored},
g AS (SELECT p, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg FROM s GROUP BY p),
r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p) - neg / 2.0::DOUBLE AS below FROM g),
a AS (SELECT CASE WHEN sum(pos) * sum(neg) = 0 THEN -1.0::DOUBLE ELSE sum(pos * below) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) END AS auc FROM r),
c AS (SELECT count(*) FILTER (y AND p > {t}) AS tp, count(*) FILTER (NOT y AND p > {t}) AS fp,
             count(*) FILTER (y AND NOT p > {t}) AS fn, count(*) FILTER (NOT y AND NOT p > {t}) AS tn FROM s)
SELECT round(auc, 9) AS auc, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
       CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS "precision",
       (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, tp, fp, fn, tn FROM c, a"""


@query("score_evaluation", _evaluate_sql(_SCORED, 0.3))
def score_evaluation(spark, sf):
    return M.evaluate(_scored(spark, sf), "y", "p", 0.3).withColumn("auc", F.round("auc", 9))


@query("discount_evaluation", _evaluate_sql("s AS (SELECT l_returnflag = 'R' AS y, l_extendedprice AS p FROM lineitem)", 20000))
def discount_evaluation(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").alias("y"), F.col("l_extendedprice").alias("p"))
    return M.evaluate(rows, "y", "p", 20000).withColumn("auc", F.round("auc", 9))


@query("single_class_auc", f"""
WITH {_SCORED} SELECT CASE WHEN count(*) >= 0 THEN -1.0::DOUBLE END AS auc FROM s WHERE y""")
def single_class_auc(spark, sf):
    return M.auc(M.score_counts(_scored(spark, sf).filter("y"), "y", "p"))


@query("label_confusion", """
WITH c AS (SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality <> 1 AND toxic = 1) AS fp,
                  count(*) FILTER (quality = 1 AND toxic <> 1) AS fn, count(*) FILTER (quality <> 1 AND toxic <> 1) AS tn FROM labels)
SELECT tp, fp, fn, tn, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy FROM c""")
def label_confusion(spark, sf):
    return M.confusion(table(spark, sf, "labels"), "quality", F.col("toxic"))


@query("f_beta_over_repeats", """
WITH c AS (SELECT c_nationkey, count(*) FILTER (y AND q) AS tp, count(*) FILTER (NOT y AND q) AS fp,
                  count(*) FILTER (y AND NOT q) AS fn, count(*) FILTER (NOT y AND NOT q) AS tn
           FROM (SELECT c_nationkey, c_acctbal > 4000 AS y, c_mktsegment IN ('BUILDING', 'MACHINERY') AS q FROM customer) GROUP BY 1),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS pr, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS rc FROM c)
SELECT avg(tp) AS mean_tp, avg(fp) AS mean_fp, avg(fn) AS mean_fn, avg(tn) AS mean_tn,
       round(avg((tp + tn)::DOUBLE / (tp + fp + fn + tn)), 9) AS mean_accuracy, round(avg(pr), 9) AS mean_precision,
       round(avg(rc), 9) AS mean_recall, round(avg(CASE WHEN 4 * pr + rc = 0 THEN 0 ELSE 5 * pr * rc / (4 * pr + rc) END), 9) AS mean_f_beta FROM m""")
def f_beta_over_repeats(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_nationkey", (F.col("c_acctbal") > 4000).cast("int").alias("y"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("int").alias("q"))
    out = M.f_beta(rows, "c_nationkey", "y", "q", beta=2.0)
    return out.select(*("mean_" + c for c in ("tp", "fp", "fn", "tn")), *(
        F.round(f"mean_{c}", 9).alias(f"mean_{c}") for c in ("accuracy", "precision", "recall", "f_beta")))


@query("clamped_log_loss", f"""
WITH {_SCORED}, q AS (SELECT CAST(y AS INT) AS y, CASE WHEN p <= 0 THEN 1e-4::DOUBLE WHEN p >= 1 THEN 0.9999::DOUBLE ELSE p END AS p FROM s)
SELECT round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 9) AS log_loss, count(*) AS n FROM q""")
def clamped_log_loss(spark, sf):
    return M.log_loss(_scored(spark, sf), "y", "p").withColumn("log_loss", F.round("log_loss", 9))


@query("score_calibration", f"""
WITH {_SCORED} SELECT p AS pred_prob, count(*) AS "count", avg(CAST(y AS INT)) AS true_prob FROM s GROUP BY p""")
def score_calibration(spark, sf):
    return M.calibration(_scored(spark, sf), "y", "p")


@query("score_histogram", f"""
WITH {_SCORED}, e AS (SELECT min(p) AS lo, (max(p) - min(p)) / 20 AS w FROM s),
c AS (SELECT CAST(least(floor((p - lo) / w), 19) AS INT) AS bin, count(*) AS n FROM s, e GROUP BY 1)
SELECT CAST(i AS INT) AS bin, lo + i * w AS low, lo + (i + 1) * w AS high, coalesce(n, 0) AS n
FROM range(20) t(i) CROSS JOIN e LEFT JOIN c ON bin = i""")
def score_histogram(spark, sf):
    return M.histogram(_scored(spark, sf), "p")


@query("class_decisions", f"""
WITH {_SCORED} SELECT app_id, CAST(p > 0.3 AS INT) AS strict_class, CAST(p >= 0.3 AS INT) AS inclusive_class FROM s""")
def class_decisions(spark, sf):
    return _scored(spark, sf).select("app_id", decide(F.col("p")).alias("strict_class"),
                                     decide(F.col("p"), strict=False).alias("inclusive_class"))
