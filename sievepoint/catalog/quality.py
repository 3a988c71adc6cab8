"""Weekly and monthly quality, frequencies, modes, top-k."""

from datetime import date

from pyspark.sql import functions as F

from sievepoint.catalog.registry import applications, query, table
from sievepoint.operators import reports as R

AS_OF = date(2024, 2, 8)
_REPORT_INPUT = ("tstmp_submit", "fraud_status", "fraud_score")


def report_sql(unit: str, starts: list[date], reviewed: bool = True, fp: bool = True) -> str:
    calendar = ", ".join(f"(DATE '{d}')" for d in starts)
    label = "fraud_status = 5" if reviewed else "coalesce(confirmed_fraud, false)"
    keep = "fraud_status IN (4, 5, 6)" if reviewed else "true"
    ratio = lambda a, b: f"CASE WHEN {b} = 0 THEN 1.0::DOUBLE ELSE ({a})::DOUBLE / ({b}) END"
    return f"""
WITH calendar(period) AS (VALUES {calendar}),
marked AS (SELECT CAST(date_trunc('{unit}', tstmp_submit) AS DATE) AS period, {label} AS y,
                  coalesce(fraud_score >= 0.3, false) AS p FROM applications WHERE {keep}),
t AS (SELECT c.period, count(m.y) AS n_apps, count(*) FILTER (m.y) AS n_fraud,
             count(*) FILTER (m.y AND m.p) AS tp, count(*) FILTER (NOT m.y AND m.p) AS fp,
             count(*) FILTER (m.y AND NOT m.p) AS fn, count(*) FILTER (NOT m.y AND NOT m.p) AS tn
      FROM calendar c LEFT JOIN marked m ON c.period = m.period GROUP BY c.period)
SELECT CAST(period AS STRING) AS period, n_apps, n_fraud, tp, {"fp, " if fp else ""}fn,
       {ratio("tp + tn", "n_apps")} AS accuracy, {ratio("tp", "tp + fp")} AS "precision",
       {ratio("tp", "tp + fn")} AS recall FROM t"""


def _shown(df):
    return df.withColumn("period", F.col("period").cast("string"))


@query("weekly_quality_report", report_sql("week", R.week_starts(AS_OF, 6, 1)))
def weekly_quality_report(spark, sf):
    return _shown(R.quality_report(applications(spark, sf, *_REPORT_INPUT), AS_OF, "week", 6, 1))


@query("monthly_quality_report", report_sql("month", R.month_starts(AS_OF, 7, 0, 5)))
def monthly_quality_report(spark, sf):
    return _shown(R.quality_report(applications(spark, sf, *_REPORT_INPUT), AS_OF, "month", 7, 0, 5))


@query("training_set_weekly_report", report_sql("week", R.week_starts(AS_OF, 6, 1), reviewed=False, fp=False))
def training_set_weekly_report(spark, sf):
    rows = applications(spark, sf, "tstmp_submit", "confirmed_fraud", "fraud_score")
    return _shown(R.quality_report(rows, AS_OF, "week", 6, 1, only_reviewed=False, with_fp=False))


_BOTH = " UNION ALL ".join(
    f"SELECT '{name}' AS report, period, n_apps, n_fraud, tp, fp, fn FROM ({report_sql(unit, starts)})"
    for name, unit, starts in (("weekly", "week", R.week_starts(AS_OF, 6, 1)),
                               ("monthly", "month", R.month_starts(AS_OF, 7, 1, 5))))


@query("both_quality_reports", _BOTH)
def both_quality_reports(spark, sf):
    both = R.both_reports(applications(spark, sf, *_REPORT_INPUT), AS_OF)
    parts = [_shown(df).select(F.lit(name).alias("report"), "period", "n_apps", "n_fraud", "tp", "fp", "fn")
             for name, df in both.items()]
    return parts[0].unionByName(parts[1])


@query("week_calendar_counts", f"""
WITH calendar(week_start) AS (VALUES {", ".join(f"(DATE '{d}')" for d in R.week_starts(AS_OF, 6, 0))})
SELECT CAST(week_start AS STRING) AS week_start, count(tstmp_submit) AS n
FROM calendar LEFT JOIN applications ON tstmp_submit >= week_start AND tstmp_submit < week_start + INTERVAL 7 DAY
GROUP BY week_start""")
def week_calendar_counts(spark, sf):
    rows = applications(spark, sf, "tstmp_submit")
    starts = R.week_starts(AS_OF, 6, 0)
    calendar = spark.range(1).select(F.explode(F.array(*(F.lit(d) for d in starts))).alias("week_start"))
    counts = rows.groupBy(F.date_trunc("week", "tstmp_submit").cast("date").alias("week_start")).agg(F.count("*").alias("_n"))
    return calendar.join(counts, "week_start", "left").select(
        F.col("week_start").cast("string").alias("week_start"), F.coalesce("_n", F.lit(0)).alias("n"))


@query("reviewed_rows", """
SELECT app_id, fraud_status, fraud_status = 5 AS confirmed_fraud FROM applications WHERE fraud_status IN (4, 5, 6)""")
def reviewed_rows(spark, sf):
    return R.reviewed(applications(spark, sf, "app_id", "fraud_status"))


@query("rows_in_time_range", """
SELECT app_id, CAST(CAST(tstmp_submit AS DATE) AS STRING) AS submitted FROM applications
WHERE tstmp_submit >= TIMESTAMP '2024-01-08' AND tstmp_submit < TIMESTAMP '2024-01-15'""")
def rows_in_time_range(spark, sf):
    from datetime import datetime
    rows = R.in_range(applications(spark, sf, "app_id", "tstmp_submit"), "tstmp_submit",
                      datetime(2024, 1, 8), datetime(2024, 1, 15))
    return rows.select("app_id", F.to_date("tstmp_submit").cast("string").alias("submitted"))


@query("source_frequency", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_frequency(spark, sf):
    return R.frequency(table(spark, sf, "documents"), "source")


@query("weekly_group_rates", """
SELECT CAST(isoyear(o_orderdate) AS INT) AS year, CAST(week(o_orderdate) AS INT) AS week,
       o_orderpriority AS slice, count(*) AS "count",
       avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END) AS mean
FROM orders GROUP BY 1, 2, 3""")
def weekly_group_rates(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.expr("extract(YEAROFWEEK FROM o_orderdate)").alias("year"), F.weekofyear("o_orderdate").alias("week"),
        F.col("o_orderpriority").alias("slice"), (F.col("o_orderstatus") == "F").alias("late"))
    return R.group_rates(rows, ["year", "week", "slice"], "late")


@query("most_common_part_types", """
SELECT p_type, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY p_type ORDER BY n DESC, first LIMIT 5""")
def most_common_part_types(spark, sf):
    return R.most_common(table(spark, sf, "part"), "p_type", "p_partkey", 5)


@query("most_common_brand", """
SELECT p_brand, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY p_brand ORDER BY n DESC, first LIMIT 1""")
def most_common_brand(spark, sf):
    return R.most_common(table(spark, sf, "part"), "p_brand", "p_partkey", 1)


@query("top_orders_by_price", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_orders_by_price(spark, sf):
    return R.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                   [F.desc("o_totalprice"), F.col("o_orderkey")], 20)
