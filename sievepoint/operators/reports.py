"""Weekly and monthly quality tables, frequency tables, modes and top-k."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, functions as F

from sievepoint.constants import MONTHLY_REPORT, SCORE_THRESHOLD, WEEKLY_REPORT
from sievepoint.operators.ordered import row_index

REVIEWED_STATUS = (4, 5, 6)
FRAUD_STATUS = 5


def week_starts(as_of: date, n: int, lag: int = 1) -> list[date]:
    """The ``n`` Mondays up to ``lag`` weeks before the week of ``as_of - 4 days``, oldest first."""
    anchor = as_of - timedelta(days=4)
    monday = anchor - timedelta(days=anchor.weekday() + 7 * lag)
    return [monday - timedelta(days=7 * i) for i in reversed(range(n))]


def _months_back(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 - months
    return date(index // 12, index % 12 + 1, 1)


def month_starts(as_of: date, n: int, lag: int = 1, buffer_days: int = 5) -> list[date]:
    anchor = as_of - timedelta(days=buffer_days)
    return [_months_back(anchor, lag + i) for i in reversed(range(n))]


def reviewed(df: DataFrame) -> DataFrame:
    """Reviewed rows only; the label is the fraud status."""
    return (df.filter(F.col("fraud_status").isin(*REVIEWED_STATUS))
            .withColumn("confirmed_fraud", F.col("fraud_status") == FRAUD_STATUS))


def in_range(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    return df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def _midnight(day: date) -> datetime:
    return datetime.combine(day, time())


def quality_report(df: DataFrame, as_of: date, unit: str = "week", n: int | None = None,
                   lag: int = 1, buffer_days: int = 5, threshold: float = SCORE_THRESHOLD,
                   only_reviewed: bool = True, with_fp: bool = True,
                   ts: str = "tstmp_submit") -> DataFrame:
    """Counts and quality of ``fraud_score >= threshold`` per week or month.

    Every period of the calendar appears; an empty denominator gives 1. The period range is a
    literal filter, so it reaches the scan.
    """
    if unit == "week":
        starts = week_starts(as_of, n or WEEKLY_REPORT["n"], lag)
        end = starts[-1] + timedelta(days=7)
    else:
        starts = month_starts(as_of, n or MONTHLY_REPORT["n"], lag, buffer_days)
        end = _months_back(starts[-1], -1)
    rows = reviewed(df) if only_reviewed else df
    rows = in_range(rows, ts, _midnight(starts[0]), _midnight(end))
    fraud = F.coalesce(F.col("confirmed_fraud"), F.lit(False))
    marked = F.coalesce((F.col("fraud_score") >= threshold) & ~F.isnan("fraud_score"), F.lit(False))
    counted = rows.groupBy(F.date_trunc(unit, ts).cast("date").alias("period")).agg(
        F.count(F.lit(1)).alias("n_apps"), F.count_if(fraud).alias("n_fraud"),
        F.count_if(fraud & marked).alias("tp"), F.count_if(~fraud & marked).alias("fp"),
        F.count_if(fraud & ~marked).alias("fn"), F.count_if(~fraud & ~marked).alias("tn"))
    calendar = df.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(d) for d in starts))).alias("period"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    # At most one counted row per calendar period.
    full = calendar.join(F.broadcast(counted), "period", "left").select(
        "period", *(zero(c) for c in ("n_apps", "n_fraud", "tp", "fp", "fn", "tn")))

    def ratio(top, bottom):
        return F.when(bottom == 0, 1.0).otherwise(top / bottom)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    counts = ["n_apps", "n_fraud", "tp", "fp", "fn"] if with_fp else ["n_apps", "n_fraud", "tp", "fn"]
    return full.select("period", *counts, ratio(tp + tn, F.col("n_apps")).alias("accuracy"),
                       ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"))


def both_reports(df: DataFrame, as_of: date, weekly: dict | None = WEEKLY_REPORT,
                 monthly: dict | None = MONTHLY_REPORT) -> dict[str, DataFrame]:
    """The report job: a weekly and a monthly table, each unless switched off."""
    out = {}
    if weekly:
        out["weekly"] = quality_report(df, as_of, "week", **weekly)
    if monthly:
        out["monthly"] = quality_report(df, as_of, "month", **monthly)
    return out


def frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def group_rates(df: DataFrame, group: list[str], label: str) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.col(label)).alias("count"),
                                  F.avg(F.col(label).cast("double")).alias("mean"))


def most_common(df: DataFrame, column: str, position: str, k: int = 1) -> DataFrame:
    """The ``k`` most frequent values; ties go to the value that appears first."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first"))
            .orderBy(F.desc("n"), "first").limit(k))


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def rolling_split(df: DataFrame, stats: DataFrame, keys: list[str], order: list[str],
                  slice_end: int, horizon: int = 2) -> DataFrame:
    """Number the ordered groups, merge the number back, and split by it.

    Train holds groups up to ``slice_end``, test the next ``horizon``; later rows are dropped.
    """
    from sievepoint.operators.lookup import merge_on
    numbered = row_index(stats, [F.col(c) for c in order], "slice_no")
    merged = merge_on(df, numbered.drop(*(c for c in order if c not in keys)), keys)
    return (merged.filter(F.col("slice_no") <= slice_end + horizon)
            .withColumn("is_train", F.col("slice_no") <= slice_end))
