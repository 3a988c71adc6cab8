"""Classifier quality: confusion counts, exact AUC, log loss, calibration, histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.operators.ordered import running_total
from sievepoint.operators.rules import decide
from sievepoint.runtime import materialize


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top / bottom)


def confusion_counts(y: Column, predicted: Column) -> list[Column]:
    hit, said = y.cast("int") == 1, predicted.cast("int") == 1
    return [F.count_if(hit & said).alias("tp"), F.count_if(~hit & said).alias("fp"),
            F.count_if(hit & ~said).alias("fn"), F.count_if(~hit & ~said).alias("tn")]


def confusion(df: DataFrame, y: str, predicted: Column) -> DataFrame:
    """Counts and accuracy of a 0/1 prediction, one row."""
    counted = df.agg(*confusion_counts(F.col(y), predicted))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counted.select("*", _ratio(F.col("tp") + F.col("tn"), n).alias("accuracy"))


def score_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """Positives and negatives per distinct score; the base of AUC and of the threshold counts."""
    hit = F.col(y).cast("int") == 1
    return (df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(F.col(p).alias("p"))
            .agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")))


def auc(counts: DataFrame) -> DataFrame:
    """Exact area under the ROC curve: a pair with tied scores counts one half; -1 for one class."""
    ranked = running_total(counts, [F.col("p")], F.col("neg"), "neg_to")
    below = F.col("neg_to") - F.col("neg") / 2
    sums = ranked.agg(F.sum(F.col("pos").cast("double") * below).alias("_wins"),
                      F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    pairs = F.col("_p").cast("double") * F.col("_n")
    return sums.select(F.when(F.coalesce(pairs, F.lit(0)) == 0, -1.0)
                       .otherwise(F.col("_wins") / pairs).alias("auc"))


def evaluate(df: DataFrame, y: str, p: str, threshold: float = 0.5, strict: bool = True) -> DataFrame:
    """One row: AUC, recall, precision, accuracy and confusion counts; 0 for an empty denominator."""
    counts = materialize(score_counts(df, y, p))
    over = decide(F.col("p"), threshold, strict) == 1
    zero = F.lit(0).cast("long")
    total = lambda c, keep: F.coalesce(F.sum(F.when(keep, F.col(c))), zero)
    tallied = counts.agg(total("pos", over).alias("tp"), total("neg", over).alias("fp"),
                         total("pos", ~over).alias("fn"), total("neg", ~over).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return tallied.select(
        auc(counts).scalar().alias("auc"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        "tp", "fp", "fn", "tn")


def evaluate_groups(df: DataFrame, groups: list[str], y: str, p: str, threshold: float = 0.5, strict: bool = True,
                    weight: str | None = None) -> DataFrame:
    """What ``evaluate`` gives, for every group at once: one ordered pass over the distinct scores of all of them.

    With ``weight`` a row stands for so many.
    """
    hit, times = F.col(y).cast("int") == 1, F.col(weight) if weight else F.lit(1)
    counts = materialize(df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*groups, F.col(p).alias("p"))
                         .agg(F.sum(F.when(hit, times).otherwise(0)).cast("long").alias("pos"),
                              F.sum(F.when(hit, 0).otherwise(times)).cast("long").alias("neg")))
    over = decide(F.col("p"), threshold, strict) == 1
    below = F.col("neg_to") - F.col("neg") / 2
    total = lambda c, keep: F.sum(F.when(keep, F.col(c)).otherwise(0))
    ranked = running_total(counts, [F.col("p")], F.col("neg"), "neg_to", groups)
    sums = ranked.groupBy(*groups).agg(
        F.sum(F.col("pos").cast("double") * below).alias("_wins"), total("pos", over).alias("tp"), total("neg", over).alias("fp"),
        total("pos", ~over).alias("fn"), total("neg", ~over).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    pairs = (tp + fn).cast("double") * (fp + tn)
    return sums.select(
        *groups, F.when(pairs == 0, -1.0).otherwise(F.col("_wins") / pairs).alias("auc"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), "tp", "fp", "fn", "tn")

def f_beta(df: DataFrame, repeat: str, y: str, predicted: str, beta: float = 1.0) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F-beta, averaged over the repeats."""
    per = df.groupBy(repeat).agg(*confusion_counts(F.col(y), F.col(predicted)))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    per = per.withColumn("precision", _ratio(tp, tp + fp)).withColumn("recall", _ratio(tp, tp + fn))
    weight = F.lit(float(beta) ** 2)
    pr, rc = F.col("precision"), F.col("recall")
    per = (per.withColumn("accuracy", _ratio(tp + tn, tp + fp + fn + tn))
           .withColumn("f_beta", _ratio((1 + weight) * pr * rc, weight * pr + rc)))
    names = ("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f_beta")
    return per.agg(*(F.avg(c).alias(f"mean_{c}") for c in names))


def log_loss(df: DataFrame, y: str, p: str) -> DataFrame:
    """Mean log loss; a probability at or past an end is moved to 1e-4 or 0.9999."""
    q = F.when(F.col(p) <= 0, 1e-4).when(F.col(p) >= 1, 0.9999).otherwise(F.col(p))
    hit = F.col(y).cast("double")
    return df.agg((-F.avg(hit * F.ln(q) + (1 - hit) * F.ln(1 - q))).alias("log_loss"),
                  F.count(F.lit(1)).alias("n"))


def calibration(df: DataFrame, y: str, p: str) -> DataFrame:
    """Rows and true rate per distinct predicted probability."""
    return df.groupBy(F.col(p).alias("pred_prob")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(F.col(y).cast("double")).alias("true_prob"))


def histogram(df: DataFrame, p: str, bins: int = 20) -> DataFrame:
    """Equal bins from the least to the greatest value, the last one closed; empty bins appear."""
    low, high = df.agg(F.min(p), F.max(p)).first()
    spark = df.sparkSession
    if low is None:
        return spark.range(0).select(F.lit(0).alias("bin"), F.lit(0.0).alias("low"),
                                     F.lit(0.0).alias("high"), F.lit(0).cast("long").alias("n"))
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    number = F.least(F.floor((F.col(p) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = df.filter(F.col(p).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    # At most one counted row per bin.
    return edges.join(F.broadcast(counted), "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("_n", F.lit(0)).alias("n"))
