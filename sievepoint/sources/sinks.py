"""Saved stages, CSV dumps, run history, extract without personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# Column order of the run history.
HISTORY_COLUMNS = (
    "date", "tag", "logfile", "model", "scope", "AUC", "Accuracy", "Precision", "Recall",
    *(name for i in range(10) for name in (f"feature{i}", f"feature{i}_score")),
    "testset", "trainset",
)


def save_stage(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                            timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")


def write_result_dump(scored: DataFrame, features: list[str], path: str, y: str = "y",
                      p: str = "prob") -> None:
    """Features, label and prediction side by side: they share a row, so no join is needed."""
    write_csv(scored.select(*features, F.col(y).alias("y"), F.col(y).alias("y_actual"),
                            F.col(p).alias("y_predicted")), path)


def history_rows(results: DataFrame, importance: DataFrame | None = None, scope: str | None = "train",
                 **facts) -> DataFrame:
    """Run results in history order; training runs carry their ten strongest features.

    ``importance``: (rank, feature, score), ten rows at most.
    """
    for name, value in facts.items():
        results = results.withColumn(name, F.lit(value))
    if scope is not None:  # else the results have their own
        results = results.withColumn("scope", F.lit(scope))
    if importance is not None and scope == "train":
        for r in importance.filter("rank < 10").collect():
            results = (results.withColumn(f"feature{r['rank']}", F.lit(r.feature))
                       .withColumn(f"feature{r['rank']}_score", F.lit(r.score)))
    kind = lambda c: "double" if c.endswith("_score") or c in ("AUC", "Accuracy", "Precision", "Recall") else "string"
    return results.select(*(
        (F.col(c) if c in results.columns else F.lit(None)).cast(kind(c)).alias(c) for c in HISTORY_COLUMNS))


def append_history(rows: DataFrame, path: str) -> None:
    rows.select(*HISTORY_COLUMNS).write.mode("append").parquet(path)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """One JSON object per run and line."""
    from sievepoint.operators.logs import metrics_json
    metrics_json(metrics).select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def without_personal_data(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fixed column list; the email is reduced to its domain, NULL when it has none."""
    return df.select(*(F.get(F.split("email", "@"), F.lit(1)).alias("email") if c == "email" else F.col(c)
                       for c in columns))
