"""Run logs composed from the event table: one run per user, a few lines per event."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sievepoint.catalog.registry import query, table
from sievepoint.operators import logs as G
from sievepoint.runtime import state_dir
from sievepoint.sources import readers as S, sinks as W

_HEAD = "concat('[', event_type, '.py: work(): ', {stamp}, '] INFO: ')"


def _stamp(step: int) -> str:
    return f"date_format(timestampadd(MILLISECOND, {step}, ts), 'yyyy-MM-dd HH:mm:ss,SSS')"


def metric_lines(spark, sf):
    body = """CASE event_id % 6
        WHEN 0 THEN concat('run_metrics: etl_duration - ', CAST(event_id % 89 AS STRING))
        WHEN 1 THEN concat('run_metrics: model_params - {\\'max_depth\\': ', CAST(event_id % 7 AS STRING), ', \\'Warm\\': True}')
        WHEN 2 THEN concat('run_metrics: train_performance - {\\'AUC\\': ', CAST(event_id % 11 AS STRING), ', \\'Recall\\': None}')
        WHEN 3 THEN concat('run_metrics: feature_importances: [', CAST(event_id % 5 AS STRING), ', ', CAST(event_id % 3 AS STRING), ']')
        WHEN 4 THEN concat('run_metrics: Model_Type - Kind - ', upper(event_type))
        ELSE 'Loading data' END"""
    head = _HEAD.format(stamp=_stamp(0))
    return table(spark, sf, "events").selectExpr("user_id AS run", "event_id AS pos", f"concat({head}, {body}) AS line")


_METRICS = """
WITH cells AS (
  SELECT user_id AS run, event_id AS pos, 'etl_duration' AS name, CAST(event_id % 89 AS STRING) AS value FROM events WHERE event_id % 6 = 0
  UNION ALL SELECT user_id, event_id, 'max_depth', CAST(event_id % 7 AS STRING) FROM events WHERE event_id % 6 = 1
  UNION ALL SELECT user_id, event_id, 'warm', 'true' FROM events WHERE event_id % 6 = 1
  UNION ALL SELECT user_id, event_id, 'train_auc', CAST(event_id % 11 AS STRING) FROM events WHERE event_id % 6 = 2
  UNION ALL SELECT user_id, event_id, 'train_recall', NULL FROM events WHERE event_id % 6 = 2
  UNION ALL SELECT user_id, event_id, 'feature_0', CAST(event_id % 5 AS STRING) FROM events WHERE event_id % 6 = 3
  UNION ALL SELECT user_id, event_id, 'feature_1', CAST(event_id % 3 AS STRING) FROM events WHERE event_id % 6 = 3
  UNION ALL SELECT user_id, event_id, 'model_type - kind', event_type FROM events WHERE event_id % 6 = 4),
last AS (SELECT *, row_number() OVER (PARTITION BY run, name ORDER BY pos DESC) AS rn FROM cells)"""


@query("run_metric_rows", _METRICS + " SELECT run, name, value FROM last WHERE rn = 1")
def run_metric_rows(spark, sf):
    return G.run_metrics(metric_lines(spark, sf))


@query("collated_metric_files", _METRICS + """
SELECT max(value) FILTER (name = 'etl_duration') AS etl_duration, max(value) FILTER (name = 'max_depth') AS max_depth,
       max(value) FILTER (name = 'model_type - kind') AS kind FROM last WHERE rn = 1 GROUP BY run""")
def collated_metric_files(spark, sf):
    """Metric rows to one JSON object per run, and the objects back to one table."""
    path = f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"
    W.write_metrics_json(G.run_metrics(metric_lines(spark, sf)), path)
    found = S.collate_metrics(spark, path, one_per_file=False)
    return found.select("etl_duration", "max_depth", F.col("`model_type - kind`").alias("kind"))


def span_lines(spark, sf):
    """Each event opens an outer and an inner span; every third opens one more inside."""
    deep = "event_id % 3 = 0"
    steps = [("Start", "outer", "true"), ("Start", "inner", "true"), ("Start", "core", deep), ("End", "core", deep),
             ("End", "inner", "true"), ("End", "outer", "true")]
    cells = ", ".join(
        f"struct({i} AS i, {keep} AS keep, concat('[mod.py: {func}(): ', {_stamp(i * 40)}, '] INFO: Function {state}') AS line)"
        for i, (state, func, keep) in enumerate(steps))
    rows = table(spark, sf, "events").selectExpr("user_id AS run", "event_id", f"explode(array({cells})) AS c")
    return rows.filter("c.keep").selectExpr("run", "event_id * 10 + c.i AS pos", "c.line AS line")


@query("nested_spans", """
WITH k(i, state, func, step) AS (VALUES (0, 'Start', 'outer', 1), (1, 'Start', 'inner', 1), (2, 'Start', 'core', 1),
                                        (3, 'End', 'core', -1), (4, 'End', 'inner', -1), (5, 'End', 'outer', -1)),
l AS (SELECT user_id AS run, event_id * 10 + i AS pos, func, state, step, date_trunc('millisecond', ts + to_milliseconds(i * 40)) AS t
      FROM events, k WHERE event_id % 3 = 0 OR func <> 'core'),
d AS (SELECT *, sum(step) OVER (PARTITION BY run ORDER BY pos) - CASE WHEN step < 0 THEN step ELSE 0 END AS level FROM l),
p AS (SELECT *, lag(t) OVER (PARTITION BY run, level ORDER BY pos) AS opened, min(t) OVER (PARTITION BY run) AS first FROM d)
SELECT run, pos, CAST(level AS BIGINT) AS level, func || '()' AS func, state,
       CASE WHEN state = 'End' THEN date_diff('microsecond', opened, t) / 1e6 END AS delta,
       date_diff('microsecond', first, t) / 1e6 AS elapsed FROM p""")
def nested_spans(spark, sf):
    return G.spans(span_lines(spark, sf)).drop("ts")


@query("log_file_lines", """
SELECT count(*) AS n_lines, count(*) FILTER (event_id % 6 <> 5) AS n_metrics FROM events""")
def log_file_lines(spark, sf):
    """The lines as text files, read back with their file and order."""
    path = f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"
    metric_lines(spark, sf).select("line").write.text(path)
    return S.read_log_lines(spark, path).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("line").contains("run_metrics")).alias("n_metrics"))
