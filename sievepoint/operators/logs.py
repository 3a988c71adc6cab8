"""Run logs to metric rows and to timed spans. Input: (run, pos, line) with ``pos`` in line order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sievepoint.operators.lookup import lookup_join
from sievepoint.operators.ordered import PART, POS, in_ranges
from sievepoint.runtime import materialize

# Line formats of the run log. The header is ``[module: func(): time] LEVEL: ``; its
# parts hold no colon or bracket, which keeps the match linear in the line length.
_HEADER = r"\[([^\[\]:]+): ([^\[\]:]+): (\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3})\] INFO: "
METRIC_LINE = _HEADER + r"run_metrics: (?:(.*) - (.*)|(feature_importances): (.*))"
SPAN_LINE = _HEADER + r"Function (.*)"
METRIC_MARK, SPAN_MARK = "] INFO: run_metrics: ", "] INFO: Function "
STAMP = "yyyy-MM-dd HH:mm:ss,SSS"
PREFIXED = {"model_params": "", "train_performance": "train_", "test_performance": "test_"}
LISTED = "feature_importances"
# Lines in one range of the order, and so about as many in a task that sorts them.
RANGE_LINES = 200_000


_CUT = "\x01"
_CELLS = "array<struct<name:string,value:string>>"


def _groups(line: Column, pattern: str, n: int) -> Column:
    """All groups of the leftmost match from one pass of the pattern; one part when there is none."""
    marked = F.regexp_replace(line, f"^.*?{pattern}.*$", _CUT.join(f"${i}" for i in range(1, n + 1)))
    return F.split(marked, _CUT)


def _as_json(literal: Column) -> Column:
    """Python literals to JSON words, before any lower-casing."""
    text = F.regexp_replace(literal, r"\bTrue\b", "true")
    text = F.regexp_replace(text, r"\bFalse\b", "false")
    return F.regexp_replace(text, r"\bNone\b", "null")


def run_metrics(lines: DataFrame) -> DataFrame:
    """(run, name, value): dict metrics flattened under a prefix, list metrics numbered.

    Of equal names in one run the last line wins.
    """
    raw, m = F.col("line"), F.col("_m")
    found = (lines.filter(raw.contains(METRIC_MARK))
             .select("run", "pos", _groups(raw, METRIC_LINE, 7).alias("_m"))
             .select("run", "pos", (F.size(m) > 1).alias("matched"),
                     F.lower(F.concat(F.get(m, F.lit(3)), F.get(m, F.lit(5)))).alias("name"),
                     F.concat(F.get(m, F.lit(4)), F.get(m, F.lit(6))).alias("value")))
    pairs = F.map_entries(F.from_json(_as_json(F.col("value")), "map<string,string>"))
    prefix = F.lit("")
    for metric, text in PREFIXED.items():
        prefix = F.when(F.col("name") == metric, text).otherwise(prefix)
    cell = lambda k, v: F.struct(F.lower(k).alias("name"), F.lower(v).alias("value"))
    flat = F.transform(pairs, lambda e: cell(F.concat(prefix, e["key"]), e["value"]))
    items = F.from_json(_as_json(F.col("value")), "array<string>")
    listed = F.transform(items, lambda v, i: cell(F.concat(F.lit("feature_"), i.cast("string")), v))
    single = F.array(cell(F.col("name"), F.col("value")))
    cells = (F.when(~F.col("matched"), F.array().cast(_CELLS)).when(F.col("name").isin(*PREFIXED), flat)
             .when(F.col("name") == LISTED, listed).otherwise(single))
    exploded = found.select("run", "pos", F.posexplode(cells).alias("_i", "_c"))
    return (exploded.groupBy("run", F.col("_c.name").alias("name"))
            .agg(F.max_by("_c.value", F.struct("pos", "_i")).alias("value")))


def metrics_json(metrics: DataFrame) -> DataFrame:
    """One JSON object per run, keys sorted."""
    entries = F.sort_array(F.collect_list(F.struct("name", "value")))
    return metrics.groupBy("run").agg(F.to_json(F.map_from_entries(entries)).alias("json"))


def _span_events(lines: DataFrame) -> DataFrame:
    """The span lines in ranges of the order (run, pos), parsed where they arrive: a shuffle of lines costs less than parsing twice.

    Lines are counted first. Where a shuffle's partitions would be too few, there are as many ranges as keep each short, and as many
    partitions of runs by range.
    """
    kept = lines.filter(F.col("line").contains(SPAN_MARK)).select("run", "pos", "line")
    parts = math.ceil(kept.count() / RANGE_LINES)
    more = parts > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = in_ranges(kept, [F.col("run"), F.col("pos")], parts if more else None)
    m = F.col("_m")
    events = (ranged.select("run", "pos", PART, POS, _groups(F.col("line"), SPAN_LINE, 4).alias("_m"))
            .select("run", "pos", PART, POS, F.get(m, F.lit(1)).alias("func"),
                    F.try_to_timestamp(F.get(m, F.lit(2)), F.lit(STAMP)).alias("ts"),
                    F.get(m, F.lit(3)).alias("state"), F.struct("run").alias("_g")))
    return events.repartition(parts, PART, "_g") if more else events


def spans(lines: DataFrame) -> DataFrame:
    """Every span event with its nesting level, its duration at the end, and the time since the
    first event of the run. Times are in seconds; a start has no duration.

    One ordered pass. Inside a range, levels count from the range's own beginning, and ends meet their starts there. What a range
    leaves for others is small: for each run its change of depth and first time, and for runs that go over an edge of ranges
    the last start of every level, for ends whose start lies in an earlier range. An end takes the last start of
    its level, also where a log lacks an end.
    """
    starts = F.col("state") == "Start"
    here = W.partitionBy(PART, "_g").orderBy(POS).rowsBetween(W.unboundedPreceding, W.currentRow)
    level = F.sum(F.when(starts, 1).otherwise(-1)).over(here) + F.when(starts, 0).otherwise(1)
    of_level = W.partitionBy(PART, "_g", "_level").orderBy(POS).rowsBetween(W.unboundedPreceding, W.currentRow)
    events = _span_events(lines).filter(F.col("state").isNotNull()).withColumn("_level", level)
    local = materialize(events.withColumn("_opened", F.last(F.when(starts, F.col("ts")), ignorenulls=True).over(of_level)))

    # One row for each run in each range.
    run = W.partitionBy("_g")
    before = run.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    change = F.max_by(F.when(starts, F.col("_level")).otherwise(F.col("_level") - 1), POS)
    parts = materialize(local.groupBy(PART, "_g").agg(change.alias("_change"), F.min("ts").alias("_min")).select(
        PART, "_g", F.coalesce(F.sum("_change").over(before), F.lit(0)).alias("_base"), F.min("_min").over(run).alias("_first"),
        (F.count(F.lit(1)).over(run) > 1).alias("_over")))
    # Runs over an edge of ranges: two at most for each range.
    edges = lookup_join(local, parts.where("_over").select(PART, "_g", F.col("_base").alias("_from")), [PART, "_g"]).where("_from IS NOT NULL")
    asked = edges.where(starts | F.col("_opened").isNull()).groupBy(PART, "_g", "_level").agg(
        F.first("_from").alias("_from"), F.max_by("ts", F.when(starts, F.col(POS))).alias("_start"))
    earlier = W.partitionBy("_g", F.col("_level") + F.col("_from")).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    carried = materialize(asked.select(PART, "_g", "_level", F.last("_start", ignorenulls=True).over(earlier).alias("_carried")).where("_carried IS NOT NULL"))

    joined = lookup_join(lookup_join(local, parts.drop("_over"), [PART, "_g"]), carried, [PART, "_g", "_level"])
    micros = lambda a, b: (F.unix_micros(b) - F.unix_micros(a)) / F.lit(1e6)
    return joined.select(
        "run", "pos", (F.col("_level") + F.col("_base")).alias("level"), "func", "state", "ts",
        F.when(~starts, micros(F.coalesce("_opened", "_carried"), F.col("ts"))).alias("delta"),
        micros(F.col("_first"), F.col("ts")).alias("elapsed"))
