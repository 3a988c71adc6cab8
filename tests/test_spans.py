"""Spans against a plain stack, over any number of ranges."""

import random
from datetime import datetime, timedelta

import pytest

from sievepoint.operators import logs
from sievepoint.operators.logs import spans


def made(seed):
    pick, out, at = random.Random(seed), [], datetime(2024, 1, 1)
    for run in ("a", "b", None, "hot"):
        depth = 0
        for pos in range(400 if run == "hot" else pick.choice([0, 7, 60])):
            start = depth == 0 or pick.random() < 0.5
            depth += 1 if start else -1
            at += timedelta(milliseconds=pick.choice([0, 1, 40, 5000]))
            out.append((run, pos, at, "Start" if start else "End"))
            if pick.random() < 0.1:
                out.append((run, pos + 0.5, at, None))  # a line without a span
    # In one run nothing ends: every line is a level deeper.
    out += [("deep", float(p), at + timedelta(seconds=p), "Start") for p in range(50)]
    return [(run, float(pos), ts, state) for run, pos, ts, state in out]


def plain(events):
    out, depth, last, first = [], {}, {}, {}
    for run, pos, ts, state in events:
        if state is None:
            continue
        first.setdefault(run, ts)
        if state == "Start":
            depth[run] = depth.get(run, 0) + 1
            last[run, depth[run]] = ts
            level, delta = depth[run], None
        else:
            level = depth.get(run, 0)
            depth[run] = level - 1
            delta = (ts - last[run, level]).total_seconds() if (run, level) in last else None
        out.append((run, pos, level, state, delta, (ts - first[run]).total_seconds()))
    return out


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_spans(spark, rows, ranges):
    events = made(ranges)
    lines = [(run, pos, f"[mod.py: work(): {ts:%Y-%m-%d %H:%M:%S},{ts.microsecond // 1000:03d}] INFO: " + (f"Function {state}" if state else "other"))
             for run, pos, ts, state in events]
    random.Random(1).shuffle(lines)
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r.run, r.pos, r.level, r.state, r.delta, r.elapsed) for r in spans(rows(lines, "run string, pos double, line string")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got, key=str) == sorted(plain(events), key=str)


def test_no_range_grows_with_the_lines(spark, monkeypatch):
    """One run of many lines, and lines of many runs: ranges stay short, and the spans are those of few ranges."""
    def lines(n):
        state, stamp = "if(id % 2 = 0, 'Start', 'End')", "date_format(timestamp_millis(1700000000000 + id * 7), 'yyyy-MM-dd HH:mm:ss,SSS')"
        return spark.range(n).selectExpr("if(id < 1500, 0, id div 20) AS run", "id AS pos", f"concat('[m.py: f(): ', {stamp}, '] INFO: Function ', {state}) AS line")
    want = sorted(map(tuple, spans(lines(4000)).collect()), key=str)
    monkeypatch.setattr(logs, "RANGE_LINES", 100, raising=False)
    sizes = [r["count"] for r in logs._span_events(lines(4000)).groupBy("_part").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 250
    assert sorted(map(tuple, spans(lines(4000)).collect()), key=str) == want
