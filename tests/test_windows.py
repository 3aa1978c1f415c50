from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.operators import envelopes, windows

BASE = 1_800_000_000


def judged(spark, events, bound_ms=windows.OUT_OF_ORDER_MS, run_length=windows.RUN_LENGTH):
    """events: (user, type, second) in arrival order."""
    rows = [(i, u, t, (BASE + s) * 1000) for i, (u, t, s) in enumerate(events)]
    df = spark.createDataFrame(rows, "seq long, user_id string, event_type string, ms long")
    return windows.judge(windows.arrival_watermark(df, bound_ms=bound_ms, run_length=run_length))


def counts(df):
    rows = windows.tumbling_counts(df).withColumn("s", F.unix_seconds(F.col("window_start").cast("timestamp"))).collect()
    return {(r["event_type"], r["s"] - BASE): r["n"] for r in rows}


def late(df):
    return sorted(r["user_id"] for r in windows.late_events(df).collect())


def test_malformed_lines_are_filtered_first(spark):
    def line(kind, second):
        return f'{{"user_id":"u","item_id":"i","event_type":"{kind}","created_at":"2027-01-15T08:00:0{second}Z"}}'

    df = spark.createDataFrame([(0, "{not json"), (1, line("share", 1)), (2, line("hover", 2))], "seq long, value string")
    events = envelopes.parse_events(df).withColumn("ms", F.unix_millis("created_at"))
    assert counts(windows.judge(windows.arrival_watermark(events))) == {("share", 0): 1}


def test_lateness_boundary(spark):
    # The window [0, 10) closes at 9.999 and is kept for five more seconds of watermark.
    kept = judged(spark, [("a", "click", 14), ("b", "click", 5)], bound_ms=0)
    assert late(kept) == []
    rows = [(0, "a", "click", BASE * 1000 + 14_999), (1, "b", "click", BASE * 1000 + 5_000)]
    df = spark.createDataFrame(rows, "seq long, user_id string, event_type string, ms long")
    assert late(windows.judge(windows.arrival_watermark(df, bound_ms=0))) == ["b"]


def test_refire_counts(spark):
    df = judged(spark, [("a", "click", 5), ("b", "click", 12), ("c", "click", 6), ("d", "click", 7)], bound_ms=0)
    rows = windows.window_firings(df).collect()
    by_n = {r["final_n"]: r["firings"] for r in rows}
    # [0, 10): fired when b came, then again for c and for d. [10, 20): fires once at the end.
    assert by_n == {3: 3, 1: 1}


def test_lines(spark):
    lines = [r["line"] for r in windows.count_lines(windows.tumbling_counts(judged(spark, [("a", "click", 3)]))).collect()]
    assert lines == ["click count=1 window=[1800000000s..1800000010s)"]


def test_run_length_does_not_change_the_watermark(spark):
    rng = random.Random(7)
    events = [(f"u{i}", "click", i // 3 - rng.choice([0, 0, 0, 4, 60])) for i in range(500)]
    expected, peak = [], None
    for i, (_, _, s) in enumerate(events):
        expected.append((i, None if peak is None else (BASE + peak) * 1000 - 2000))
        peak = s if peak is None else max(peak, s)
    for run_length in (1, 7, 64, 1000):
        got = [(r["seq"], r["watermark_ms"]) for r in judged(spark, events, run_length=run_length).orderBy("seq").collect()]
        assert got == expected
