from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features
from tidemark.schemas import EVENT_COLUMNS

WEEK = timedelta(days=7)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in EVENT_COLUMNS))


def ev(kind, created, ingested, user="u1", item="i1"):
    return (user, item, kind, f"2026-01-{created}Z", f"2026-01-{ingested}Z")


def test_missing_columns(spark):
    df = spark.createDataFrame([("u1",)], "user_id string")
    with pytest.raises(ValueError, match="events missing required columns: .'created_at', 'event_type'"):
        features.feature_snapshot(df)


def test_never_ingested_event_is_never_counted(spark):
    df = events(spark, ("u1", "i1", "click", "2026-01-01T00:00:00Z", None), ev("click", "02T00:00:00", "02T00:00:00"))
    rows = features.feature_rows(df).orderBy("event_timestamp", "kind").collect()
    assert [(r["kind"], r["created_timestamp"] is None, r["user_event_count_7d"]) for r in rows] == [
        (0, True, 0),
        (0, False, 0),
        (1, False, 1),
    ]
    source = features.entity_source(df, "user").orderBy("event_timestamp").collect()
    assert [r["created_timestamp"] for r in source] == [None, datetime(2026, 1, 2)]


def adversarial(spark, n, seed):
    """Few keys, coarse clocks: ties, late, future-dated and expired events all meet."""
    rng = random.Random(seed)
    start = datetime(2026, 1, 1)
    data = []
    for _ in range(n):
        created = start + timedelta(hours=rng.randrange(24 * 10), minutes=rng.choice([0, 0, 30]))
        delay = rng.choice([0, 0, 1, 30, 60, 90, -30, 60 * 24 * 6, 60 * 24 * 7, 60 * 24 * 8])
        user = "u0" if rng.random() < 0.4 else f"u{rng.randrange(1, 5)}"
        item = "i0" if rng.random() < 0.4 else f"i{rng.randrange(1, 4)}"
        kind = rng.choice(["click", "impression", "like"])
        data.append((user, item, kind, created, created + timedelta(minutes=delay)))
    schema = "user_id string, item_id string, event_type string, created_at timestamp_ntz, ingested_at timestamp_ntz"
    return data, spark.createDataFrame(data, schema)


def brute_force(data):
    """The two rules, pair by pair."""

    def counts(key, rule):
        seen = [h for h in data if rule(h) and h[0 if key == "u" else 1] == value[key]]
        return len(seen), sum(h[2] == "click" for h in seen)

    out = []
    for user, item, _, created, ingested in data:
        value = {"u": user, "i": item}
        before = lambda h: h[3] < created and h[3] > created - WEEK and h[4] <= created
        out.append((0, user, item, created, ingested, *counts("u", before), *counts("i", before)))
        if ingested >= created:
            known = lambda h: h[4] >= h[3] and h[4] <= ingested and h[3] > ingested - WEEK
            out.append((1, user, item, ingested, ingested, *counts("u", known), *counts("i", known)))
    return sorted(out)


# From chunks that hold a single instant to one that holds the whole history.
CHUNKS = [60, 3_600, 7 * 86_400, 10**9]


@pytest.mark.parametrize("seconds", CHUNKS)
def test_rows_equal_brute_force_however_time_is_cut(spark, seconds):
    data, df = adversarial(spark, 250, 3)
    got = sorted(tuple(r) for r in features.feature_rows(df, chunk_seconds=seconds).collect())
    assert got == brute_force(data)


@pytest.mark.parametrize("seconds", CHUNKS)
@pytest.mark.parametrize("entity", ["user", "item"])
def test_source_keeps_the_first_row_of_an_instant(spark, entity, seconds):
    data, df = adversarial(spark, 250, 5)
    first = {}
    at = 1 if entity == "user" else 2
    for row in sorted(brute_force(data), key=lambda r: (r[3], r[4], r[0])):
        counts = row[5:7] if entity == "user" else row[7:9]
        first.setdefault((row[at], row[3]), (row[4], *counts))
    got = features.entity_source(df, entity, seconds).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in got} == first
    assert len(got) == len(first)


def test_rows_without_a_user_or_item_stay_and_form_a_group(spark):
    data, df = adversarial(spark, 120, 7)
    data = [(None if n % 5 == 0 else user, None if n % 7 == 0 else item, *rest) for n, (user, item, *rest) in enumerate(data)]
    got = features.feature_rows(spark.createDataFrame(data, df.schema)).collect()
    texts = [tuple("" if v is None else v for v in r[:2]) + r[2:] for r in data]
    want = [tuple(None if v == "" else v for v in r) for r in brute_force(texts)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_each_entity_reads_the_events_once_and_no_window_holds_a_key(spark, tmp_path):
    """The sums of the chunks and the rows in them come from one exchange; the same plan for every key."""
    _, df = adversarial(spark, 300, 1)
    df.write.parquet(str(tmp_path / "e"))
    table = spark.read.parquet(str(tmp_path / "e"))
    for frame, entities in ((features.entity_source(table, "user"), 1), (features.feature_rows(table), 2)):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Scan parquet") == 1 and plan.count("ReusedExchange") == entities
        # Rows by key and chunk, chunk totals by key, and what these bring to their chunk.
        exchanges = plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange")
        assert exchanges == 3 * entities and "Join" not in plan
        over_points = [w for w in plan.splitlines() if "Window [" in w and "RangeFrame" in w]
        assert over_points and all("_chunk" in w for w in over_points)


def test_nothing_runs_while_a_plan_is_made(spark, tmp_path):
    _, df = adversarial(spark, 20, 2)
    df.write.parquet(str(tmp_path / "e"))
    table = spark.read.schema(df.schema).parquet(str(tmp_path / "e"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    features.feature_rows(table), features.entity_source(table, "item")
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sources_are_written_whole_and_twice_the_same(spark, tmp_path):
    _, df = adversarial(spark, 120, 11)
    for _ in range(2):
        user_path, item_path = features.write_feature_sources(df, str(tmp_path))
    expected = features.entity_source(df, "user")
    assert sorted(spark.read.parquet(user_path).collect()) == sorted(expected.collect())
    assert spark.read.parquet(item_path).columns[0] == "item_id"
    path = features.write_feature_snapshot(df, str(tmp_path / "deep" / "snapshot"))
    assert spark.read.parquet(path).count() == features.feature_snapshot(df).count()
