from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, features, online
from tidemark.plans import registry

CHUNKS = [60, 3_600, 10**9]
USER_CLICKS = "user_interaction_features:user_click_count_7d"
ITEM_CLICKS = "item_interaction_features:item_click_count_7d"
EVENT_SCHEMA = "user_id string, item_id string, event_type string, created_at timestamp, ingested_at timestamp"


def store_of(events):
    store = registry.FeatureRegistry()
    for view in registry.RANKING.views:
        store.apply(view, features.entity_source(events, view.entity.name))
    return store


def clock(hour, minute=0, second=0, day=3):
    return datetime(2031, 3, day, hour, minute, second)


@pytest.fixture
def events(spark):
    rows = [
        ("ann", "lamp", "click", clock(8), clock(9, 30)),
        ("bob", "sofa", "share", clock(10), clock(10, 0, 20)),
        ("ann", "sofa", "click", clock(12), clock(12, 10)),
    ]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_each_entity_is_looked_up_by_itself_and_other_columns_pass(spark, events):
    asked = spark.createDataFrame(
        [("bob", "lamp", clock(0, day=5), 7)], "user_id string, item_id string, event_timestamp timestamp, label long"
    )
    row = store_of(events).historical(asked, [USER_CLICKS, ITEM_CLICKS]).first()
    assert (row["user_click_count_7d"], row["item_click_count_7d"], row["label"]) == (0, 1, 7)


def test_an_event_counts_from_its_arrival(spark, events):
    expected = {
        ("ann", "lamp", clock(7, 59, 59)): (None, None),
        ("ann", "lamp", clock(9, 29, 59)): (0, 0),
        ("ann", "lamp", clock(9, 30)): (1, 1),
        ("ann", "sofa", clock(12, 5)): (1, 0),
        ("ann", "sofa", clock(12, 10)): (2, 1),
    }
    asked = spark.createDataFrame(list(expected), "user_id string, item_id string, event_timestamp timestamp")
    rows = store_of(events).historical(asked, [USER_CLICKS, ITEM_CLICKS]).collect()
    got = {tuple(r[:3]): (r["user_click_count_7d"], r["item_click_count_7d"]) for r in rows}
    assert got == expected


def feature_table(spark, rows):
    return spark.createDataFrame(
        rows, "k string, event_timestamp timestamp, created_timestamp timestamp, a long, b long"
    )


def asked_at(spark, *rows):
    return spark.createDataFrame(list(rows), "n long, k string, event_timestamp timestamp")


def join(asked, table, seconds=3_600):
    joined = asof.as_of_join(asked, table, "k", ("a", "b"), timedelta(days=7), chunk_seconds=seconds)
    return {r["n"]: (r["a"], r["b"]) for r in joined.collect()}


@pytest.mark.parametrize("seconds", CHUNKS)
def test_both_ends_of_the_ttl_count(spark, seconds):
    day = datetime(2026, 1, 1)
    table = feature_table(spark, [("x", day, day, 1, 10)])
    week = timedelta(days=7)
    asked = asked_at(
        spark,
        (0, "x", day),
        (1, "x", day + week),
        (2, "x", day + week + timedelta(microseconds=1)),
        (3, "x", day - timedelta(microseconds=1)),
        (4, "y", day),
    )
    assert join(asked, table, seconds) == {0: (1, 10), 1: (1, 10), 2: (None, None), 3: (None, None), 4: (None, None)}


@pytest.mark.parametrize("seconds", CHUNKS)
def test_row_created_last_wins_and_null_features_are_values(spark, seconds):
    day = datetime(2026, 1, 1)
    later = timedelta(hours=1)
    table = feature_table(
        spark,
        [
            ("x", day, day + later, 2, 20),
            ("x", day, day, 1, 10),
            ("x", day, None, 0, 0),
            ("x", day + later, day, None, 30),
        ],
    )
    asked = asked_at(spark, (0, "x", day), (1, "x", day + later))
    assert join(asked, table, seconds) == {0: (2, 20), 1: (None, 30)}


@pytest.mark.parametrize("seconds", CHUNKS)
def test_random_rows_equal_brute_force(spark, seconds):
    rng = random.Random(13)
    start = datetime(2026, 1, 1)

    def moment():
        return start + timedelta(minutes=30 * rng.randrange(48 * 20))

    key = lambda: "k0" if rng.random() < 0.5 else f"k{rng.randrange(1, 4)}"
    table_rows = [(key(), moment(), moment(), i, -i) for i in range(80)]
    asked_rows = [(i, key(), moment()) for i in range(200)]
    asked_rows += [(200 + i, "k0", asked_rows[0][2]) for i in range(20)]
    expected = {}
    for n, k, at in asked_rows:
        hits = [f for f in table_rows if f[0] == k and at - timedelta(days=7) <= f[1] <= at]
        best = max(hits, key=lambda f: (f[1], f[2]), default=None)
        expected[n] = (None, None) if best is None else best[3:]
    assert join(asked_at(spark, *asked_rows), feature_table(spark, table_rows), seconds) == expected


@pytest.mark.parametrize("seconds", CHUNKS)
def test_rows_without_a_key_meet_nothing_and_share_no_task(spark, seconds):
    day = datetime(2026, 1, 1)
    table = feature_table(spark, [("x", day, day, 1, 10), (None, day, day, 2, 20), ("\0" + "0", day, day, 3, 30)])
    asked = asked_at(spark, *[(n, None if n % 2 else "x", day) for n in range(40)]).repartition(4, "n")
    assert join(asked, table, seconds) == {n: (None, None) if n % 2 else (1, 10) for n in range(40)}
    joined = asof.as_of_join(asked, table, "k", ("a",), timedelta(days=7), chunk_seconds=seconds)
    assert "SPARK_PARTITION_ID" in joined._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_time_meet_nothing_and_stay(spark):
    day = datetime(2026, 1, 1)
    table = feature_table(spark, [("x", day, day, 1, 10), ("x", None, day, 2, 20), ("y", None, day, 3, 30)])
    asked = asked_at(spark, (0, "x", None), (1, "x", day), (2, "y", day), (3, None, None))
    assert join(asked, table) == {0: (None, None), 1: (1, 10), 2: (None, None), 3: (None, None)}


def test_joined_rows_come_from_one_scan_of_each_input_in_chunks(spark, tmp_path):
    rng = random.Random(21)
    start = datetime(2026, 1, 1)
    rows = []
    for _ in range(300):
        created = start + timedelta(minutes=10 * rng.randrange(2000))
        delay = timedelta(minutes=rng.choice([0, 3, 60]))
        rows.append((f"u{rng.randrange(6)}", f"i{rng.randrange(5)}", rng.choice(["click", "like"]), created, created + delay))
    path = str(tmp_path / "e")
    spark.createDataFrame(rows, EVENT_SCHEMA).write.parquet(path)
    events = spark.read.parquet(path)
    asked = events.selectExpr("user_id", "item_id", "created_at AS event_timestamp", "event_type")
    joined = store_of(events).historical(asked, [USER_CLICKS])
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Once for the source, once for the rows that ask; no pair is formed.
    assert plan.count("Scan parquet") == 2 and "Join" not in plan
    carried = [w for w in plan.splitlines() if "Window [" in w and "last(_found" in w]
    assert carried and all("_chunk" in w for w in carried)


# Registry ---------------------------------------------------------------------------------------------


def test_references_are_checked(spark, events):
    store = store_of(events)
    with pytest.raises(LookupError, match="other is not registered"):
        store.resolve(["other:user_click_count_7d"])
    with pytest.raises(LookupError, match="user_interaction_features:nope is not registered"):
        store.resolve(["user_interaction_features:nope"])
    assert [v.name for v, _ in store.resolve(registry.RANKING)] == [v.name for v in registry.RANKING.views]


def test_sources_are_checked_when_applied(spark, events):
    source = features.entity_source(events, "user")
    store = registry.FeatureRegistry()
    with pytest.raises(ValueError, match="user_interaction_features missing required columns"):
        store.apply(registry.USER_VIEW, source.drop("user_click_count_7d"))
    with pytest.raises(TypeError, match="join key user_id must be string"):
        store.apply(registry.USER_VIEW, source.withColumn("user_id", F.lit(1)))
    with pytest.raises(TypeError, match="features must be bigint"):
        store.apply(registry.USER_VIEW, source.withColumn("user_click_count_7d", F.lit(1.0)))


# Online -----------------------------------------------------------------------------------------------


def test_materialized_values_are_read_by_independent_keys(spark, tmp_path):
    end = clock(12, day=9)
    hour = timedelta(hours=1)
    rows = [
        ("ann", "lamp", "click", end - 70 * hour, end - 69 * hour),
        ("ann", "lamp", "click", end - 2 * hour, end - hour),
        ("ann", "sofa", "like", end - 2 * hour, end - hour),
        ("bob", "lamp", "click", end - hour, end + hour),
    ]
    store = store_of(spark.createDataFrame(rows, EVENT_SCHEMA))
    paths = store.materialize(str(tmp_path), F.lit(end))
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    asked = spark.createDataFrame([("ann", "desk"), ("eve", "lamp"), ("bob", "sofa")], "user_id string, item_id string")
    got = store.online(asked, [USER_CLICKS, ITEM_CLICKS], tables, F.lit(end))
    values = {r["user_id"]: (r["user_click_count_7d"], r["item_click_count_7d"]) for r in got.collect()}
    assert values == {"ann": (2, None), "eve": (None, 2), "bob": (0, 0)}
    expired = store.online(asked, [USER_CLICKS], tables, F.lit(end + timedelta(days=7)))
    assert expired.where("user_click_count_7d IS NOT NULL").count() == 0


def test_keys_outside_the_next_span_stay_until_they_expire(spark, tmp_path):
    end, day, hour = clock(12, day=9), timedelta(days=1), timedelta(hours=1)
    seen = [("old", end - 6 * day), ("both", end - hour), ("new", end + 10 * hour), ("both", end + 11 * hour)]
    rows = [(user, "x", "click", at, at + timedelta(minutes=1)) for user, at in seen]
    store = store_of(spark.createDataFrame(rows, EVENT_SCHEMA))

    def keys(at):
        store.materialize(str(tmp_path), F.lit(at), span=day)
        table = store.online_tables(str(tmp_path))["user_interaction_features"]
        return {r["user_id"]: (r["user_event_count_7d"], r["expires_at"]) for r in table.collect()}

    week = timedelta(days=7)
    store.materialize(str(tmp_path), F.lit(end), span=week)
    first = end + week
    assert keys(end + day) == {"old": (1, first), "both": (2, end + day + week), "new": (1, end + day + week)}
    # Nothing newer: neither values nor expiry change.
    assert keys(end + day + hour) == {"old": (1, first), "both": (2, end + day + week), "new": (1, end + day + week)}
    assert set(keys(first)) == {"both", "new"}
    assert keys(end + day + week) == {}


def test_merge_equals_a_store_that_is_written_row_by_row(spark):
    rng = random.Random(4)
    start = datetime(2026, 1, 1)
    store, stored = {}, None
    schema = "k string, event_timestamp timestamp, a long, expires_at timestamp"
    for step in range(5):
        now = start + timedelta(days=2 * step)
        rows = [(f"k{i}", now - timedelta(hours=rng.randrange(100)), rng.randrange(99), now + timedelta(days=rng.choice([1, 3, 9]))) for i in range(30) if rng.random() < 0.6]
        store = {k: r for k, r in store.items() if r[3] > now}
        for row in rows:
            if row[0] not in store or store[row[0]][1] < row[1]:
                store[row[0]] = row
        latest = spark.createDataFrame(rows, schema)
        merged = latest if stored is None else online.merge(stored, latest, "k", F.lit(now))
        got = {r["k"]: tuple(r) for r in merged.collect()}
        assert got == store
        stored = spark.createDataFrame(list(got.values()), schema)


def test_materialize_range_includes_both_ends(spark):
    end = datetime(2026, 1, 8)
    start = end - timedelta(days=7)
    tick = timedelta(microseconds=1)
    table = feature_table(
        spark, [("a", start, start, 1, 1), ("b", start - tick, start, 1, 1), ("c", end, end, 1, 1), ("d", end + tick, end, 1, 1)]
    )
    latest = online.latest_values(table, "k", ("a", "b"), F.lit(start), F.lit(end))
    assert sorted(r["k"] for r in latest.collect()) == ["a", "c"]
    assert {r["expires_at"] for r in latest.collect()} == {end + timedelta(days=7)}


def test_parity_counts_differences_and_one_sided_keys(spark):
    schema = "k string, a long, b long"
    off = spark.createDataFrame([("x", 1, 1), ("y", 2, 2), ("z", None, None), ("only", 5, 5)], schema)
    on = spark.createDataFrame([("x", 1, 1), ("y", 2, 3)], schema)
    row = online.parity(off, on, "k", ("a", "b")).first()
    assert (row["mismatches"], row["compared"]) == (2, 4)
