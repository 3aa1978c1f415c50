from __future__ import annotations

from datetime import datetime

from tidemark.operators import changes
from tidemark.plans import jobs
from tidemark.streaming.changes import FollowedTable


def state(spark, *values):
    df = spark.createDataFrame(list(enumerate(values)), "lsn int, value string").selectExpr("CAST(lsn AS bigint) AS lsn", "value")
    return changes.unwrap(df)


def image(key, kind="click", user='"u"'):
    return f'{{"id":{key},"user_id":{user},"item_id":"i","event_type":"{kind}","created_at":"2026-01-01T00:00:00Z"}}'


def test_unwrap_takes_key_from_either_image_and_drops_what_is_no_change(spark):
    rows = state(
        spark,
        f'{{"before":null,"after":{image(1)},"op":"c","ts_ms":5}}',
        '{"before":{"id":1},"after":null,"op":"d","ts_ms":6}',
        None,
        "{bad",
        f'{{"before":null,"after":{image(2)},"op":"x","ts_ms":7}}',
        '{"before":null,"after":null,"op":"d","ts_ms":8}',
    ).collect()
    assert [(r["lsn"], r["id"], r["op"], r["ts_ms"], r["event_type"]) for r in rows] == [
        (0, 1, "c", 5, "click"),
        (1, 1, "d", 6, None),
    ]


def test_state_is_the_last_image_without_deleted_or_impossible_rows(spark):
    unwrapped = state(
        spark,
        f'{{"before":null,"after":{image(1)},"op":"r","ts_ms":1}}',
        f'{{"before":{image(1)},"after":{image(1, "like")},"op":"u","ts_ms":1}}',
        f'{{"before":null,"after":{image(2)},"op":"c","ts_ms":2}}',
        '{"before":{"id":2},"after":null,"op":"d","ts_ms":3}',
        f'{{"before":null,"after":{image(3, "hover")},"op":"c","ts_ms":2}}',
        f'{{"before":null,"after":{image(4, user="null")},"op":"c","ts_ms":2}}',
    )
    rows = changes.current_state(changes.latest_images(unwrapped)).collect()
    assert [(r["id"], r["event_type"], r["created_at"]) for r in rows] == [(1, "like", datetime(2026, 1, 1))]


def test_refused_records_are_kept_and_leave_the_image_alone(spark):
    good = f'{{"before":null,"after":{image(1)},"op":"c","ts_ms":1}}'
    bad = [
        (f'{{"before":null,"after":{image(1, "hover")},"op":"u","ts_ms":2}}', changes.IMPOSSIBLE),
        (f'{{"before":null,"after":{image(1, user="null")},"op":"u","ts_ms":3}}', changes.IMPOSSIBLE),
        ('{"before":{"id":1},"after":null,"op":"u","ts_ms":4}', changes.IMPOSSIBLE),
        ('{"before":null,"after":null,"op":"d","ts_ms":5}', changes.NO_KEY),
        (f'{{"before":null,"after":{image(1)},"op":"m","ts_ms":6}}', changes.NO_CHANGE),
        ("[]", changes.NO_CHANGE),
        ("", changes.NO_CHANGE),
    ]
    values = [good, *[v for v, _ in bad], None]
    df = spark.createDataFrame(list(enumerate(values)), "lsn int, value string").selectExpr("CAST(lsn AS bigint) AS lsn", "value")
    assert {(r["value"], r["reason"]) for r in changes.refused(df).collect()} == set(bad)
    state = changes.current_state(changes.latest_images(changes.unwrap(df))).collect()
    assert [(r["id"], r["event_type"]) for r in state] == [(1, "click")]


def test_changes_job_follows_keeps_what_it_refuses_and_folds(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")

    def send(lsn, after, op="u"):
        value = f'{{"before":{{"id":1}},"after":{after},"op":"{op}","ts_ms":1,"source":{{"lsn":{lsn}}}}}'
        row = spark.createDataFrame([(value,)], "value string").coalesce(1)
        row.write.mode("append").parquet(topic)
        jobs.main(["changes", "--format", "parquet", "--path", topic, "--output", out, "--once"])

    followed = FollowedTable(spark, out)
    send(5, image(1))
    send(4, image(1, "like"))
    send(6, image(1, "hover"))
    assert [(r["event_type"], r["created_at"]) for r in followed.state().collect()] == [("click", datetime(2026, 1, 1))]
    assert [(r["lsn"], r["reason"]) for r in followed.refused().collect()] == [(6, changes.IMPOSSIBLE)]
    FollowedTable(spark, out, fold_every=2).fold(1)
    assert followed.state().count() == 1
    send(7, "null", "d")
    assert followed.state().count() == 0


def test_latest_images_of_parts_merge(spark):
    unwrapped = state(
        spark, *[f'{{"before":null,"after":{image(k % 3, t)},"op":"u","ts_ms":1}}' for k, t in enumerate(["click", "like"] * 10)]
    )
    whole = changes.latest_images(unwrapped)
    parts = [changes.latest_images(unwrapped.where(f"lsn % 4 = {p}")) for p in range(4)]
    merged = changes.latest_images(parts[0].union(parts[1]).union(parts[2]).union(parts[3]).select(*unwrapped.columns))
    assert sorted(merged.collect()) == sorted(whole.collect())


def test_record_with_its_schema_and_own_position(spark):
    bare = f'{{"before":null,"after":{image(7)},"op":"c","ts_ms":5,"source":{{"lsn":40}}}}'
    wrapped = f'{{"schema":{{"type":"struct"}},"payload":{{"before":{{"id":7}},"after":null,"op":"d","ts_ms":6,"source":{{"lsn":41}}}}}}'
    df = spark.createDataFrame([(bare,), (wrapped,)], "value string")
    rows = changes.unwrap(df).orderBy("lsn").collect()
    assert [(r["lsn"], r["id"], r["op"]) for r in rows] == [(40, 7, "c"), (41, 7, "d")]
    assert changes.current_state(changes.latest_images(changes.unwrap(df))).count() == 0


def test_a_record_without_a_position_is_kept_and_yields_to_one_with(spark):
    def record(lsn, key, kind, ts):
        return lsn, f'{{"before":null,"after":{{"id":{key},"user_id":"a","item_id":"b","event_type":"{kind}"}},"op":"c","ts_ms":{ts}}}'

    rows = [record(None, 5, "like", 9), record(None, 5, "share", 11), record(None, 6, "click", 99), record(3, 6, "dwell", 1)]
    unwrapped = changes.unwrap(spark.createDataFrame(rows, "lsn long, value string"))
    state = changes.current_state(changes.latest_images(unwrapped)).collect()
    assert {r["id"]: r["event_type"] for r in state} == {5: "share", 6: "dwell"}
