from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs, registry
from tidemark.schemas import LAKE_EVENT
from tidemark.sources import lake
from tidemark.sources.versions import VersionedTable


def test_features_job_writes_sources_and_online_tables(spark, tmp_path):
    now = datetime.now(timezone.utc)
    rows = [
        ("u1", "i1", "click", now - timedelta(days=1), now - timedelta(days=1)),
        ("u1", "i2", "like", now - timedelta(hours=1), now - timedelta(minutes=50)),
        ("u2", "i1", "click", now - timedelta(days=30), now - timedelta(days=30)),
    ]
    path = lake.append(spark.createDataFrame(rows, LAKE_EVENT), str(tmp_path / "lake"))
    jobs.main(["features", "--lake", path, "--output", str(tmp_path / "out")])
    online = VersionedTable(spark, str(tmp_path / "out" / "online" / "user_interaction_features")).current()
    got = [(r["user_id"], r["user_event_count_7d"], r["user_click_count_7d"]) for r in online.collect()]
    assert got == [("u1", 2, 1)]
    source = VersionedTable(spark, str(tmp_path / "out" / "sources" / "item_interaction_features.parquet")).current()
    assert source.select("item_id").distinct().count() == 2


def test_bodies_reach_the_lake_through_the_topic(spark, tmp_path, monkeypatch):
    monkeypatch.delenv("CHECKPOINTS_DIRECTORY", raising=False)
    good = '{"user_id":" u%d ","item_id":"i","event_type":"click"}'
    (tmp_path / "bodies").mkdir()
    (tmp_path / "bodies" / "0").write_text("\n".join([*[good % i for i in range(20)], "{bad", '{"user_id":"u"}']) + "\n")
    topic, intake = str(tmp_path / "topic"), str(tmp_path / "intake")
    for _ in range(2):
        jobs.main(
            ["accept", "--bodies", str(tmp_path / "bodies"), "--format", "parquet", "--path", topic, "--output", intake, "--once"]
        )
    refused = spark.read.parquet(f"{intake}/refused")
    outcomes = {r["outcome"]: r["count"] for r in refused.groupBy("outcome").count().collect()}
    assert outcomes == {"malformed": 1, "invalid": 1}
    landed = str(tmp_path / "lake")
    for _ in range(2):
        jobs.main(["land", "--format", "parquet", "--path", topic, "--output", landed, "--checkpoint", str(tmp_path / "ck"), "--once"])
    assert {r["user_id"] for r in lake.scan(spark, landed).collect()} == {f"u{i}" for i in range(20)}
    assert lake.scan(spark, landed).count() == 20
    counted = str(tmp_path / "counts")
    jobs.main(["counts", "--format", "parquet", "--path", topic, "--output", counted, "--once"])
    from tidemark.streaming.counts import WindowedCounts

    assert WindowedCounts(spark, counted).counts().agg(F.sum("n")).first()[0] == 20


def test_land_makes_its_table_and_partitions_it_by_day(spark, tmp_path):
    topic = str(tmp_path / "topic")
    body = '{"user_id":"u%d","item_id":"i","event_type":"click","created_at":"2027-01-%02dT00:00:00Z"}'
    rows = [(body % (i, 1 + i % 3), None, "t", 0, i) for i in range(9)]
    spark.createDataFrame(rows, "value string, timestamp timestamp, topic string, partition int, offset long").write.parquet(topic)
    arguments = ["land", "--format", "parquet", "--path", topic, "--output", str(tmp_path / "lake"), "--table", "jobs_test.landed", "--once"]
    for _ in range(2):
        jobs.main([*arguments, "--checkpoint", str(tmp_path / "ck")])
    landed = lake.current_events(spark, "jobs_test", "landed")
    assert landed.count() == 9
    assert sorted(p.name for p in (tmp_path / "lake" / "landed").glob("created_day=*")) == [f"created_day=2027-01-0{d}" for d in (1, 2, 3)]


def test_definitions_outlive_the_process_and_bind_the_sources(spark, tmp_path):
    path = str(tmp_path / "registry")
    other = registry.FeatureView("other", registry.USER, ("a",), timedelta(hours=3), "at", "made")
    services = [registry.RANKING, registry.FeatureService("more", (other, registry.ITEM_VIEW))]
    registry.save_definitions(spark, path, services)
    assert registry.load_definitions(spark, path) == {s.name: s for s in services}
    now = datetime(2027, 1, 1)
    good, bad, less = (str(tmp_path / n) for n in ("good", "bad", "less"))
    spark.createDataFrame([("u", now, now, 1)], other.schema).write.parquet(good)
    spark.read.parquet(good).withColumn("a", F.col("a").cast("double")).write.parquet(bad)
    spark.read.parquet(good).drop("made").write.parquet(less)
    assert registry.stored_source(spark, other, good).schema == other.schema
    with pytest.raises(TypeError, match="a.*double instead of bigint"):
        registry.stored_source(spark, other, bad)
    with pytest.raises(TypeError, match="missing .'made'"):
        registry.stored_source(spark, other, less)


@pytest.mark.parametrize(("given", "env", "want"), [("x", "y", "x"), (None, "y", "y/land"), (None, None, "out/checkpoint")])
def test_checkpoint_directory(monkeypatch, given, env, want):
    monkeypatch.delenv("CHECKPOINTS_DIRECTORY", raising=False)
    if env:
        monkeypatch.setenv("CHECKPOINTS_DIRECTORY", env)
    assert jobs._checkpoint(given, "land", "out") == want
