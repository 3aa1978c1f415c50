from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from tidemark.schemas import EVENT_COLUMNS, LAKE_EVENT
from tidemark.sources import derived, lake


def some_events(spark):
    rows = [
        ("u1", "i1", "click", datetime(2026, 1, d, h), datetime(2026, 1, d, h, 1)) for d in range(1, 21) for h in (0, 23)
    ]
    return spark.createDataFrame(rows, LAKE_EVENT)


def test_contract(spark):
    assert tuple(LAKE_EVENT.names) == EVENT_COLUMNS
    assert [f.nullable for f in LAKE_EVENT] == [False, False, False, False, True]
    assert lake.TARGET_FILE_BYTES == 128 * 1024 * 1024
    with pytest.raises(ValueError, match="missing required columns"):
        lake.with_day(some_events(spark).drop("item_id"))


def test_append_partitions_by_event_day_and_adds(spark, tmp_path):
    path = str(tmp_path / "lake")
    for _ in range(2):
        lake.append(some_events(spark), path)
    days = {r[lake.DAY]: r["n"] for r in lake.day_counts(spark, path).collect()}
    assert days == {date(2026, 1, d): 4 for d in range(1, 21)}


def test_scan_prunes_days_and_columns(spark, tmp_path):
    path = lake.append(some_events(spark), str(tmp_path / "lake"))
    chosen = lake.scan(spark, path, date(2026, 1, 3), date(2026, 1, 4))
    assert chosen.count() == 4
    plan = chosen.select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_day" in plan
    assert "ReadSchema: struct<user_id:string>" in plan


def test_day_counts_read_no_data_column(spark, tmp_path):
    path = lake.append(some_events(spark), str(tmp_path / "lake"))
    plan = lake.day_counts(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_bootstrap_is_idempotent_and_absence_is_an_error(spark, tmp_path):
    with pytest.raises(LookupError, match="table boot_test.events_raw is not registered"):
        lake.current_events(spark, "boot_test")
    names = {lake.ensure_table(spark, str(tmp_path / "w"), "boot_test") for _ in range(2)}
    assert names == {"boot_test.events_raw"}
    assert lake.current_events(spark, "boot_test").count() == 0
    lake.insert(some_events(spark), "boot_test.events_raw", "load")
    current = lake.current_events(spark, "boot_test")
    assert tuple(current.columns) == EVENT_COLUMNS and current.count() == 40
    assert lake.ensure_table(spark, str(tmp_path / "w"), "boot_test") == "boot_test.events_raw"
    assert current.count() == 40


@pytest.mark.parametrize("width", [2, 200])
def test_files_have_the_target_size_whatever_a_row_takes(spark, tmp_path, width):
    """The first write guesses, the next ones know what a row took."""
    rng = random.Random(width)
    day = datetime(2026, 1, 1)
    # Half of the rows on one day, and ids that do not compress.
    rows = [("".join(rng.choices("0123456789abcdef", k=width)), "i", "click", day + timedelta(days=rng.choice([0, 0, 0, 1, 2]), seconds=i), day) for i in range(24_000)]
    events = spark.createDataFrame(rows, LAKE_EVENT)
    path, target = str(tmp_path / "lake"), 60_000 if width == 2 else 600_000
    lake.append(events, path, target)
    before = {f for f in (tmp_path / "lake").rglob("*.parquet")}
    row_bytes = lake.bytes_per_row(spark.read.parquet(path))
    lake.append(events, path, target)
    sizes = {}
    for f in (tmp_path / "lake").rglob("*.parquet"):
        if f not in before:
            sizes.setdefault(f.parent.name, []).append(f.stat().st_size)
    largest = sizes["created_day=2026-01-01"]
    assert len(largest) == round(14_400 * row_bytes / target) or len(largest) > 1
    assert all(abs(s - target) < target / 4 for s in largest), (sorted(largest), target)


def test_derived_interactions_have_the_awkward_rows(spark, sf_dir):
    rows = derived.interactions(spark, sf_dir)
    assert rows.where("ingested_at < created_at").count() > 0
    assert rows.where("ingested_at = created_at").count() > 0
    assert rows.where("ingested_at >= created_at + INTERVAL 7 DAYS").count() > 0
    assert rows.groupBy("user_id", "created_at").count().where("count > 1").count() > 0
