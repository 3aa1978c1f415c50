from __future__ import annotations

import os
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.schemas import LAKE_EVENT
from tidemark.sources import lake, topics
from tidemark.streaming.batches import BatchTable, total
from tidemark.streaming.changes import FollowedTable
from tidemark.streaming.counts import WindowedCounts
from tidemark.streaming.landing import land, land_table

BASE = 1_800_200_000


def line(user, kind, second):
    at = datetime.fromtimestamp(BASE + second, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return f'{{"user_id":"{user}","item_id":"i","event_type":"{kind}","created_at":"{at}"}}'


def put(directory, name, *lines):
    directory.mkdir(exist_ok=True)
    (directory / name).write_text("\n".join(lines) + "\n")


def counts(counted):
    rows = counted.counts().withColumn("s", F.unix_seconds(F.col("window_start").cast("timestamp"))).collect()
    return {(r["event_type"], r["s"] - BASE): r["n"] for r in rows}


def text_stream(spark, wire):
    return topics.stream(spark, "text", {"maxFilesPerTrigger": "1"}, str(wire))


# Second of each record, in arrival order; the mark trails the largest before it by two seconds. A record is late
# once the mark has passed its window by five: 31 comes after 55, 44 and 58 after 71.
SECONDS = [40, 38, 55, 31, 47, 71, 44, 58, 62]
LATE = [31, 44, 58]


def topic(spark, path, seconds, first=0, parts=1):
    schema = "value string, timestamp timestamp, partition int, offset long"
    rows = [(line(f"p{s}", "like", s), None, 0, first + i) for i, s in enumerate(seconds)]
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("append").parquet(path)


def by_rule(seconds):
    """Count per window and late seconds, record by record."""
    kept, late, peak = {}, [], None
    for second in seconds:
        start = second - second % 10
        if peak is not None and (peak - 2) * 1000 >= (start + 10) * 1000 - 1 + 5000:
            late.append(second)
        else:
            kept[("like", start)] = kept.get(("like", start), 0) + 1
        peak = second if peak is None else max(peak, second)
    return kept, late


def late_seconds(counted):
    return sorted(int(r["user_id"][1:]) for r in counted.late().collect())


@pytest.mark.parametrize("per_batch", [1, 2, 4, len(SECONDS)])
def test_late_is_what_the_records_before_say_however_they_are_cut(spark, tmp_path, per_batch):
    counted = WindowedCounts(spark, str(tmp_path / "state"))
    wire = str(tmp_path / "wire")
    for at in range(0, len(SECONDS), per_batch):
        topic(spark, wire, SECONDS[at : at + per_batch], at, parts=3)
        # A new start each time: the checkpoint carries on.
        counted.start(topics.stream(spark, "parquet", {}, wire), once=True)
    kept, late = by_rule(SECONDS)
    assert late == LATE and counts(counted) == kept and late_seconds(counted) == sorted(LATE)


def merged_rule(records, idle=2_000):
    """Late records one by one; a record is (arrival ms, partition, second)."""
    peaks, seen, mark, late = {}, {}, None, []
    for arrival, part, second in records:
        active = [p for source, p in peaks.items() if arrival - seen[source] <= idle]
        if active:
            slowest = (min(active) - 2) * 1000
            mark = slowest if mark is None else max(mark, slowest)
        if mark is not None and mark >= (second - second % 10 + 10) * 1000 - 1 + 5000:
            late.append(second)
        peaks[part], seen[part] = max(second, peaks.get(part, second)), arrival
    return late


def three_partitions(n, seed):
    """A slow partition, a fast one, and one that falls silent and wakes up again."""
    rng, clock, records, second = random.Random(seed), 0, [], 0
    for i in range(n):
        clock += rng.choice([50, 100, 400])
        part = rng.randrange(3 if i % 60 < 20 else 2)
        second += 1
        records.append((clock, part, max(0, second - (0, 12, 3)[part] - rng.choice([0, 0, 0, 1, 30]))))
    return records


@pytest.mark.parametrize("per_batch", [1, 7, 10**6])
def test_the_slowest_partition_that_is_not_idle_sets_the_mark(spark, tmp_path, per_batch):
    records = three_partitions(180, 3)
    wire, counted = str(tmp_path / "wire"), WindowedCounts(spark, str(tmp_path / "state"))
    schema = "value string, timestamp timestamp, topic string, partition int, offset long"
    at = lambda ms: datetime.fromtimestamp(BASE + ms / 1000, timezone.utc)
    size = 26
    for start in range(0, len(records), size):
        rows = [(line(f"p{s}", "like", s), at(ms), "t", part, start + i) for i, (ms, part, s) in enumerate(records[start : start + size])]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(wire)
        for f in os.listdir(wire):  # files are delivered in the order of their times
            if f.endswith(".parquet") and os.stat(f"{wire}/{f}").st_mtime > BASE - 10**6:
                os.utime(f"{wire}/{f}", (BASE - 10**7 + start, BASE - 10**7 + start))
    counted.start(topics.stream(spark, "parquet", {"maxFilesPerTrigger": str(per_batch)}, wire), once=True)
    want = sorted(merged_rule(records))
    assert late_seconds(counted) == want and sum(counts(counted).values()) == len(records) - len(want)
    assert want


def test_marks_are_those_of_the_rule_however_arrivals_are_cut(spark):
    records = three_partitions(200, 5)
    rows = [(s * 1000, f"t/{p}", i, ms) for i, (ms, p, s) in enumerate(records)]
    df = spark.createDataFrame(rows, "ms long, source string, offset long, arrival_ms long")
    sources = {f"t/{p}": (None, None) for p in range(3)}
    results = []
    for slice_ms in (1, 700, 10**9):
        judged = windows.judge(windows.merged_watermark(df, sources, slice_ms=slice_ms))
        results.append(sorted(r["ms"] // 1000 for r in judged.where("late").collect()))
    assert results == [sorted(merged_rule(records))] * 3 and results[0]


def test_two_topics_do_not_share_a_partition(spark, tmp_path):
    counted = WindowedCounts(spark, str(tmp_path / "state"))
    schema = "user_id string, item_id string, event_type string, created_at timestamp, topic string, partition int, offset long, timestamp timestamp"
    at = lambda s: datetime.fromtimestamp(BASE + s, timezone.utc)

    def take(batch_id, *rows):
        placed = [(f"p{s}", "i", "like", at(s), topic, 0, offset, at(offset / 10)) for s, topic, offset in rows]
        counted._take(spark.createDataFrame(placed, schema), batch_id)

    take(0, (10, "b", 4), (90, "a", 5))
    # The slower topic holds the mark back, offsets are counted per topic.
    take(1, (11, "a", 6))
    assert late_seconds(counted) == []
    take(2, (80, "b", 6))
    take(3, (12, "a", 7))
    assert late_seconds(counted) == [12]


def test_replayed_batch_replaces_itself_and_fold_changes_nothing(spark, tmp_path):
    wire = str(tmp_path / "wire")
    counted = WindowedCounts(spark, str(tmp_path / "state"))
    for i, second in enumerate(SECONDS):
        topic(spark, wire, [second], i)
        counted.start(topics.stream(spark, "parquet", {}, wire), once=True)
    last = len(SECONDS) - 1
    before = counts(counted), late_seconds(counted)
    again = spark.createDataFrame(
        [(f"p{SECONDS[-1]}", "i", "like", datetime.fromtimestamp(BASE + SECONDS[-1], timezone.utc))],
        "user_id string, item_id string, event_type string, created_at timestamp",
    )
    for upto in (None, last - 1, last, last):
        if upto is not None:
            counted.fold(upto)
        if upto != last:
            counted._take(again, last)
        assert (counts(counted), late_seconds(counted)) == before
    # The peak survives the fold.
    topic(spark, wire, [33], last + 1)
    counted.start(topics.stream(spark, "parquet", {}, wire), once=True)
    assert late_seconds(counted) == [31, 33, 44, 58]


def peak(counted, batch_id):
    return [p for p, _ in counted._known(batch_id)[0].values()]


def test_long_stream_folds_itself(spark, tmp_path):
    counted = WindowedCounts(spark, str(tmp_path / "state"), fold_every=3)
    schema = "user_id string, item_id string, event_type string, created_at timestamp"
    for batch_id in range(8):
        at = datetime.fromtimestamp(BASE + batch_id, timezone.utc)
        counted._take(spark.createDataFrame([("u", "i", "click", at)], schema), batch_id)
    assert counts(counted) == {("click", 0): 8}
    assert peak(counted, 8) == [(BASE + 7) * 1000]
    # Two eras are folded and emptied; the third one's batches are there.
    eras = {e.name: [b.name for b in e.iterdir() if b.name.startswith("batch_id")] for e in (tmp_path / "state" / "counts" / "batches").glob("era=*")}
    assert sorted(eras.pop("era=2")) == ["batch_id=6", "batch_id=7"] and set(map(len, eras.values())) == {0}


def test_closed_windows_are_written_once_more_and_never_again(spark, tmp_path):
    counted = WindowedCounts(spark, str(tmp_path / "state"), fold_every=2)
    schema = "user_id string, item_id string, event_type string, created_at timestamp, partition int"

    def take(batch_id, *placed):
        rows = [("u", "i", "click", datetime.fromtimestamp(BASE + s, timezone.utc), p) for s, p in placed]
        counted._take(spark.createDataFrame(rows, schema), batch_id)

    settled = tmp_path / "state" / "counts" / "settled"

    def closed():
        return {(r["event_type"], r["start_ms"] - BASE * 1000): r["n"] for r in spark.read.parquet(str(settled)).collect()}

    take(0, (1, 0), (2, 1))
    take(1, (40, 0))
    take(2, (41, 0))
    # The second partition may still add to the first window.
    assert not list(settled.rglob("*.parquet"))
    take(3, (3, 1), (60, 1))
    take(4, (61, 0))
    assert closed() == {("click", 0): 3}
    files = {f: f.stat().st_mtime_ns for f in settled.rglob("*.parquet")}
    # A partition that shows up later is counted all the same.
    take(5, (62, 2), (90, 0))
    take(6, (91, 1), (92, 2))
    take(7, (93, 2))
    take(8, (94, 2))
    assert files.items() <= {f: f.stat().st_mtime_ns for f in settled.rglob("*.parquet")}.items()
    assert counts(counted) == {("click", 0): 3, ("click", 40): 2, ("click", 60): 3, ("click", 90): 5}
    assert set(closed()) == {("click", 0), ("click", 40_000), ("click", 60_000)}


def test_a_fold_that_dies_half_way_counts_nothing_twice(spark, tmp_path, monkeypatch):
    log = BatchTable(spark, str(tmp_path / "log"), spark.range(0).selectExpr("id AS k", "id AS n").schema, era_batches=2)
    for n in range(4):
        log.put(spark.range(3).selectExpr("id AS k", f"CAST({n} AS bigint) AS n"), n)

    def sums():
        return {r["k"]: r["n"] for r in total(log.rows(), ("k",)).collect()}

    merge = lambda rows: total(rows, ("k",))
    log.fold(merge, 0, F.col("k") == 0)
    # The next fold ends after its writes, before they are published.
    enter = type(log.folded)._enter
    with monkeypatch.context() as patch:
        patch.setattr(type(log.folded), "_enter", lambda self, n, f, s, *label: enter(self, n, f, s, *label) if s != "published" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.fold(merge, 2, F.col("k") <= 1)
    assert sums() == {0: 6, 1: 6, 2: 6}
    log.fold(merge, 3, F.col("k") <= 1)
    assert sums() == {0: 6, 1: 6, 2: 6}
    log.fold(merge, 3, F.col("k") <= 1)
    log.put(spark.range(3).selectExpr("id AS k", "id AS n"), 4)
    assert sums() == {0: 6, 1: 7, 2: 8}


def test_empty_batches_keep_the_peak(spark, tmp_path):
    counted = WindowedCounts(spark, str(tmp_path / "state"))
    schema = "user_id string, item_id string, event_type string, created_at timestamp"
    at = datetime.fromtimestamp(BASE, timezone.utc)
    counted._take(spark.createDataFrame([("u", "i", "click", at)], schema), 0)
    counted._take(spark.createDataFrame([], schema), 1)
    assert peak(counted, 2) == [BASE * 1000]
    assert peak(counted, 0) == []


def test_a_batch_that_dies_is_not_read_and_one_written_again_counts_once(spark, tmp_path):
    log = BatchTable(spark, str(tmp_path / "log"), spark.range(0).selectExpr("'' AS event_type", "id AS n").schema)
    rows = spark.createDataFrame([("click", 1)], "event_type string, n long")
    assert log.rows().count() == 0 and log.before(5).count() == 0
    log.put(rows, 0)
    with pytest.raises(Exception, match="lost"):
        log.put(spark.range(0, 40, 1, 4).selectExpr("'x' AS event_type", "CASE WHEN id = 39 THEN raise_error('lost') ELSE id END AS n"), 1)
    assert total(log.rows(), ("event_type",)).collect() == [("click", 1)]
    for _ in range(2):
        log.put(rows, 1)
    assert total(log.rows(), ("event_type",)).collect() == [("click", 2)]
    log.put(rows.limit(0), 2)
    assert log.before(3).count() == 1


def test_a_batch_beside_a_landing_stream_is_refused(spark, tmp_path):
    put(tmp_path / "wire", "0.json", *lake_lines(2))
    table = str(tmp_path / "lake")
    land(text_stream(spark, tmp_path / "wire"), table, str(tmp_path / "ck"), F.lit(datetime(2027, 1, 20)), once=True)
    with pytest.raises(ValueError, match="belongs to a landing stream"):
        lake.append(lake.scan(spark, table), table)


def lake_lines(n, start=0):
    return [line(f"u{i}", "click", i * 3600) for i in range(start, start + n)]


def test_landing_loses_and_repeats_nothing_across_restarts(spark, tmp_path):
    wire, table = tmp_path / "wire", str(tmp_path / "lake")
    stamp = F.lit(datetime(2027, 1, 20))
    put(wire, "0.json", *lake_lines(5), "{bad")
    land(text_stream(spark, wire), table, str(tmp_path / "ck"), stamp, once=True)
    assert lake.scan(spark, table).count() == 5
    put(wire, "1.json", *lake_lines(4, 5))
    for _ in range(2):
        land(text_stream(spark, wire), table, str(tmp_path / "ck"), stamp, once=True)
    landed = lake.scan(spark, table)
    assert landed.count() == 9 and landed.select("user_id").distinct().count() == 9
    assert spark.read.parquet(table).select(lake.DAY).distinct().count() >= 1


def test_landing_into_a_catalog_table(spark, tmp_path):
    table = lake.ensure_table(spark, str(tmp_path / "landed"), "landed_test")
    wire = tmp_path / "wire"
    put(wire, "0.json", *lake_lines(3))
    query = land_table(text_stream(spark, wire), table, str(tmp_path / "ck"), F.lit(datetime(2027, 1, 20)))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert lake.current_events(spark, "landed_test").count() == 3
    put(wire, "1.json", *lake_lines(2, 3))
    for _ in range(2):
        land_table(text_stream(spark, wire), table, str(tmp_path / "ck"), F.lit(datetime(2027, 1, 20)), once=True)
    assert lake.current_events(spark, "landed_test").count() == 5
    # A load beside the stream; done again it replaces itself, a replayed micro-batch too.
    day = spark.createDataFrame([("x", "i", "click", datetime(2027, 1, 1), datetime(2027, 1, 2))] * 2, LAKE_EVENT)
    replayed = spark.createDataFrame([("y", "i", "click", datetime(2027, 1, 1), datetime(2027, 1, 2))], LAKE_EVENT)
    for _ in range(2):
        lake.insert(day, table, "load-1")
        lake.insert(replayed, table, "stream-0000000007")
    assert lake.current_events(spark, "landed_test").count() == 8
    days = spark.table(table).where("user_id = 'x'").select(lake.DAY, lake.LANDED).distinct().collect()
    assert [tuple(r) for r in days] == [(date(2027, 1, 1), "load-1")]


def test_stream_equals_batch_on_ordered_input(spark, tmp_path):
    records = [(f"u{i}", ("click", "like")[i % 2], i) for i in range(60)]
    wire = tmp_path / "wire"
    put(wire, "0.json", *[line(*r) for r in records[:30]])
    # The file source delivers in the order of modification times.
    os.utime(wire / "0.json", (BASE - 100, BASE - 100))
    put(wire, "1.json", *[line(*r) for r in records[30:]])
    os.utime(wire / "1.json", (BASE, BASE))
    counted = WindowedCounts(spark, str(tmp_path / "state"))
    counted.start(text_stream(spark, wire), once=True)
    rows = [(i, t, (BASE + s) * 1000) for i, (_, t, s) in enumerate(records)]
    batch = spark.createDataFrame(rows, "seq long, event_type string, ms long")
    expected = windows.tumbling_counts(windows.judge(windows.arrival_watermark(batch)))
    assert sorted(counted.counts().collect()) == sorted(expected.collect())


def change(lsn, op, key, kind="click"):
    image = f'{{"id":{key},"user_id":"u","item_id":"i","event_type":"{kind}"}}'
    before, after = ("null" if op in "cr" else f'{{"id":{key}}}'), ("null" if op == "d" else image)
    return lsn, f'{{"before":{before},"after":{after},"op":"{op}","ts_ms":{lsn}}}'


def test_followed_table_merges_on_read(spark, tmp_path):
    schema = "lsn long, value string"
    followed = FollowedTable(spark, str(tmp_path / "state"))
    wire = str(tmp_path / "wire")
    deliveries = [
        [change(1, "c", 1), change(2, "c", 2), change(3, "u", 1, "like"), (4, None), (5, "{bad")],
        [change(9, "d", 2), change(6, "r", 3)],
        [change(8, "u", 2, "share")],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(wire)
        followed.start(spark.readStream.schema(schema).parquet(wire), once=True)
    expected = {1: "like", 3: "click"}
    assert {r["id"]: r["event_type"] for r in followed.state().collect()} == expected
    followed.fold(1)
    assert {r["id"]: r["event_type"] for r in followed.state().collect()} == expected
