from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import envelopes

GOOD = '{"user_id":"u1","item_id":"i1","event_type":"click","created_at":"2026-08-25T10:00:00Z"}'


def parsed(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")
    return {r["n"]: r for r in envelopes.parse_events(df).collect()}


def body(**fields):
    base = {"user_id": '"u1"', "item_id": '"i1"', "event_type": '"click"', "created_at": '"2026-08-25T10:00:00Z"'}
    base |= fields
    return "{" + ",".join(f'"{k}":{v}' for k, v in base.items() if v is not None) + "}"


def test_valid_envelope(spark):
    row = parsed(spark, GOOD)[0]
    assert (row["user_id"], row["item_id"], row["event_type"]) == ("u1", "i1", "click")
    assert row["created_at"] == datetime(2026, 8, 25, 10)


@pytest.mark.parametrize(
    "value",
    [
        None,
        "",
        "   ",
        "\t\n",
        "null",
        "{not json",
        "5",
        '"text"',
        GOOD[:-1],
        f"[{GOOD}]",
        body(event_type='"hover"'),
        body(user_id=None),
        body(item_id=None),
        body(event_type=None),
        body(created_at=None),
        body(created_at="null"),
        body(created_at='"yesterday"'),
        body(created_at='"2026-08-25"'),
        body(created_at='"2026-08-25T10:00:00"'),
        body(created_at='"2026-13-25T10:00:00Z"'),
        body(user_id='""'),
        body(user_id='" "'),
        body(item_id='" "'),
        body(user_id='{"a":1}'),
        body(item_id='["i1"]'),
        body(user_id="NaN"),
        GOOD.replace('"', "'"),
    ],
)
def test_poison_rows_leave_no_row_and_no_error(spark, value):
    assert parsed(spark, value) == {}


def test_accepted_oddities(spark):
    rows = parsed(
        spark,
        body(extra="123"),
        GOOD + " tail",
        body(user_id="42"),
        body(user_id='"  u1 "'),
        body(user_id='" "'),
        body(user_id='"{not nested}"'),
        body(created_at='"2026-08-25T12:00:00.123456789+02:00"'),
        "  " + GOOD,
    )
    assert set(rows) == set(range(8))
    assert rows[2]["user_id"] == "42"
    assert rows[3]["user_id"] == "  u1 "
    assert rows[4]["user_id"] == " "
    assert rows[5]["user_id"] == "{not nested}"
    assert rows[6]["created_at"] == datetime(2026, 8, 25, 10, 0, 0, 123456)


def test_lake_rows_keep_microseconds_and_contract_order(spark):
    df = spark.createDataFrame([(body(created_at='"2026-08-25T10:00:00.000001Z"'),)], "value string")
    stamp = F.lit(datetime(2026, 8, 25, 10, 0, 5, 7))
    out = envelopes.parse_lake_events(df, stamp)
    assert out.columns == ["user_id", "item_id", "event_type", "created_at", "ingested_at"]
    row = out.first()
    assert row["created_at"].microsecond == 1 and row["ingested_at"].microsecond == 7


def test_lake_rows_need_a_stamp(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    assert envelopes.parse_lake_events(df, F.lit(None).cast("timestamp")).count() == 0
    assert envelopes.parse_lake_events(df).count() == 1


def test_instant_text_has_the_shortest_fraction(spark):
    times = ["2026-01-01 00:00:00", "2026-01-01 00:00:10.25", "2026-01-01 10:20:00.000001"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        text.instant_text(F.col("t").cast("timestamp")).alias("t")
    )
    assert [r["t"] for r in df.collect()] == [
        "2026-01-01T00:00:00Z",
        "2026-01-01T00:00:10.25Z",
        "2026-01-01T10:20:00.000001Z",
    ]


def test_the_text_is_parsed_once(spark):
    """The filter must not be pushed below the parse, where it would repeat it per condition."""
    df = spark.createDataFrame([(GOOD,)], "value string")
    plan = envelopes.parse_events(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
