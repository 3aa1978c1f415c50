"""Declared schemas and fixed vocabulary. Nothing is inferred at read time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, types as T

# The closed event vocabulary and the column contracts.
EVENT_TYPES = ("impression", "click", "dwell", "like", "share")
EVENT_COLUMNS = ("user_id", "item_id", "event_type", "created_at", "ingested_at")
USER_FEATURES = ("user_event_count_7d", "user_click_count_7d")
ITEM_FEATURES = ("item_event_count_7d", "item_click_count_7d")
FEATURE_WINDOW = timedelta(days=7)

# The JSON document on the wire, as text: created_at is checked before it becomes a timestamp.
ENVELOPE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

# Column order is a contract of the lake table; only ever append to it.
LAKE_EVENT = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("item_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("ingested_at", T.TimestampType(), True),
    ]
)

INTERACTION_IMAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

_CHANGE_FIELDS = [
    T.StructField("before", INTERACTION_IMAGE),
    T.StructField("after", INTERACTION_IMAGE),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("source", T.StructType([T.StructField("lsn", T.LongType())])),
]

# A change record, bare or as the payload beside its own schema, as the connector is set to write it.
CHANGE = T.StructType([*_CHANGE_FIELDS, T.StructField("payload", T.StructType(_CHANGE_FIELDS))])


def require_columns(df: DataFrame, names: tuple[str, ...], what: str = "events") -> DataFrame:
    """Fail while planning, not while running, when a contract column is absent."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")
    return df
