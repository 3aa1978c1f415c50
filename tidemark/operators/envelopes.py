"""Consumer side of the bus: JSON text to typed events, poison rows dropped without an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import envelope, text
from tidemark.schemas import ENVELOPE, LAKE_EVENT


def parse_events(wire: DataFrame, value: str = "value") -> DataFrame:
    """Valid events of a batch or stream of envelopes; other columns of the input pass through.

    Ids are taken as they are: only the gateway trims them. ``created_at`` is a zoned timestamp, as
    event-time operators on streams need.
    """
    raw = F.col(value)
    kept = [c for c in wire.columns if c != value and c not in ENVELOPE.names]
    decoded = wire.select(*kept, raw.alias("_raw"), envelope.computed_once(envelope.decode(raw)).alias("_e"))
    user_id, item_id, event_type = F.col("_e.user_id"), F.col("_e.item_id"), F.col("_e.event_type")
    created_at = text.instant(F.col("_e.created_at"))
    return decoded.where(
        envelope.is_valid_event(user_id, item_id, event_type, created_at)
        & envelope.is_scalar_id(F.col("_raw"), "user_id", user_id)
        & envelope.is_scalar_id(F.col("_raw"), "item_id", item_id)
    ).select(
        *kept, user_id.alias("user_id"), item_id.alias("item_id"), event_type.alias("event_type"),
        created_at.alias("created_at"),
    )


def parse_lake_events(
    wire: DataFrame, ingested_at: Column | None = None, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Valid events stamped with their ingestion time, in lake column order after the kept columns.

    The clock is a parameter: pass the arrival column of the source for replays; the default is the
    time of the batch. Rows without a stamp are dropped, as the table's writer never lands one.
    """
    clock = F.current_timestamp() if ingested_at is None else ingested_at
    stamped = parse_events(wire.withColumn("ingested_at", clock), value).where("ingested_at IS NOT NULL")
    return stamped.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LAKE_EVENT])


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"))
