"""Causally safe user and item features from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators import chunks, rolling
from tidemark.operators.rolling import AVAILABILITY_ROW, EVENT_ROW
from tidemark.schemas import EVENT_COLUMNS, ITEM_FEATURES, USER_FEATURES, require_columns
from tidemark.sources.versions import VersionedTable

ENTITY_KEYS = {"user": "user_id", "item": "item_id"}
# File names of the two feature sources.
SOURCE_FILES = {"user": "user_interaction_features.parquet", "item": "item_interaction_features.parquet"}


def canonical_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Contract columns only: ids and type as text, times as timestamps (text is read as an instant)."""
    require_columns(events, EVENT_COLUMNS)

    def time(name: str):
        is_text = isinstance(events.schema[name].dataType, T.StringType)
        return (F.to_timestamp(name) if is_text else F.col(name)).alias(name)

    return events.select(
        *keep,
        F.col("user_id").cast("string").alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
        F.col("event_type").cast("string").alias("event_type"),
        time("created_at"),
        time("ingested_at"),
    ).where("created_at IS NOT NULL")


def feature_rows(
    events: DataFrame, keep: tuple[str, ...] = (), chunk_seconds: int = chunks.CHUNK_SECONDS
) -> DataFrame:
    """Feature rows of both entities: one per event at its event time, one at its availability.

    Rows come back as a bag in no order; ``in_snapshot_order`` sorts them. ``kind`` is 0 for event rows and
    1 for availability rows.
    """
    base = canonical_events(events, keep).withColumn("clicked", F.col("event_type") == "click").drop("event_type")
    by_user = rolling.add_counts(rolling.score_rows(base), "user_id", "user", chunk_seconds)
    by_both = rolling.add_counts(by_user, "item_id", "item", chunk_seconds)
    return by_both.select(
        *keep, "kind", "user_id", "item_id", "event_timestamp",
        F.col("ingested_at").alias("created_timestamp"), *USER_FEATURES, *ITEM_FEATURES,
    )


def event_rows(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return feature_rows(events, keep).where(F.col("kind") == EVENT_ROW).drop("kind")


def availability_rows(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return feature_rows(events, keep).where(F.col("kind") == AVAILABILITY_ROW).drop("kind")


def feature_snapshot(events: DataFrame) -> DataFrame:
    return feature_rows(events).drop("kind")


def in_snapshot_order(rows: DataFrame, *tie_break: str) -> DataFrame:
    """Rows of ``feature_rows`` by event time, then availability, event rows first on a tie. For display."""
    return rows.orderBy("event_timestamp", F.asc_nulls_last("created_timestamp"), "kind", *tie_break)


def entity_source(events: DataFrame, entity: str, chunk_seconds: int = chunks.CHUNK_SECONDS) -> DataFrame:
    """One entity's feature table: a single row per (key, event timestamp).

    Of several rows at one instant the one available first is kept, event rows before availability rows.
    So where an event of the key was ingested exactly at the instant, its post-state stands in for the
    strict-before state of an event that became known later. All rows of a kind agree at an instant, which
    is why the state per instant is enough and no row has to be ranked. Events without the key have no part.
    """
    key = ENTITY_KEYS[entity]
    base = canonical_events(events).where(F.col(key).isNotNull()).withColumn("clicked", F.col("event_type") == "click")
    state = rolling.instant_state(base, key, chunk_seconds)
    event_first = (F.col("has_event") == 1) & (
        (F.col("has_available") == 0) | F.coalesce(F.col("first_ingested") <= F.col("at"), F.lit(False))
    )
    return state.select(
        key,
        F.col("at").alias("event_timestamp"),
        F.when(event_first, F.col("first_ingested")).otherwise(F.col("at")).alias("created_timestamp"),
        F.when(event_first, F.col("event_n")).otherwise(F.col("available_n")).alias(f"{entity}_event_count_7d"),
        F.when(event_first, F.col("event_clicks")).otherwise(F.col("available_clicks")).alias(f"{entity}_click_count_7d"),
    )


def write_feature_snapshot(events: DataFrame, path: str) -> str:
    """Publish the snapshot as the table at ``path``; returns the folder of the new version."""
    return VersionedTable(events.sparkSession, path).replace(feature_snapshot(events))


def write_feature_sources(events: DataFrame, directory: str) -> tuple[str, str]:
    """Rewrite the user and the item source whole, under their readers; returns the folders of the new versions.

    Neither needs the other's counts, so nothing is shared.
    """
    spark, root = events.sparkSession, directory.rstrip("/")
    tables = {entity: VersionedTable(spark, f"{root}/{name}") for entity, name in SOURCE_FILES.items()}
    paths = {entity: table.replace(entity_source(events, entity)) for entity, table in tables.items()}
    return paths["user"], paths["item"]
