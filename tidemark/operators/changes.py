"""Row changes of one table: unwrap the change records and keep the latest image per primary key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import text
from tidemark.functions.envelope import STRICT_JSON, computed_once
from tidemark.schemas import CHANGE, EVENT_TYPES

# Change operations create, update, delete and snapshot read.
OPERATIONS = ("c", "u", "d", "r")
IMAGE = ("user_id", "item_id", "event_type", "created_at")
NO_CHANGE, NO_KEY, IMPOSSIBLE = "no change of a known operation", "no key", "image breaks the rules of the table"


def judge(changes: DataFrame, order: str = "lsn", value: str = "value") -> DataFrame:
    """One row per record: order, key, operation, change time, the row image after it (NULL on delete), the text
    of the record, and the reason to refuse it, NULL for a good one.

    The log position comes from the column ``order`` if the records have one, else from the record itself.
    Tombstones, records without a value, are no changes and leave no row.
    """
    record = F.from_json(F.col(value), CHANGE, STRICT_JSON)
    position = [F.col(order).alias("_position")] if order in changes.columns else []
    parsed = changes.where(F.col(value).isNotNull()).select(
        *position, F.col(value).alias("value"), computed_once(record).alias("_r")
    )

    def field(path: str) -> Column:
        return F.coalesce(F.col(f"_r.{path}"), F.col(f"_r.payload.{path}"))

    key, op = F.coalesce(field("after.id"), field("before.id")), field("op")
    whole = field("after.user_id").isNotNull() & field("after.item_id").isNotNull()
    possible = whole & F.coalesce(field("after.event_type").isin(*EVENT_TYPES), F.lit(False))
    known = F.coalesce(op.isin(*OPERATIONS), F.lit(False))
    reason = F.when(~known, NO_CHANGE).when(key.isNull(), NO_KEY).when((op != "d") & ~possible, IMPOSSIBLE)
    return parsed.select(
        (F.col("_position") if position else field("source.lsn")).alias(order),
        key.alias("id"),
        op.alias("op"),
        field("ts_ms").alias("ts_ms"),
        *[field(f"after.{n}").alias(n) for n in IMAGE[:-1]],
        text.instant(field("after.created_at")).alias("created_at"),
        "value",
        reason.alias("reason"),
    )


def unwrap(changes: DataFrame, order: str = "lsn", value: str = "value") -> DataFrame:
    """The good records of ``judge``."""
    return judge(changes, order, value).where("reason IS NULL").drop("value", "reason")


def refused(changes: DataFrame, order: str = "lsn", value: str = "value") -> DataFrame:
    """Records that are no usable change, whole, with the reason. Their keys keep the image they had."""
    return judge(changes, order, value).where("reason IS NOT NULL").select(order, "value", "reason")


def latest_images(unwrapped: DataFrame, order: str = "lsn") -> DataFrame:
    """Last change per key, deletes kept as markers. Mergeable: latest images of parts can be merged again.

    The log position decides, as it is the order of commit, then the change time; a record without a position
    counts before all that have one. The partial maximum runs before the exchange, so a key that changes all the
    time sends one row per task.
    """
    columns = [c for c in unwrapped.columns if c != "id"]
    # NULLs are the least values inside a struct, and the struct itself is never NULL.
    newest = F.max_by(F.struct(*columns), F.struct(order, "ts_ms"))
    return unwrapped.groupBy("id").agg(newest.alias("_v")).select("id", *[f"_v.{c}" for c in columns])


def current_state(latest: DataFrame) -> DataFrame:
    """Rows that exist now."""
    return latest.where(F.col("op") != "d").select("id", *IMAGE)
