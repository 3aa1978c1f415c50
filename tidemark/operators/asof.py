"""Point-in-time left join: the latest feature row at or before each entity row, unless it is too old.

Feature rows and entity rows are put in one table, placed by key and chunk of time (``chunks``), and the last
feature row of the chunk, else the last of the key's earlier chunks, is carried forward. No pair of rows is ever
formed, and no task holds more than a chunk of a key.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators import chunks

# What earlier chunks left has no time and comes first.
_BEFORE, _FEATURE, _ENTITY = -1, 0, 1
# The chunk of rows without a time, before all others.
_NO_TIME = -(1 << 62)


def as_of_join(
    entities: DataFrame,
    features: DataFrame,
    key: str,
    names: tuple[str, ...],
    ttl: timedelta,
    time: str = "event_timestamp",
    created: str | None = "created_timestamp",
    chunk_seconds: int = chunks.CHUNK_SECONDS,
) -> DataFrame:
    """Entity rows with the feature columns; NULL where no feature row is within the ttl (both ends count).

    A feature row at the very instant of an entity row is used. Of feature rows at one instant the one
    created last wins. Every entity column passes through and duplicates stay. The key is text; entity rows
    without one meet no feature and are spread by their input partition. Rows without a time meet none either.
    """
    found = F.struct(F.col(time).alias("seen_at"), *names)
    tie = F.col(created) if created else F.lit(None).cast("timestamp")
    # A NULL key meets no feature, here as in an online lookup.
    history = features.where(F.col(key).isNotNull()).select(
        *[c.alias(n) for n, c in chunks.key_columns(key).items()],
        F.col(time).alias("_at"), tie.alias("_tie"), found.alias("_found"), F.lit(_FEATURE).alias("_side"),
    )
    nobody = F.when(F.col(key).isNull(), F.spark_partition_id().cast("string")).otherwise(F.col(key))
    asked = entities.select(
        nobody.alias(chunks.KEY), F.col(key).isNull().alias(chunks.NO_KEY), F.col(time).alias("_at"),
        F.struct(*entities.columns).alias("_row"), F.lit(_ENTITY).alias("_side"),
    )
    stacked = history.unionByName(asked, allowMissingColumns=True)
    placed = stacked.withColumn(chunks.CHUNK, F.coalesce(chunks.chunk(F.col("_at"), chunk_seconds), F.lit(_NO_TIME))).repartition(*chunks.PLACE)

    # Feature rows sort before entity rows of the same instant.
    order = [F.col("_at"), F.col("_side"), F.col("_tie").asc_nulls_first()]
    so_far = chunks.within(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    has_row = F.col("_row").isNotNull()

    def carry(name: str, earlier: Window) -> Column:
        return F.last(name, ignorenulls=True).over(earlier)

    latest = F.max(F.when(F.col("_side") == _FEATURE, F.struct("_at", "_tie", "_found")))
    before = chunks.carried(placed, {"_before": latest}, carry, has_row)
    before = before.select(*chunks.PLACE, F.col("_before._found").alias("_found"), F.lit(_BEFORE).alias("_side"))
    whole = placed.unionByName(before, allowMissingColumns=True)
    carried = whole.withColumn("_found", F.last("_found", ignorenulls=True).over(so_far)).where(has_row)
    result = carried.select("_row.*", "_found")
    fresh = F.col(key).isNotNull() & (F.col("_found.seen_at") >= F.col(time) - F.lit(ttl))
    return result.select(*entities.columns, *[F.when(fresh, F.col(f"_found.{n}")).alias(n) for n in names])
