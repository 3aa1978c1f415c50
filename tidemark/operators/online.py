"""Table of latest feature values per key, lookups into it, and its agreement with the offline source."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: seconds a materialized key stays readable.
KEY_TTL = timedelta(seconds=604_800)


def latest_values(
    features: DataFrame,
    key: str,
    names: tuple[str, ...],
    start: Column,
    end: Column,
    key_ttl: timedelta = KEY_TTL,
    time: str = "event_timestamp",
    created: str = "created_timestamp",
) -> DataFrame:
    """Latest row per key with ``start <= time <= end``; the row created last wins at one instant.

    Partial maxima are taken before the exchange, so a hot key sends one row per task. The expiry counts
    from ``end``, the moment of materialization.
    """
    in_range = features.where((F.col(time) >= start) & (F.col(time) <= end))
    newest = F.max_by(F.struct(time, *names), F.struct(time, F.col(created)))
    return (
        in_range.groupBy(key)
        .agg(newest.alias("_v"))
        .select(key, f"_v.{time}", *[f"_v.{n}" for n in names], (end + F.lit(key_ttl)).alias("expires_at"))
    )


def merge(stored: DataFrame, latest: DataFrame, key: str, now: Column, time: str = "event_timestamp") -> DataFrame:
    """The online table after ``latest`` was written into it at ``now``.

    A key's row is replaced by a newer one only: one at the same time or before it changes neither values nor expiry.
    Keys that ``latest`` does not name stay until they expire; a row that has expired is gone and replaced by any.
    Both inputs hold one row per key, so no key is large.
    """
    alive = stored.where(F.col("expires_at") > now).select(latest.columns)
    both = alive.withColumn("_stored", F.lit(1)).unionByName(latest.withColumn("_stored", F.lit(0)))
    kept = F.max_by(F.struct(*[c for c in latest.columns if c != key]), F.struct(time, "_stored"))
    return both.groupBy(key).agg(kept.alias("_v")).select(key, "_v.*").select(latest.columns)


def look_up(entities: DataFrame, online: DataFrame, key: str, names: tuple[str, ...], now: Column) -> DataFrame:
    """Entity rows with the online values; NULL for keys never materialized or expired.

    ``online`` has one row per key, so a skewed entity side can be split; AQE broadcasts ``online`` when its
    measured size allows.
    """
    readable = online.where(F.col("expires_at") > now).select(key, *names)
    return entities.join(readable, key, "left")


def parity(offline: DataFrame, online: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """How many keys of either side differ in their values, and how many were compared."""
    left = offline.select(key, *[F.col(n).alias(f"_off_{n}") for n in names])
    right = online.select(key, *[F.col(n).alias(f"_on_{n}") for n in names])
    equal = reduce(lambda a, b: a & b, [F.col(f"_off_{n}").eqNullSafe(F.col(f"_on_{n}")) for n in names])
    both = left.join(right, key, "full_outer")
    return both.agg(F.count_if(~equal).alias("mismatches"), F.count("*").alias("compared"))
