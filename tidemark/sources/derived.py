"""Inputs derived from the ``events`` table: two-clock interactions, envelopes, change records.

``events`` has one clock, no item and a different vocabulary; these projections add what is missing in a
way both Spark and a SQL check can repeat. Every one is a plain projection of the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DENSE_EPOCH_MS = 1_800_000_000_000

_INTERACTIONS = """
SELECT event_id AS seq, concat('u', user_id) AS user_id,
  concat('i', get_json_object(props, '$.k')) AS item_id,
  CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'like' WHEN 'signup' THEN 'share'
       WHEN 'error' THEN 'dwell' ELSE event_type END AS event_type,
  created_at,
  timestampadd(SECOND, CAST(CASE WHEN event_id % 97 = 0 THEN 86400 * (1 + event_id % 9)
       WHEN event_id % 89 = 0 THEN -30 WHEN event_id % 2 = 0 THEN 1800 * ((event_id * 7919) % 5)
       ELSE (event_id * 7919) % 600 END AS INT), created_at) AS ingested_at
FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)
                     ELSE ts END AS created_at FROM {events})
"""

_ENVELOPES = """
SELECT seq, ingested_at, CASE WHEN seq % 101 = 0 THEN '{{not json' WHEN seq % 103 = 0 THEN 'null'
  WHEN seq % 107 = 0 THEN '   '
  WHEN seq % 109 = 0 THEN concat('{{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"hover","created_at":"', c, '"}}')
  WHEN seq % 113 = 0 THEN concat('{{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '"}}')
  WHEN seq % 127 = 0 THEN concat('{{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"yesterday"}}')
  WHEN seq % 131 = 0 THEN concat('{{"user_id":" ","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '"}}')
  WHEN seq % 137 = 0 THEN concat('{{"user_id":"  ', user_id, ' ","item_id":" ', item_id, '","event_type":"', event_type, '","created_at":"', c, '"}}')
  WHEN seq % 139 = 0 THEN concat('{{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '"}} tail')
  WHEN seq % 149 = 0 THEN concat('{{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '","extra":"', repeat('x', 65536), '"}}')
  WHEN seq % 151 = 0 THEN concat('{{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '","n":1,"n":[1],"x":[{{"a":1,"a":{{}}}}]}}')
  ELSE concat('{{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '","extra":1}}')
  END AS value
FROM (SELECT *, date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") AS c FROM {interactions})
"""

# One record becomes its create, update and delete without scanning the table three times.
_CHANGELOG = """
SELECT CASE WHEN step > 0 OR seq % 31 > 0 THEN seq * 3 + step END AS lsn, CASE step
  WHEN 0 THEN concat('{{"before":null,"after":{{"id":', seq, ',"user_id":"', user_id, '","item_id":"', item_id,
                     '","event_type":"', event_type, '","created_at":"', c, '"}},"op":"c","ts_ms":', seq * 1000, '}}')
  WHEN 1 THEN concat('{{"before":{{"id":', seq, '}},"after":{{"id":', seq, ',"user_id":"', user_id, '","item_id":"', item_id,
                     '","event_type":"', IF(seq % 70 = 0, 'hover', 'like'), '","created_at":"', c, '"}},"op":"u","ts_ms":', seq * 1000 + 1, '}}')
  ELSE concat('{{"before":{{"id":', seq, '}},"after":null,"op":"d","ts_ms":', seq * 1000 + 2, '}}') END AS value
FROM (SELECT *, date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") AS c, explode(array(0, 1, 2)) AS step
      FROM {interactions})
WHERE step = 0 OR (step = 1 AND seq % 10 = 0) OR (step = 2 AND seq % 25 = 0)
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, user, item, type, event time and arrival time: late, future-dated and tied rows included."""
    return spark.sql(_INTERACTIONS, events=events(spark, sf_dir))


def dense_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions on a compressed clock in epoch milliseconds, arriving in ``seq`` order.

    One row in 13 is 4 s behind its place and one in 41 is 60 s behind.
    """
    return interactions(spark, sf_dir).selectExpr(
        "seq", "user_id", "item_id", "event_type",
        f"{DENSE_EPOCH_MS} + seq * 700 - CASE WHEN seq % 41 = 0 THEN 60000 WHEN seq % 13 = 0 THEN 4000 ELSE 0 END AS ms",
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text with poison rows mixed in, plus the arrival time a bus would attach."""
    return spark.sql(_ENVELOPES, interactions=interactions(spark, sf_dir))


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of a table holding the interactions: created, some updated, some deleted.

    One creation in 31 has no log position, one update in seven an image that the table could not hold.
    """
    return spark.sql(_CHANGELOG, interactions=interactions(spark, sf_dir))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One labelled entity row per interaction, a few of them without a user or an item."""
    return interactions(spark, sf_dir).selectExpr(
        "seq", "CASE WHEN seq % 211 <> 0 THEN user_id END AS user_id", "CASE WHEN seq % 223 <> 0 THEN item_id END AS item_id",
        "created_at AS event_timestamp", "CAST(event_type = 'click' AS BIGINT) AS label",
    )
