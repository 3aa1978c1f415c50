"""An independent DuckDB statement per query, over the base tables."""

from __future__ import annotations

from tidemark.sources.derived import DENSE_EPOCH_MS

_INTERACTIONS = """
interactions AS (
  SELECT event_id AS seq, concat('u', user_id) AS user_id, concat('i', json_extract_string(props, '$.k')) AS item_id,
    CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'like' WHEN 'signup' THEN 'share'
         WHEN 'error' THEN 'dwell' ELSE event_type END AS event_type,
    created_at,
    created_at + to_seconds(CASE WHEN event_id % 97 = 0 THEN 86400 * (1 + event_id % 9) WHEN event_id % 89 = 0 THEN -30
         WHEN event_id % 2 = 0 THEN 1800 * ((event_id * 7919) % 5) ELSE (event_id * 7919) % 600 END) AS ingested_at
  FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN date_trunc('hour', ts) ELSE ts END AS created_at FROM events))
"""

# Which class of envelope each row became, in the order the envelopes were made.
_CLASSES = """
classes AS (
  SELECT *, CASE WHEN seq % 101 = 0 THEN 'syntax' WHEN seq % 103 = 0 THEN 'null' WHEN seq % 107 = 0 THEN 'blank'
    WHEN seq % 109 = 0 THEN 'hover' WHEN seq % 113 = 0 THEN 'no_time' WHEN seq % 127 = 0 THEN 'bad_time'
    WHEN seq % 131 = 0 THEN 'blank_id' WHEN seq % 137 = 0 THEN 'padded' WHEN seq % 139 = 0 THEN 'tail'
    WHEN seq % 149 = 0 THEN 'large' ELSE 'plain' END AS class
  FROM interactions)
"""

_CONSUMED = """
consumed AS (
  SELECT seq, CASE class WHEN 'padded' THEN concat('  ', user_id, ' ') ELSE user_id END AS user_id,
    CASE class WHEN 'padded' THEN concat(' ', item_id) ELSE item_id END AS item_id, event_type, created_at, ingested_at
  FROM classes WHERE class IN ('plain', 'padded', 'tail', 'large'))
"""

_TYPE_PROBLEM = "event_type must be one of: impression, click, dwell, like, share"
_GATEWAY = f"""
routed AS (
  SELECT *, CASE WHEN class IN ('syntax', 'blank', 'bad_time', 'tail') THEN 'malformed'
      WHEN class IN ('null', 'hover', 'blank_id') THEN 'invalid' WHEN class = 'large' THEN 'too_large' ELSE 'accepted' END AS outcome,
    CASE class WHEN 'null' THEN 'user_id is required; item_id is required; {_TYPE_PROBLEM}'
      WHEN 'hover' THEN '{_TYPE_PROBLEM}' WHEN 'blank_id' THEN 'user_id is required' ELSE '' END AS problems
  FROM classes)
"""

_ENVELOPE_TEXT = """
texts AS (
  SELECT *, CASE class WHEN 'syntax' THEN '{not json' WHEN 'null' THEN 'null' WHEN 'blank' THEN '   '
    WHEN 'hover' THEN concat('{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"hover","created_at":"', c, '"}')
    WHEN 'no_time' THEN concat('{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '"}')
    WHEN 'bad_time' THEN concat('{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"yesterday"}')
    WHEN 'blank_id' THEN concat('{"user_id":" ","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '"}')
    WHEN 'tail' THEN concat('{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '"} tail')
    WHEN 'large' THEN concat('{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type, '","created_at":"', c, '","extra":"', repeat('x', 65536), '"}')
    END AS value
  FROM (SELECT *, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS c FROM routed))
"""

_WATERMARK = f"""
dense AS (
  SELECT seq, event_type, {DENSE_EPOCH_MS} + seq * 700
    - CASE WHEN seq % 41 = 0 THEN 60000 WHEN seq % 13 = 0 THEN 4000 ELSE 0 END AS ms FROM interactions),
marked AS (
  SELECT *, max(ms) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 2000 AS watermark_ms,
    ms - ms % 10000 AS start_ms FROM dense),
judged AS (
  SELECT *, coalesce(watermark_ms >= start_ms + 9999 + 5000, false) AS late,
    coalesce(watermark_ms >= start_ms + 9999, false) AS fired FROM marked)
"""

_PARTITIONS = range(3)
_EARLIER = "OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
# Peak and last arrival of each partition before a record; the slowest that is not idle gives the mark.
_MERGED_WATERMARK = f"""
dense AS (
  SELECT seq, event_type, {DENSE_EPOCH_MS} + seq * 700
    - CASE WHEN seq % 41 = 0 THEN 60000 WHEN seq % 13 = 0 THEN 4000 ELSE 0 END AS ms, seq * 100 AS arrival,
    CASE WHEN seq % 300 < 100 THEN seq % 3 ELSE seq % 2 END AS part FROM interactions),
peaks AS (
  SELECT *, {", ".join(f"max(CASE WHEN part = {p} THEN ms END) {_EARLIER} AS peak{p}, max(CASE WHEN part = {p} THEN arrival END) {_EARLIER} AS seen{p}" for p in _PARTITIONS)}
  FROM dense),
marked AS (
  SELECT seq, event_type, ms, ms - ms % 10000 AS start_ms,
    max(least({", ".join(f"CASE WHEN arrival - seen{p} <= 2000 THEN peak{p} END" for p in _PARTITIONS)}) - 2000) OVER (ORDER BY seq) AS watermark_ms
  FROM peaks),
judged AS (SELECT *, coalesce(watermark_ms >= start_ms + 9999 + 5000, false) AS late FROM marked)
"""


def _ntz(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


def _history(alias: str, key: str, where: str) -> str:
    """Counts over the key's history by a plain join; rows without history get 0."""
    return f"""
{alias} AS (
  SELECT e.seq, count(h.seq) AS n, count(CASE WHEN h.event_type = 'click' THEN 1 END) AS clicks
  FROM interactions e LEFT JOIN interactions h ON h.{key} = e.{key} AND {where} GROUP BY e.seq)
"""


_BEFORE_EVENT = (
    "h.created_at < e.created_at AND h.created_at > e.created_at - INTERVAL 7 DAY AND h.ingested_at <= e.created_at"
)
_AT_AVAILABILITY = (
    "h.ingested_at >= h.created_at AND h.ingested_at <= e.ingested_at "
    "AND h.created_at > e.ingested_at - INTERVAL 7 DAY"
)
_EVENT_ROWS = f"""
{_history("eu", "user_id", _BEFORE_EVENT)}, {_history("ei", "item_id", _BEFORE_EVENT)},
event_rows AS (
  SELECT e.seq, 0 AS kind, user_id, item_id, created_at AS event_timestamp, ingested_at AS created_timestamp,
    eu.n AS user_event_count_7d, eu.clicks AS user_click_count_7d, ei.n AS item_event_count_7d, ei.clicks AS item_click_count_7d
  FROM interactions e JOIN eu USING (seq) JOIN ei USING (seq))
"""
_AVAILABILITY_ROWS = f"""
{_history("au", "user_id", _AT_AVAILABILITY)}, {_history("ai", "item_id", _AT_AVAILABILITY)},
availability_rows AS (
  SELECT e.seq, 1 AS kind, user_id, item_id, ingested_at AS event_timestamp, ingested_at AS created_timestamp,
    au.n AS user_event_count_7d, au.clicks AS user_click_count_7d, ai.n AS item_event_count_7d, ai.clicks AS item_click_count_7d
  FROM interactions e JOIN au USING (seq) JOIN ai USING (seq) WHERE ingested_at >= created_at)
"""
_FEATURE_COLUMNS = """user_id, item_id, event_timestamp, created_timestamp,
  user_event_count_7d, user_click_count_7d, item_event_count_7d, item_click_count_7d"""
_SNAPSHOT = f"""
{_EVENT_ROWS}, {_AVAILABILITY_ROWS},
snapshot AS (SELECT * FROM event_rows UNION ALL SELECT * FROM availability_rows)
"""


def _source(entity: str) -> str:
    return f"""
{entity}_source AS (
  SELECT {entity}_id, event_timestamp, created_timestamp, {entity}_event_count_7d, {entity}_click_count_7d
  FROM (SELECT *, row_number() OVER (PARTITION BY {entity}_id, event_timestamp ORDER BY created_timestamp, kind, seq) AS r
        FROM snapshot) WHERE r = 1)
"""


_SOURCES = f"{_SNAPSHOT}, {_source('user')}, {_source('item')}"
_TRAINING = """
training AS (
  SELECT seq, CASE WHEN seq % 211 <> 0 THEN user_id END AS user_id, CASE WHEN seq % 223 <> 0 THEN item_id END AS item_id,
    created_at AS event_timestamp, CAST(event_type = 'click' AS BIGINT) AS label FROM interactions)
"""
_END = "TIMESTAMP '2024-01-25 00:00:00'"


def _fresh(entity: str, alias: str) -> str:
    return ", ".join(
        f"CASE WHEN {alias}.event_timestamp >= t.event_timestamp - INTERVAL 7 DAY THEN {alias}.{c} END AS {c}"
        for c in (f"{entity}_event_count_7d", f"{entity}_click_count_7d")
    )


def _as_of(entity: str, alias: str) -> str:
    return (
        f"ASOF LEFT JOIN {entity}_source {alias} "
        f"ON t.{entity}_id = {alias}.{entity}_id AND t.event_timestamp >= {alias}.event_timestamp"
    )


def _latest(entity: str) -> str:
    columns = (f"{entity}_event_count_7d", f"{entity}_click_count_7d")
    return f"""
{entity}_latest AS (
  SELECT {entity}_id, max(event_timestamp) AS event_timestamp,
    {", ".join(f"arg_max({c}, event_timestamp) AS {c}" for c in columns)}, {_END} + INTERVAL 7 DAY AS expires_at
  FROM {entity}_source WHERE event_timestamp BETWEEN {_END} - INTERVAL 7 DAY AND {_END} GROUP BY {entity}_id)
"""


def _merged(entity: str) -> str:
    """Online tables after each materialization; a stored row gives way to a newer one, or once it has expired."""
    columns = f"{entity}_id AS key, event_timestamp, {entity}_event_count_7d AS event_count_7d, {entity}_click_count_7d AS click_count_7d"
    ctes, stored = [], None
    for days in (8, 1, 0):
        now, name = f"({_END} - INTERVAL {days} DAY)", f"{entity}_online_{days}"
        parts = [
            f"""SELECT {columns}, {now} + INTERVAL 7 DAY AS expires_at, 0 AS stored FROM (
            SELECT *, row_number() OVER (PARTITION BY {entity}_id ORDER BY event_timestamp DESC) AS r FROM {entity}_source
            WHERE event_timestamp BETWEEN {now} - INTERVAL 7 DAY AND {now}) WHERE r = 1"""
        ]
        if stored:
            parts.append(
                f"SELECT key, event_timestamp, event_count_7d, click_count_7d, expires_at, 1 FROM {stored} WHERE expires_at > {now}"
            )
        ctes.append(
            f"""{name} AS (SELECT * EXCLUDE (r, stored) FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_timestamp DESC, stored DESC) AS r
            FROM ({" UNION ALL ".join(parts)})) WHERE r = 1)"""
        )
        stored = name
    return ", ".join(ctes)


_CHANGES = """
changed AS (
  SELECT CASE WHEN seq % 31 > 0 THEN seq * 3 END AS lsn, seq AS id, 'c' AS op, user_id, item_id, event_type, created_at
  FROM interactions
  UNION ALL SELECT seq * 3 + 1, seq, 'u', user_id, item_id, 'like', created_at FROM interactions
  WHERE seq % 10 = 0 AND seq % 70 <> 0
  UNION ALL SELECT seq * 3 + 2, seq, 'd', NULL, NULL, NULL, NULL FROM interactions WHERE seq % 25 = 0)
"""

def _with(*ctes_and_select: str) -> str:
    *ctes, select = ctes_and_select
    return "WITH " + ", ".join(c.strip() for c in (_INTERACTIONS, *ctes)) + "\n" + select.strip()


_STATE_SELECT = """
SELECT id, user_id, item_id, event_type, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY lsn DESC NULLS LAST) AS r FROM changed) WHERE r = 1 AND op <> 'd'
"""
_COUNTS = f"""
counts AS (
  SELECT event_type, {_ntz("start_ms")} AS window_start, {_ntz("start_ms + 10000")} AS window_end, count(*) AS n, start_ms
  FROM judged WHERE NOT late GROUP BY event_type, start_ms)
"""

_RECORDS = r"""SELECT user_id AS key, concat('{"user_id":"', user_id, '","item_id":"', item_id, '","event_type":"', event_type,
  '","created_at":"', regexp_replace(strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', ''), 'Z"}') AS value
FROM routed WHERE outcome = 'accepted'"""

ORACLES: dict[str, str] = {
    "parse_envelopes": _with(
        _CLASSES, _CONSUMED, "SELECT seq, user_id, item_id, event_type, created_at FROM consumed"
    ),
    "parse_lake_rows": _with(
        _CLASSES, _CONSUMED, "SELECT seq, user_id, item_id, event_type, created_at, ingested_at FROM consumed"
    ),
    "event_type_counts": _with(
        _CLASSES, _CONSUMED, "SELECT event_type, count(*) AS n FROM consumed GROUP BY event_type"
    ),
    "gateway_validate": _with(_CLASSES, _GATEWAY, "SELECT seq, problems FROM routed WHERE outcome IN ('accepted', 'invalid')"),
    "gateway_normalize": _with(
        _CLASSES, _GATEWAY,
        "SELECT seq, user_id, item_id, ingested_at AS received_at FROM routed WHERE outcome = 'accepted'",
    ),
    "gateway_route": _with(_CLASSES, _GATEWAY, "SELECT outcome, count(*) AS n FROM routed GROUP BY outcome"),
    "gateway_quarantine": _with(
        _CLASSES, _GATEWAY, _ENVELOPE_TEXT,
        """SELECT seq, value, outcome, CAST(CASE outcome WHEN 'too_large' THEN 413 ELSE 400 END AS INTEGER) AS status,
             CASE outcome WHEN 'malformed' THEN 'malformed JSON body' WHEN 'too_large' THEN 'body exceeds 64 KiB' ELSE concat('invalid event: ', problems) END AS reason
           FROM texts WHERE outcome <> 'accepted'""",
    ),
    "envelope_serialize": _with(_CLASSES, _GATEWAY, _RECORDS),
    "publish_keyed": _with(
        _CLASSES, _GATEWAY,
        """SELECT CAST(CAST(concat('0x', md5(user_id)[1:8]) AS BIGINT) % 3 AS INTEGER) AS "partition", user_id, count(*) AS n
           FROM routed WHERE outcome = 'accepted' GROUP BY ALL""",
    ),
    "arrival_watermark": _with(_WATERMARK, "SELECT seq, ms, watermark_ms FROM marked"),
    "tumbling_counts": _with(_WATERMARK, _COUNTS, "SELECT event_type, window_start, window_end, n FROM counts"),
    "late_events": _with(_WATERMARK, "SELECT seq, event_type, ms FROM judged WHERE late"),
    "window_firings": _with(
        _WATERMARK,
        f"""SELECT event_type, {_ntz("start_ms")} AS window_start,
              count(*) FILTER (WHERE fired) + max(CASE WHEN fired THEN 0 ELSE 1 END) AS firings, count(*) AS final_n
            FROM judged WHERE NOT late GROUP BY event_type, start_ms""",
    ),
    "count_lines": _with(
        _WATERMARK, _COUNTS,
        """SELECT concat(event_type, ' count=', n, ' window=[', start_ms // 1000, 's..', start_ms // 1000 + 10, 's)') AS line
           FROM counts""",
    ),
    "lake_scan": _with("SELECT user_id, item_id, event_type, created_at, ingested_at FROM interactions"),
    "lake_partitions": _with(
        "SELECT CAST(created_at AS DATE) AS created_day, count(*) AS n FROM interactions GROUP BY 1"
    ),
    "stream_counts": _with(_WATERMARK, _COUNTS, "SELECT event_type, window_start, n FROM counts"),
    "stream_late": _with(
        _WATERMARK,
        f"""SELECT user_id, item_id, j.event_type, {_ntz('ms')} AS created_at
            FROM judged j JOIN interactions USING (seq) WHERE late""",
    ),
    "stream_late_partitions": _with(
        _MERGED_WATERMARK,
        f"""SELECT user_id, item_id, j.event_type, {_ntz('ms')} AS created_at
            FROM judged j JOIN interactions USING (seq) WHERE late""",
    ),
    "stream_lake_append": _with(
        _CLASSES, _CONSUMED, "SELECT user_id, item_id, event_type, created_at, ingested_at FROM consumed"
    ),
    "lake_table_append": _with(
        _CLASSES, _CONSUMED, "SELECT user_id, item_id, event_type, created_at, ingested_at FROM consumed"
    ),
    "stream_publish": _with(_CLASSES, _GATEWAY, _RECORDS),
    "feature_event_rows": _with(_EVENT_ROWS, f"SELECT seq, {_FEATURE_COLUMNS} FROM event_rows"),
    "feature_availability_rows": _with(_AVAILABILITY_ROWS, f"SELECT seq, {_FEATURE_COLUMNS} FROM availability_rows"),
    "feature_snapshot": _with(_SNAPSHOT, f"SELECT {_FEATURE_COLUMNS} FROM snapshot"),
    "user_feature_source": _with(_SOURCES, "SELECT * FROM user_source"),
    "item_feature_source": _with(_SOURCES, "SELECT * FROM item_source"),
    "pit_user": _with(
        _SOURCES, _TRAINING,
        f"SELECT seq, t.user_id, t.event_timestamp, label, {_fresh('user', 'u')} FROM training t {_as_of('user', 'u')}",
    ),
    "pit_item": _with(
        _SOURCES, _TRAINING,
        f"SELECT seq, t.item_id, t.event_timestamp, label, {_fresh('item', 'i')} FROM training t {_as_of('item', 'i')}",
    ),
    "pit_ranking_features": _with(
        _SOURCES, _TRAINING,
        f"""SELECT seq, t.user_id, t.item_id, t.event_timestamp, label, {_fresh("user", "u")}, {_fresh("item", "i")}
            FROM training t {_as_of("user", "u")} {_as_of("item", "i")}""",
    ),
    "online_latest_user": _with(_SOURCES, _latest("user"), "SELECT * FROM user_latest"),
    "online_latest_item": _with(_SOURCES, _latest("item"), "SELECT * FROM item_latest"),
    "online_lookup": _with(
        _SOURCES, _latest("user"), _latest("item"),
        """asked AS (
             SELECT DISTINCT user_id, item_id FROM interactions
             UNION ALL SELECT DISTINCT user_id, 'never' FROM interactions
             UNION ALL SELECT DISTINCT 'never', item_id FROM interactions
             UNION ALL SELECT DISTINCT user_id, NULL FROM interactions
             UNION ALL SELECT DISTINCT NULL, item_id FROM interactions)""",
        """SELECT a.user_id, a.item_id, user_event_count_7d, user_click_count_7d, item_event_count_7d, item_click_count_7d
           FROM asked a LEFT JOIN user_latest u ON a.user_id = u.user_id LEFT JOIN item_latest i ON a.item_id = i.item_id""",
    ),
    "online_merge": _with(
        _SOURCES, _merged("user"), _merged("item"),
        "SELECT 'user' AS entity, * FROM user_online_0 UNION ALL SELECT 'item', * FROM item_online_0",
    ),
    "offline_online_parity": _with(
        """SELECT 'user_id' AS key, CAST(0 AS BIGINT) AS mismatches, count(DISTINCT user_id) AS compared FROM interactions
           UNION ALL SELECT 'item_id', 0, count(DISTINCT item_id) FROM interactions"""
    ),
    "cdc_unwrap": _with(_CHANGES, "SELECT lsn, id, op, user_id, item_id, event_type, created_at FROM changed"),
    "cdc_refused": _with(
        "SELECT seq * 3 + 1 AS lsn, 'image breaks the rules of the table' AS reason FROM interactions WHERE seq % 70 = 0"
    ),
    "cdc_current_state": _with(_CHANGES, _STATE_SELECT),
    "stream_cdc_state": _with(_CHANGES, _STATE_SELECT),
}
