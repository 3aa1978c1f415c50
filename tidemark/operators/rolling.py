"""Seven-day counts per key under two clocks, as a running sum over ``+1``/``-1`` points.

An event counts for its key from the moment it is known until seven days after it happened. Each event
therefore adds one at the start of that interval and takes one away at its end, and a count at an instant
is the running sum up to it. That replaces a self join of each row with its key's history.

Two states are asked for at two instants (``history`` is another event of the same key):

* event row, at ``created_at``: history created strictly before, less than seven days before, and
  ingested by then. A row cannot see itself or its ties.
* availability row, at ``ingested_at``, for events not dated after their ingestion: history ingested by
  then, itself and its ties included, created less than seven days before, and likewise not future-dated.

The sum has two levels (``chunks``): rows are placed by key and day, with a bare copy where their event expires;
points are summed within the day, beginning with the totals of the key's earlier days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators import chunks

EVENT_ROW, AVAILABILITY_ROW = 0, 1

# Running sums, and what is gathered from the points of one instant.
_STATE = ("event_n", "event_clicks", "available_n", "available_clicks")
_AT_INSTANT = {"has_event": F.max, "has_available": F.max, "first_ingested": F.min}
# A point asks for the counts at its row's instant, ends an event's interval, or begins one that could not
# begin with an asking row.
_ASK, _END, _BEGIN = 0, 1, 2


def score_rows(events: DataFrame) -> DataFrame:
    """One row per event and kind, at the instant the kind asks for. A narrow step: no exchange."""
    created, ingested, kind = F.col("created_at"), F.col("ingested_at"), F.col("kind")
    each = events.withColumn("kind", F.explode(F.array(F.lit(EVENT_ROW), F.lit(AVAILABILITY_ROW))))
    return each.where((kind == EVENT_ROW) | (ingested >= created)).withColumn(
        "event_timestamp", F.when(kind == EVENT_ROW, created).otherwise(ingested)
    )


def add_counts(rows: DataFrame, key: str, prefix: str, chunk_seconds: int = chunks.CHUNK_SECONDS) -> DataFrame:
    """Score rows with ``{prefix}_event_count_7d`` and ``{prefix}_click_count_7d`` of their key.

    Rows carry their other columns through the windows, so nothing is joined back. Both kinds of row must be there,
    as each brings part of its event's points.
    """
    others = [c for c in rows.columns if c != key]
    has_row = F.col("_row").isNotNull()
    carries_row = F.when(F.col("step") == _ASK, F.col("_row")).alias("_row")
    points = _points(_placed(rows, key, chunk_seconds, F.struct(*others).alias("_row")), chunk_seconds, carries_row)
    # The default frame is a RANGE up to the current instant: ties see one value.
    so_far = chunks.within("at")
    summed = _with_carried(points, has_row).withColumns({c: F.sum(c).over(so_far) for c in _STATE}).where(has_row)
    return _of_kind(summed.select(chunks.given_key(key), "_row.*", *_STATE), prefix)


def _of_kind(rows: DataFrame, prefix: str) -> DataFrame:
    """The pair of running sums that the row's kind asks for, under the feature names."""
    is_event = F.col("kind") == EVENT_ROW
    n = F.when(is_event, F.col("event_n")).otherwise(F.col("available_n"))
    clicks = F.when(is_event, F.col("event_clicks")).otherwise(F.col("available_clicks"))
    named = {f"{prefix}_event_count_7d": n, f"{prefix}_click_count_7d": clicks}
    return rows.withColumns(named).drop(*_STATE)


def _expiry() -> Column:
    return F.col("created_at") + F.expr("INTERVAL '7' DAY")


def _tick_after() -> Column:
    return F.col("created_at") + F.expr("INTERVAL '0.000001' SECOND")


def _placed(rows: DataFrame, key: str, chunk_seconds: int, *row: Column) -> DataFrame:
    """Score rows by key and chunk: one copy per chunk their points fall into, with ``_row``, if any, where they ask."""
    asks = chunks.chunk(F.col("event_timestamp"), chunk_seconds)
    ends, begins = chunks.chunk(_expiry(), chunk_seconds), chunks.chunk(_tick_after(), chunk_seconds)
    is_event = F.col("kind") == EVENT_ROW
    into = F.when(is_event, F.array_distinct(F.array(asks, ends, begins))).otherwise(F.array(asks))
    each = rows.select("*", *row).withColumns(chunks.key_columns(key)).withColumn(chunks.CHUNK, F.explode(into))
    here = [F.when(F.col(chunks.CHUNK) == asks, F.col("_row")).alias("_row")] if row else []
    return each.select(*chunks.PLACE, "kind", "created_at", "ingested_at", "clicked", *here).repartition(*chunks.PLACE)


def _points(placed: DataFrame, chunk_seconds: int, *extra: Column) -> DataFrame:
    """The points of the rows in their chunks, three or four per event: at creation, at ingestion, at expiry, and one
    tick after creation for an event ingested by then.

    The availability row's own point begins the event's intervals. ``extra`` columns may use ``step``.
    """
    created, ingested = F.col("created_at"), F.col("ingested_at")
    kind, step, at = F.col("kind"), F.col("step"), F.col("at")
    known = ingested < _expiry()
    begins = (step == _ASK) & (kind == AVAILABILITY_ROW) & known
    event_n = F.when((begins & (ingested > created)) | (step == _BEGIN), 1).when(step == _END, -1).otherwise(0)
    available_n = F.when(begins, 1).when((step == _END) & (ingested >= created), -1).otherwise(0)
    steps = F.when(kind == EVENT_ROW, F.array(F.lit(_ASK), F.lit(_END), F.lit(_BEGIN))).otherwise(F.array(F.lit(_ASK)))
    asked_at = F.when(kind == EVENT_ROW, created).otherwise(ingested)
    no_click = F.lit(0)
    return (
        placed.withColumn("step", F.explode(steps))
        .withColumn("at", F.when(step == _ASK, asked_at).when(step == _END, _expiry()).otherwise(_tick_after()))
        .where((step == _ASK) | ((step == _END) & known) | ((step == _BEGIN) & (ingested <= created)))
        .where(chunks.chunk(at, chunk_seconds) == F.col(chunks.CHUNK))
        .select(
            *chunks.PLACE,
            "at",
            event_n.cast("long").alias("event_n"),
            F.when(F.col("clicked"), event_n).otherwise(no_click).cast("long").alias("event_clicks"),
            available_n.cast("long").alias("available_n"),
            F.when(F.col("clicked"), available_n).otherwise(no_click).cast("long").alias("available_clicks"),
            *extra,
        )
    )


def _with_carried(points: DataFrame, asked: Column) -> DataFrame:
    """The points and, first in each chunk, one without an instant that holds the totals of the key's earlier chunks."""

    def carry(name: str, earlier: Window) -> Column:
        return F.coalesce(F.sum(name).over(earlier), F.lit(0))

    totals = chunks.carried(points, {c: F.sum(c) for c in _STATE}, carry, asked)
    return points.unionByName(totals, allowMissingColumns=True)


def instant_state(events: DataFrame, key: str, chunk_seconds: int = chunks.CHUNK_SECONDS) -> DataFrame:
    """Both counts at every (key, instant) somebody asks about, one row each.

    Columns: key, ``at``, the event-row and availability-row counts, which of the two kinds occur there,
    and the earliest ingestion among the events created there.
    """
    asks, kind = F.col("step") == _ASK, F.col("kind")
    rows = score_rows(events.select(key, "created_at", "ingested_at", "clicked"))
    points = _points(
        _placed(rows, key, chunk_seconds),
        chunk_seconds,
        (asks & (kind == EVENT_ROW)).cast("int").alias("has_event"),
        (asks & (kind == AVAILABILITY_ROW)).cast("int").alias("has_available"),
        F.when(asks & (kind == EVENT_ROW), F.col("ingested_at")).alias("first_ingested"),
    )
    asked = (F.col("has_event") == 1) | (F.col("has_available") == 1)
    so_far = chunks.within("at")
    here = so_far.rangeBetween(Window.currentRow, Window.currentRow)
    state = (
        _with_carried(points, asked).withColumns(
            {
                **{c: F.sum(c).over(so_far) for c in _STATE},
                **{c: rule(c).over(here) for c, rule in _AT_INSTANT.items()},
                "_previous": F.lag("at").over(so_far),
            }
        )
        # The frames give all points of an instant the same values; keep the first.
        .where(F.col("_previous").isNull() | (F.col("_previous") != F.col("at")))
        .where(asked)
        .drop("_previous")
    )
    return state.select(chunks.given_key(key), "at", *_STATE, *_AT_INSTANT)
