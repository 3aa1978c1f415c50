"""Live ten-second counts that keep too-late events instead of dropping them.

Spark's own windowed aggregate drops what is behind the watermark. Here each record is judged by the records that
arrived before it in all partitions of the topic, those of earlier batches by their recorded peaks and those of its
own batch by arrival, so it does not matter how the records were cut into batches as long as they come in the order
of arrival. The mark is that of the slowest partition that is not idle, and it never falls. Records without an
arrival time count in the order of partition and offset, those without an offset in the order in which they are read.

Partial counts and marks of a batch are one write to one table, late events whole another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import windows
from tidemark.operators.envelopes import parse_events
from tidemark.streaming.batches import BatchTable, run, total

# A row is a partial count, or what is known of a source after the batch.
_STATE = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("start_ms", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("peak_ms", T.LongType()),
        T.StructField("seen_ms", T.LongType()),
        T.StructField("mark_ms", T.LongType()),
    ]
)
_LATE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


class WindowedCounts:
    """Counts, late events and the marks of one stream, below one directory."""

    def __init__(
        self,
        spark: SparkSession,
        directory: str,
        out_of_order_ms: int = windows.OUT_OF_ORDER_MS,
        checkpoint: str | None = None,
        fold_every: int = 360,
        idle_ms: int = windows.IDLE_MS,
    ):
        self.spark, self.out_of_order_ms, self.idle_ms, self.fold_every = spark, out_of_order_ms, idle_ms, fold_every
        self.checkpoint = checkpoint or f"{directory}/checkpoint"
        self.state = BatchTable(spark, f"{directory}/counts", _STATE, fold_every)
        self.late_table = BatchTable(spark, f"{directory}/late", _LATE, fold_every)

    def start(self, wire: DataFrame, once: bool = False) -> StreamingQuery:
        """Count a stream of envelopes; the checkpoint makes a restart continue where the last run ended."""
        writer = parse_events(wire).writeStream.foreachBatch(self._take)
        return run(writer.option("checkpointLocation", self.checkpoint), once)

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        placed = _placed(batch).withColumn("ms", F.unix_millis("created_at")).persist()
        before, mark = self._known(batch_id)
        seen = placed.groupBy("source").agg(F.max("ms").alias("peak_ms"), F.max("arrival_ms").alias("seen_ms"))
        found = {r["source"]: (r["peak_ms"], r["seen_ms"]) for r in seen.collect()}
        sources = {name: before.get(name, (None, None)) for name in {*before, *found}}
        if not found:  # nothing arrived, nothing changes
            placed.unpersist()
            return
        marked = windows.merged_watermark(placed, sources, mark, self.out_of_order_ms, self.idle_ms)
        judged = windows.judge(marked).persist()
        # One row per type, window and verdict: small whatever the size of the batch.
        groups = judged.groupBy("event_type", "start_ms", "late").agg(F.count("*").alias("n"), F.max("watermark_ms").alias("mark_ms"))
        groups = groups.persist()
        try:
            top = groups.agg(F.max("mark_ms")).first()[0]
            after = [(name, *_later(sources[name], found.get(name)), top) for name in sorted(sources)]
            known = self.spark.createDataFrame(after, "source string, peak_ms long, seen_ms long, mark_ms long")
            counted = total(groups.where(~F.col("late")), ("event_type", "start_ms"))
            self.state.put(counted.unionByName(known, allowMissingColumns=True).select(*_STATE.names), batch_id)
            self.late_table.put(windows.late_events(judged), batch_id)
        finally:
            for kept in (groups, judged, placed):
                kept.unpersist()
        if batch_id and batch_id % self.fold_every == 0:
            self.fold(batch_id - 1)

    def _known(self, batch_id: int) -> tuple[dict[str, tuple[int, int | None]], int | None]:
        """Peak and last arrival of each source, and the mark, before a batch, also when it is replayed.

        Each batch records them anew, so only the one before is read: a row per partition of the topic.
        """
        rows = self.state.before(batch_id).where("source IS NOT NULL").collect()
        marks = [r["mark_ms"] for r in rows if r["mark_ms"] is not None]
        return {r["source"]: (r["peak_ms"], r["seen_ms"]) for r in rows}, max(marks, default=None)

    def counts(self) -> DataFrame:
        """Count per type and window as of now; a window's row is updated by allowed late events."""
        return total(self.state.rows().where("event_type IS NOT NULL"), ("event_type", "start_ms")).select(
            "event_type",
            windows.millis_to_ntz(F.col("start_ms")).alias("window_start"),
            windows.millis_to_ntz(F.col("start_ms") + F.lit(windows.WINDOW_MS)).alias("window_end"),
            "n",
        )

    def late(self) -> DataFrame:
        return self.late_table.rows()

    def fold(self, upto: int) -> None:
        """Merge the partial counts and marks of the batches up to ``upto``, all of them finished.

        Runs by itself every ``fold_every`` batches, so that the folders of a long stream stay few. Windows that the
        mark has passed, lateness included, are written once more and never again. Late events stay as they were
        written: only batches that had some left a folder.
        """
        sources, mark = self._known(upto + 1)
        # No later mark is below that of the slowest source, idle or not, nor below the last one.
        marks = [min(peak for peak, _ in sources.values()) - self.out_of_order_ms] if sources else []
        mark = max([*marks, *([] if mark is None else [mark])], default=None)
        closed = F.lit(mark).cast("long") >= F.col("start_ms") + F.lit(windows.WINDOW_MS - 1 + windows.LATENESS_MS)
        self.state.fold(_merged, upto, closed)


def _later(before: tuple[int | None, int | None], found: tuple[int, int | None] | None) -> tuple[int | None, int | None]:
    def most(*values: int | None) -> int | None:
        return max((v for v in values if v is not None), default=None)

    return before if found is None else (most(before[0], found[0]), most(before[1], found[1]))


def _merged(rows: DataFrame) -> DataFrame:
    counts = total(rows.where("event_type IS NOT NULL"), ("event_type", "start_ms"))
    known = rows.where("source IS NOT NULL").groupBy("source").agg(*[F.max(c).alias(c) for c in ("peak_ms", "seen_ms", "mark_ms")])
    return counts.unionByName(known, allowMissingColumns=True).select(*_STATE.names)


def _placed(batch: DataFrame) -> DataFrame:
    """The batch with a source, an offset and an arrival time, NULL if unknown, on every record."""
    own = {c: F.col(c) if c in batch.columns else F.lit(None) for c in ("topic", "partition", "offset", "timestamp")}
    as_read = F.monotonically_increasing_id()
    number = F.lpad(F.coalesce(own["partition"], F.lit(0)).cast("string"), 10, "0")
    return batch.withColumns({
        "source": F.concat(F.coalesce(own["topic"].cast("string"), F.lit("")), F.lit("/"), number),
        "offset": F.coalesce(own["offset"], as_read).cast("long"),
        "arrival_ms": F.unix_millis(own["timestamp"].cast("timestamp")),
    })
