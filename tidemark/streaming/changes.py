"""Follow a change topic: latest image per key, merged on read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import changes
from tidemark.streaming.batches import BatchTable, run

_LATEST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
_REFUSED = T.StructType(
    [
        T.StructField("lsn", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


class FollowedTable:
    """Each batch leaves its last image per key; the state is the last of those, deletes removed.

    A batch writes what it changed and never rewrites the table. Every ``fold_every`` batches the older ones are
    merged, so a read merges few folders however old the stream is. Refused records are kept whole.
    """

    def __init__(self, spark: SparkSession, directory: str, checkpoint: str | None = None, fold_every: int = 360):
        self.checkpoint, self.fold_every = checkpoint or f"{directory}/checkpoint", fold_every
        self.log = BatchTable(spark, f"{directory}/images", _LATEST, fold_every)
        self.refused_log = BatchTable(spark, f"{directory}/refused", _REFUSED, fold_every)

    def start(self, records: DataFrame, once: bool = False) -> StreamingQuery:
        """Follow streaming records; without an ``lsn`` column the position is read from the records."""
        writer = changes.judge(records).writeStream.foreachBatch(self._take)
        return run(writer.option("checkpointLocation", self.checkpoint), once)

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        self.refused_log.put(batch.where("reason IS NOT NULL"), batch_id)
        good = batch.where("reason IS NULL").select(*_LATEST.names)
        self.log.put(changes.latest_images(good), batch_id)
        if batch_id and batch_id % self.fold_every == 0:
            self.fold(batch_id - 1)

    def state(self) -> DataFrame:
        return changes.current_state(changes.latest_images(self.log.rows()))

    def refused(self) -> DataFrame:
        return self.refused_log.rows()

    def fold(self, upto: int) -> None:
        self.log.fold(lambda rows: changes.latest_images(rows).select(*_LATEST.names), upto)
