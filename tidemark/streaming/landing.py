"""Append the bus to the day-partitioned lake, exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.envelopes import parse_lake_events
from tidemark.sources import lake
from tidemark.streaming.batches import run


def land(
    wire: DataFrame, path: str, checkpoint: str, ingested_at: Column | None = None, once: bool = False
) -> StreamingQuery:
    """Land valid events as files below ``path``; one commit per micro-batch.

    The file sink's own log names the files of each committed batch, so a batch that fails half way or is
    replayed is seen once by readers of the folder.
    """
    rows = lake.with_day(parse_lake_events(wire, ingested_at))
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", lake.MAX_RECORDS_PER_FILE)
        .partitionBy(lake.DAY)
    )
    return run(writer, once)


def land_table(
    wire: DataFrame,
    table: str,
    checkpoint: str,
    ingested_at: Column | None = None,
    once: bool = False,
    name: str = "stream",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Land into the catalog table, which batch loads may share (``lake.insert``).

    Each micro-batch writes partitions of its own, named after the stream and the batch, so one that is replayed
    replaces itself. ``name`` must be another for each stream into a table. A format that commits atomically by
    itself takes the rows as they come.
    """
    rows = parse_lake_events(wire, ingested_at)
    if fmt == "iceberg":
        writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        if not once:
            return writer.trigger(processingTime="10 seconds").toTable(table)
        query = writer.trigger(availableNow=True).toTable(table)
        query.awaitTermination()
        return query

    def put(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            lake.insert(kept, table, f"{name}-{batch_id:010d}")
        finally:
            kept.unpersist()

    return run(rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint), once)
