"""The gateway as a stream: request bodies in, bus records and refused bodies out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import gateway
from tidemark.streaming.batches import run


def accept(
    bodies: DataFrame,
    checkpoint: str,
    options: dict[str, str],
    fmt: str = "kafka",
    path: str | None = None,
    received_at: Column | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Publish accepted bodies, keyed by user, each user's in the order in which they came.

    A file topic holds each record once: a batch that is replayed replaces its files. A broker gets it at least once.
    """
    records = gateway.serialize(gateway.normalize(bodies, received_at))

    def put(batch: DataFrame, batch_id: int) -> None:
        gateway.publish(batch, options, fmt, path, batch_id)

    return run(records.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint), once)


def refuse(bodies: DataFrame, checkpoint: str, path: str, once: bool = False) -> StreamingQuery:
    """Keep refused bodies, whole, with outcome, status and reason. Its own query, so its own place in the source."""
    refused = gateway.quarantine(bodies).select("value", "outcome", "status", "reason")
    writer = refused.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return run(writer.option("path", path).partitionBy("outcome"), once)
