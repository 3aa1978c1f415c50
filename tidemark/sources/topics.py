"""The bus as a stream: one text value per record, from a broker or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)


def stream(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """Streaming ``value`` text, with arrival time, ``topic``, ``partition`` and ``offset`` where the source has them.

    Two topics of one subscription have partitions of the same numbers; only the topic tells them apart.

    Each query keeps its own checkpoint and so its own place in the topic. A broker's ``startingOffsets``
    (set it to ``latest`` to begin at the tail, ``earliest`` to lose nothing) counts only on the first
    start; after that the checkpoint decides.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        records = reader.load()
        return records.select(F.col("value").cast("string").alias("value"), "timestamp", "topic", "partition", "offset")
    if fmt == "text":
        return reader.load(path).select("value")
    return reader.schema(RECORD).load(path).select("value", "timestamp", "topic", "partition", "offset")


def bodies(spark: SparkSession, path: str) -> DataFrame:
    """Request bodies from text files, one document per line."""
    return spark.read.text(path)
