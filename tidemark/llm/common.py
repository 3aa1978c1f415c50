"""What several operators of this package share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import configure, shared_dir

# Documents per Arrow batch: long texts must not add up to a batch that no worker can hold.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, computed once and read again from the shared folder: lost executors do not lose them."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_row_keys(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written, each with a key of its own that stays the same however often they are read, and the
    name of the key's column, which is none of the input's."""
    row = fresh_name(df, "_row_key")
    return written(df.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def id_and_bytes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of the text, and no other column of the input."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded_sample(df: DataFrame, *key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, the same ones in every run: those with the smallest hash of the key columns.

    Hashes of different keys are even, so a first cut at twice the share that is needed leaves little to put in
    order. Where keys repeat, the cut may leave too few; then all rows are put in order.
    """
    space = 1 << 40
    place = F.pmod(F.xxhash64(*key), F.lit(space))
    count = df.count()
    if count > 4 * rows:
        cut = df.where(place < space * 2 * rows // count)
        if cut.count() >= rows:
            df = cut
    return df.orderBy(place, *key).limit(rows)


def blocks_for(rows: int, rows_per_block: int, least: int) -> int:
    return max(least, math.ceil(rows / rows_per_block))
