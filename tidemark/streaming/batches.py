"""A table written batch by batch from ``foreachBatch``, partitioned by batch, so that a replayed batch replaces itself.

Batches lie below ``batches/era=E/batch_id=N`` of one plain Parquet table; writing batch N again overwrites its
partition alone. ``fold`` merges all batches up to N into one published version (``VersionedTable``) and empties the
eras that lie behind it, so that reads do not slow down with the age of the stream. Rows that can be told to be
final go to ``settled`` at a fold and are never merged or rewritten again; they count if the fold was published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.versions import VersionedTable

ERA, BATCH, FOLD = "era", "batch_id", "fold"


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, era_batches: int = 360):
        self.spark, self.path, self.schema, self.era_batches = spark, path.rstrip("/"), schema, era_batches
        self.folded = VersionedTable(spark, f"{self.path}/folded")

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch, or write it again. A batch without rows leaves none."""
        placed = rows.select(*self.schema.names).withColumns(
            {ERA: F.lit(batch_id // self.era_batches), BATCH: F.lit(batch_id).cast("long")}
        )
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(ERA, BATCH).parquet(f"{self.path}/batches")

    def before(self, batch_id: int) -> DataFrame:
        """The rows of the last batch before this one that has any, or of the fold it went into. Enough where rows
        are cumulative."""
        upto = self._upto()
        earlier = self._batches().where(F.col(BATCH) < batch_id)
        if upto is not None:
            earlier = earlier.where(F.col(BATCH) > upto)
        last = earlier.agg(F.max(BATCH)).first()[0]
        if last is not None:
            return earlier.where(F.col(BATCH) == last).select(*self.schema.names)
        return self._open() if upto is not None and upto < batch_id else self._none()

    def rows(self) -> DataFrame:
        """Everything written so far: the newest fold, the batches after it and what was settled up to it."""
        upto = self._upto()
        if upto is None:
            return self._batches().select(*self.schema.names)
        later = self._batches().where(F.col(BATCH) > upto).select(*self.schema.names)
        return later.unionByName(self._open()).unionByName(self._settled())

    def fold(self, merge: Callable[[DataFrame], DataFrame], upto: int, final: Column | None = None) -> None:
        """Replace the batches up to ``upto`` by their merge, without the rows that are ``final``, which are put
        aside for good. Run it between batches."""
        done = self._upto()
        if done is not None and upto <= done:
            return
        batches = self._batches().where(F.col(BATCH) <= upto)
        if done is not None:
            batches = batches.where(F.col(BATCH) > done)
        merged = merge(batches.select(*self.schema.names).unionByName(self._open()))
        is_final = F.coalesce(final, F.lit(False)) if final is not None else F.lit(False)

        def settle(number: int) -> None:
            placed = merged.where(is_final).withColumn(FOLD, F.lit(number))
            writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(FOLD).parquet(f"{self.path}/settled")

        self.folded.replace(merged.where(~is_final), label=upto, beside=settle if final is not None else None)
        first = 0 if done is None else (done + 1) // self.era_batches
        for era in range(first, (upto + 1) // self.era_batches):
            # Overwriting an era with no partition at all leaves an empty folder.
            nothing = self.spark.createDataFrame([], T.StructType([*self.schema, T.StructField(BATCH, T.LongType())]))
            writer = nothing.write.mode("overwrite").option("partitionOverwriteMode", "static")
            writer.partitionBy(BATCH).parquet(f"{self.path}/batches/{ERA}={era}")

    def _upto(self) -> int | None:
        return self.folded.label()

    def _open(self) -> DataFrame:
        return self.folded.current(self.schema) if self.folded.exists() else self._none()

    def _settled(self) -> DataFrame:
        """What published folds put aside; a fold that died left rows under a number that was never published."""
        settled = self._table("settled", T.StructField(FOLD, T.IntegerType()))
        return settled.where(F.col(FOLD).isin(self.folded.published())).select(*self.schema.names)

    def _batches(self) -> DataFrame:
        return self._table("batches", T.StructField(ERA, T.IntegerType()), T.StructField(BATCH, T.LongType()))

    def _table(self, folder: str, *partitions: T.StructField) -> DataFrame:
        schema = T.StructType([*self.schema, *partitions])
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)


def run(writer, once: bool, interval: str = "10 seconds"):
    """Start a query every ten seconds, or over what is there now and then stop."""
    if once:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.trigger(processingTime=interval).start()


def total(rows: DataFrame, by: tuple[str, ...], count: str = "n") -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(count).alias(count))
