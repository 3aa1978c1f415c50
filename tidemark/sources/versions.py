"""A table that is replaced whole without its readers noticing.

Every rewrite goes to a folder of its own. A journal beside the folders says which of them are begun, published and
dropped; a journal entry is one appended row, so a version is published by one atomic commit after all its rows are
there. Readers take the newest published version and keep reading its files whatever happens next: a version is
emptied only once ``keep`` newer ones are published. A rewrite that dies leaves a begun folder that nobody reads and
that is emptied with the old ones. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_JOURNAL = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("label", T.LongType()),
        T.StructField("at", T.TimestampType()),
    ]
)
BEGUN, PUBLISHED, DROPPED = "begun", "published", "dropped"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        """``keep`` versions, the newest included, stay readable; at least one."""
        self.spark, self.path, self.keep = spark, path.rstrip("/"), max(1, keep)

    def replace(self, rows: DataFrame, label: int | None = None, beside: Callable[[int], None] | None = None) -> str:
        """Publish the rows as the table's content; returns the folder of the new version.

        The rows may come from the table itself. ``label`` is published with them. ``beside`` is called with the
        number of the version before it is published, for what must be there with it; numbers are never used twice.
        """
        number = max((r["number"] for r in self._entries()), default=0) + 1
        folder = f"version={number:08d}-{uuid.uuid4().hex[:8]}"
        self._enter(number, folder, BEGUN)
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        if beside is not None:
            beside(number)
        self._enter(number, folder, PUBLISHED, label)
        self._drop_old(rows.schema)
        return f"{self.path}/{folder}"

    def folder(self) -> str | None:
        """Folder of the newest published version."""
        published = [(r["number"], r["folder"]) for r in self._entries() if r["state"] == PUBLISHED]
        return f"{self.path}/{max(published)[1]}" if published else None

    def label(self) -> int | None:
        """Label of the newest published version."""
        published = [(r["number"], r["label"]) for r in self._entries() if r["state"] == PUBLISHED]
        return max(published)[1] if published else None

    def published(self) -> list[int]:
        """Numbers of all versions that were ever published."""
        return sorted({r["number"] for r in self._entries() if r["state"] == PUBLISHED})

    def exists(self) -> bool:
        return self.folder() is not None

    def current(self, schema: T.StructType | None = None) -> DataFrame:
        """The newest published version; with ``schema`` nothing is inferred."""
        folder = self.folder()
        if folder is None:
            raise LookupError(f"{self.path} has no published version")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(folder)

    def _entries(self) -> list:
        """The journal: some rows per rewrite."""
        try:
            return self.spark.read.schema(_JOURNAL).parquet(f"{self.path}/_journal").collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def _enter(self, number: int, folder: str, state: str, label: int | None = None) -> None:
        entry = self.spark.range(1).select(
            F.lit(number).cast("long").alias("number"), F.lit(folder).alias("folder"), F.lit(state).alias("state"),
            F.lit(label).cast("long").alias("label"), F.current_timestamp().alias("at"),
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_journal")

    def _drop_old(self, schema: T.StructType) -> None:
        entries = self._entries()
        newest = sorted({r["number"] for r in entries if r["state"] == PUBLISHED})[-self.keep :]
        dropped = {r["folder"] for r in entries if r["state"] == DROPPED}
        for number, folder in sorted({(r["number"], r["folder"]) for r in entries if r["state"] == BEGUN}):
            if number < newest[0] and folder not in dropped:
                # Overwriting with nothing frees the space.
                self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.path}/{folder}")
                self._enter(number, folder, DROPPED)
