"""The append-only event table, partitioned by the UTC day of ``created_at``."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schemas import EVENT_COLUMNS, LAKE_EVENT, require_columns

NAMESPACE, TABLE = "event_lake", "events_raw"
DAY = "created_day"
# Which load or micro-batch brought the rows: a partition of the catalog table, so that it can be written again.
LANDED = "landed_by"
# Fixed value: target size of a data file, 128 MiB.
TARGET_FILE_BYTES = 134_217_728
# Compressed bytes per event until a write has been measured.
GUESSED_ROW_BYTES = 16.0
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
MAX_RECORDS_PER_FILE = int(TARGET_FILE_BYTES / GUESSED_ROW_BYTES)


def ensure_table(
    spark: SparkSession, location: str, namespace: str = NAMESPACE, table: str = TABLE, fmt: str = "parquet"
) -> str:
    """Create namespace and table where missing; a second caller adopts what the first one made."""
    name = f"{namespace}.{table}"
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in LAKE_EVENT
    )
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace} LOCATION '{location}'")
    if fmt == "iceberg":
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING iceberg PARTITIONED BY (days(created_at)) "
            f"TBLPROPERTIES ('write.target-file-size-bytes' = '{TARGET_FILE_BYTES}')"
        )
    else:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {DAY} DATE, {LANDED} STRING) USING {fmt} "
            f"PARTITIONED BY ({DAY}, {LANDED}) LOCATION '{location}/{table}'"
        )
    return name


def current_events(spark: SparkSession, namespace: str = NAMESPACE, table: str = TABLE) -> DataFrame:
    """The five event columns of the registered table as it is now."""
    name = f"{namespace}.{table}"
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name} is not registered")
    return spark.table(name).select(*EVENT_COLUMNS)


def with_day(events: DataFrame) -> DataFrame:
    """Contract columns in contract order, then the partition day."""
    require_columns(events, EVENT_COLUMNS)
    return events.select(*EVENT_COLUMNS, F.to_date("created_at").alias(DAY))


def refuse_stream_folder(spark: SparkSession, path: str) -> None:
    """A folder that a stream lands in is read by the stream's own log, which would hide a batch written beside it."""
    try:
        spark.read.text(f"{path.rstrip('/')}/_spark_metadata")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return
        raise
    raise ValueError(f"{path} belongs to a landing stream: land the batch through it, or through a catalog table")


def bytes_per_row(table: DataFrame) -> float | None:
    """Compressed bytes per row of a table's latest day, from the sizes of its files; NULL without rows.

    Only the partition column and the files' own facts are read.
    """
    latest = table.agg(F.max(DAY)).first()[0]
    if latest is None:
        return None
    files = table.where(F.col(DAY) == latest).groupBy("_metadata.file_path").agg(
        F.count("*").alias("n"), F.first("_metadata.file_size").alias("size")
    )
    rows, size = files.agg(F.sum("n"), F.sum("size")).first()
    return size / rows if rows else None


def in_files(rows: DataFrame, row_bytes: float, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rows with a day, dealt to one task per file: a day gets as many files of the target size as its rows fill.

    Rows are counted per day first. A day with a third of all rows is cut like any other; rows go to its files by
    their content, so a task that runs again writes the same file.
    """
    days = {r[DAY]: r["n"] for r in rows.groupBy(DAY).agg(F.count("*").alias("n")).collect()}
    if not days:
        return rows
    plan, files = [], 0
    for day, n in sorted(days.items()):
        plan.append((day, files, max(1, round(n * row_bytes / target_bytes))))
        files += plan[-1][2]
    # One row per calendar day of the batch.
    plan = F.broadcast(rows.sparkSession.createDataFrame(plan, f"{DAY} date, _first int, _files int"))
    spread = F.pmod(F.xxhash64(*[c for c in rows.columns if c != DAY]), F.col("_files"))
    placed = rows.join(plan, DAY).withColumn("_file", (F.col("_first") + spread).cast("int"))
    return placed.repartitionById(files, F.col("_file")).select(*rows.columns)


def append(events: DataFrame, path: str, target_bytes: int = TARGET_FILE_BYTES) -> str:
    """Append a batch in files of about the target size, by what a row took in the writes before."""
    spark = events.sparkSession
    refuse_stream_folder(spark, path)
    try:
        measured = bytes_per_row(spark.read.parquet(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        measured = None
    placed = in_files(with_day(events), measured or GUESSED_ROW_BYTES, target_bytes)
    placed.write.mode("append").partitionBy(DAY).parquet(path)
    return path


def insert(events: DataFrame, table: str, landed_by: str, target_bytes: int = TARGET_FILE_BYTES) -> None:
    """Put a load or micro-batch into the catalog table; the same ``landed_by`` again replaces what it brought.

    Streams and batch loads may share the table: each replaces its own partitions only.
    """
    spark = events.sparkSession
    rows = with_day(events)
    placed = in_files(rows, bytes_per_row(spark.table(table)) or GUESSED_ROW_BYTES, target_bytes)
    # A write into a catalog table takes this from the session only; without it the whole table would be replaced.
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        placed.withColumn(LANDED, F.lit(landed_by)).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(_OVERWRITE, before)


def scan(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Event columns of the days asked for; both bounds are inclusive and prune partitions."""
    return _days(spark.read.parquet(path), first, last).select(*EVENT_COLUMNS)


def day_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per partition day. Only the partition column is read."""
    return spark.read.parquet(path).groupBy(DAY).agg(F.count("*").alias("n"))


def _days(table: DataFrame, first: date | None, last: date | None) -> DataFrame:
    if first is not None:
        table = table.where(F.col(DAY) >= F.lit(first))
    if last is not None:
        table = table.where(F.col(DAY) <= F.lit(last))
    return table
