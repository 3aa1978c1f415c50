"""Gateway side of the bus: check request bodies, normalize, stamp, key and serialize them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import envelope, text

ACCEPTED, INVALID, MALFORMED, TOO_LARGE = "accepted", "invalid", "malformed", "too_large"
# The response status of each outcome.
STATUS = {ACCEPTED: 202, INVALID: 400, MALFORMED: 400, TOO_LARGE: 413}
TOPIC_PARTITIONS = 3


def inspect_bodies(bodies: DataFrame, value: str = "value") -> DataFrame:
    """Bodies with the three text fields, the problem list and the routing outcome.

    The order of the checks is size, one well-formed document of the right types, validation. JSON null
    decodes to an empty event and so fails validation, not parsing. Ordinary bodies take one typed parse; only the
    others are taken apart as variants.
    """
    raw = F.col(value)
    plain, docs, known = F.col("_plain"), F.col("_docs"), F.col("_known")
    document = F.coalesce(F.try_element_at(docs, F.lit(1)), _no_fields())
    parsed = (
        bodies.withColumn("_fits", F.coalesce(F.octet_length(raw) <= envelope.MAX_BODY_BYTES, F.lit(True)))
        .withColumn("_plain", F.when(F.col("_fits"), envelope.decode_ordinary(raw)))
        .withColumn("_docs", F.when(F.col("_fits") & plain.isNull(), envelope.sole_document(raw)))
        .withColumn("_known", F.when(F.size(docs) == 1, envelope.known_fields(document)))
        .withColumn(
            "_readable",
            F.when(
                plain.isNotNull(), plain["created_at"].isNull() | text.is_rfc3339(plain["created_at"])
            ).otherwise(known.isNotNull() & ~envelope.has_wrong_type(known)),
        )
    )

    def field(name: str) -> Column:
        quick = F.when(plain.isNotNull(), F.coalesce(plain[name], F.lit("")))
        return F.when(F.col("_readable"), quick.otherwise(envelope.text_field(known, name)))

    names = ("user_id", "item_id", "event_type")
    fields = parsed.withColumns({f"_{n}": field(n) for n in names})
    checked = fields.withColumn(
        "_problems", F.when(F.col("_readable"), envelope.problems(*[F.col(f"_{n}") for n in names]))
    )
    outcome = (
        F.when(~F.col("_fits"), TOO_LARGE)
        .when(~F.col("_readable"), MALFORMED)
        .when(F.col("_problems") != "", INVALID)
        .otherwise(ACCEPTED)
    )
    found = F.struct(*[F.col(f"_{n}").alias(n) for n in (*names, "problems")], outcome.alias("outcome"))
    return checked.select(*bodies.columns, envelope.computed_once(found).alias("_found")).select(
        *bodies.columns, "_found.*"
    )


def _no_fields() -> Column:
    return F.expr("CAST(map() AS map<string,variant>)")


def validate(bodies: DataFrame, value: str = "value") -> DataFrame:
    """Well-formed bodies with the text of their validation error, NULL when valid."""
    checked = inspect_bodies(bodies, value).where(F.col("outcome").isin(ACCEPTED, INVALID))
    message = F.concat(F.lit("invalid event: "), F.col("problems"))
    return checked.withColumn("error", F.when(F.col("problems") != "", message))


def normalize(bodies: DataFrame, received_at: Column | None = None, value: str = "value") -> DataFrame:
    """Accepted events with trimmed ids and the server's clock; a client time is never used."""
    clock = F.current_timestamp() if received_at is None else received_at
    accepted = inspect_bodies(bodies, value).where(F.col("outcome") == ACCEPTED)
    return (
        accepted.withColumn("user_id", text.trim_space(F.col("user_id")))
        .withColumn("item_id", text.trim_space(F.col("item_id")))
        .withColumn("created_at", clock)
        .drop("problems", "outcome")
    )


def quarantine(bodies: DataFrame, value: str = "value") -> DataFrame:
    """Refused bodies, whole, with outcome, status and reason."""
    refused = inspect_bodies(bodies, value).where(F.col("outcome") != ACCEPTED)
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    reason = (
        F.when(F.col("outcome") == TOO_LARGE, F.lit("body exceeds 64 KiB"))
        .when(F.col("outcome") == MALFORMED, F.lit("malformed JSON body"))
        .otherwise(F.concat(F.lit("invalid event: "), F.col("problems")))
    )
    return refused.withColumn("status", status[F.col("outcome")]).withColumn("reason", reason)


def outcome_counts(bodies: DataFrame, value: str = "value") -> DataFrame:
    return inspect_bodies(bodies, value).groupBy("outcome").agg(F.count("*").alias("n"))


def serialize(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bus records: key is the user id, value the JSON envelope."""
    value = envelope.wire_text(F.col("user_id"), F.col("item_id"), F.col("event_type"), F.col("created_at"))
    return events.select(*keep, F.col("user_id").alias("key"), value.alias("value"))


def topic_partition(key: Column, partitions: int = TOPIC_PARTITIONS) -> Column:
    """Partition of a record from its key alone, so that all records of a user share one partition."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(partitions)).cast("int")


def publish(
    records: DataFrame,
    options: dict[str, str],
    fmt: str = "kafka",
    path: str | None = None,
    batch_id: int | None = None,
    order: tuple[str, ...] = (),
) -> None:
    """Write bus records, those of a key by one task and in order. The broker partitions by key; files get the same
    rule as a folder column.

    The order is that of the ``order`` columns, else that in which the source delivered the rows. One task writes
    all records of a key because only one writer can keep them in order; a broker's partition is one log as well.
    With ``batch_id`` a file topic keeps each batch in a folder of its own, and a batch written again replaces itself.
    """
    delivered = records.withColumn("_delivered", F.monotonically_increasing_id())
    placed = delivered.withColumn("partition", topic_partition(F.col("key"))).repartition("key")
    # The partition comes first, as the file writer sorts by it and leaves rows alone that are sorted.
    in_order = placed.sortWithinPartitions("partition", "key", *order, "_delivered").drop("_delivered", *order)
    if fmt == "kafka":
        in_order.select("key", "value").write.format("kafka").options(**options).save()
        return
    if batch_id is None:
        in_order.write.format(fmt).options(**options).mode("append").partitionBy("partition").save(path)
        return
    writer = in_order.withColumn("batch_id", F.lit(batch_id)).write.format(fmt).options(**options).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("partition", "batch_id").save(path)
