"""Every query by name. Each takes a session and the folder of the base tables and reads them whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import changes, envelopes, features, gateway, online, windows
from tidemark.plans import registry
from tidemark.schemas import EVENT_COLUMNS, ITEM_FEATURES, USER_FEATURES
from tidemark.session import configure, shared_dir
from tidemark.sources import derived, lake, topics
from tidemark.streaming.changes import FollowedTable
from tidemark.streaming.counts import WindowedCounts
from tidemark.streaming.intake import accept
from tidemark.streaming.landing import land, land_table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared with the SQL checks.
MATERIALIZE_END = "TIMESTAMP_NTZ'2024-01-25 00:00:00'"
MATERIALIZE_DAYS_BEFORE = (8, 1, 0)


def _zoneless(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


# Bus: consumers ---------------------------------------------------------------------------------------


def parse_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = derived.envelopes(spark, sf_dir).drop("ingested_at")
    return _zoneless(envelopes.parse_events(wire), "created_at")


def parse_lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = derived.envelopes(spark, sf_dir)
    rows = envelopes.parse_lake_events(wire, F.col("ingested_at"), keep=("seq",))
    return _zoneless(rows, "created_at", "ingested_at")


def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.event_type_counts(envelopes.parse_events(derived.envelopes(spark, sf_dir)))


# Bus: gateway -----------------------------------------------------------------------------------------


def gateway_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.validate(derived.envelopes(spark, sf_dir)).select("seq", "problems")


def gateway_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = gateway.normalize(derived.envelopes(spark, sf_dir), F.col("ingested_at"))
    return events.select("seq", "user_id", "item_id", F.col("created_at").alias("received_at"))


def gateway_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.outcome_counts(derived.envelopes(spark, sf_dir))


def gateway_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.quarantine(derived.envelopes(spark, sf_dir)).select("seq", "value", "outcome", "status", "reason")


def envelope_serialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = gateway.normalize(derived.envelopes(spark, sf_dir), F.col("ingested_at"))
    return gateway.serialize(events)


def publish_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the accepted events to files and count what each partition of the topic holds per user."""
    events = gateway.normalize(derived.envelopes(spark, sf_dir), F.col("ingested_at"))
    path = shared_dir(spark, "topic")
    gateway.publish(gateway.serialize(events), {}, "parquet", path)
    topic = spark.read.parquet(path)
    return topic.groupBy("partition", F.col("key").alias("user_id")).agg(F.count("*").alias("n"))


# Windows ----------------------------------------------------------------------------------------------


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.judge(windows.arrival_watermark(derived.dense_interactions(spark, sf_dir)))


def arrival_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.arrival_watermark(derived.dense_interactions(spark, sf_dir)).select("seq", "ms", "watermark_ms")


def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_counts(_judged(spark, sf_dir))


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.late_events(_judged(spark, sf_dir)).select("seq", "event_type", "ms")


def window_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_firings(_judged(spark, sf_dir))


def count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_lines(tumbling_counts(spark, sf_dir))


# Lake -------------------------------------------------------------------------------------------------


def lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the interactions in a day-partitioned table and read its event columns back."""
    path = lake.append(derived.interactions(spark, sf_dir), shared_dir(spark, "lake"))
    return lake.scan(spark, path)


def lake_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lake.append(derived.interactions(spark, sf_dir), shared_dir(spark, "lake"))
    return lake.day_counts(spark, path)


# Streams ----------------------------------------------------------------------------------------------


def _counted_stream(spark: SparkSession, sf_dir: str, partition: Column | None = None) -> WindowedCounts:
    """The dense interactions, ten arriving each second, all of them in one delivery of several files.

    They lie in partition 0 of the topic unless ``partition`` deals them out by ``seq``.
    """
    timed = derived.dense_interactions(spark, sf_dir).withColumn("created_at", F.timestamp_millis("ms"))
    dealt = F.lit(0) if partition is None else partition
    timed = timed.withColumn("timestamp", F.timestamp_millis(F.col("seq") * 100)).withColumn("partition", dealt.cast("int"))
    records = gateway.serialize(timed, keep=("timestamp", "partition", "seq"))
    directory = shared_dir(spark, "counts")
    wire = f"{directory}/wire"
    records.withColumnRenamed("seq", "offset").repartition(4, "offset").write.parquet(wire)
    counted = WindowedCounts(spark, directory)
    counted.start(topics.stream(spark, "parquet", {}, wire), once=True)
    return counted


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted_stream(spark, sf_dir).counts().select("event_type", "window_start", "n")


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_counted_stream(spark, sf_dir).late(), "created_at")


def stream_late_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events of a topic of three partitions, the third of which is idle two thirds of the time."""
    partition = F.when(F.col("seq") % 300 < 100, F.col("seq") % 3).otherwise(F.col("seq") % 2)
    return _zoneless(_counted_stream(spark, sf_dir, partition).late(), "created_at")


def _delivered_in_two_parts(spark: SparkSession, sf_dir: str, wire: str):
    """All envelopes with their arrival time, half of them per round; yields the topic stream each time."""
    records = derived.envelopes(spark, sf_dir).select(
        F.lit(None).cast("string").alias("key"), "value", F.col("ingested_at").cast("timestamp").alias("timestamp"), "seq"
    )
    for part in (0, 1):
        records.where(F.col("seq") % 2 == part).drop("seq").write.mode("append").parquet(wire)
        yield topics.stream(spark, "parquet", {}, wire)


def stream_lake_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land envelopes delivered in two parts, restarting the stream between them; nothing is landed twice."""
    directory = shared_dir(spark, "landing")
    table = f"{directory}/events"
    for stream in _delivered_in_two_parts(spark, sf_dir, f"{directory}/wire"):
        land(stream, table, f"{directory}/checkpoint", F.col("timestamp"), once=True)
    return _zoneless(lake.scan(spark, table), "created_at", "ingested_at")


def lake_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog table: the odd envelopes landed by a stream that is restarted, the even ones by a load done twice."""
    directory = shared_dir(spark, "table")
    table = lake.ensure_table(spark, directory, f"lake_{directory.rpartition('-')[2]}")
    wire = derived.envelopes(spark, sf_dir).withColumn("timestamp", F.col("ingested_at").cast("timestamp"))
    for part in (1, 3):
        records = wire.where(F.col("seq") % 4 == part).select("value", "timestamp")
        records.write.mode("append").parquet(f"{directory}/wire")
        stream = topics.stream(spark, "parquet", {}, f"{directory}/wire")
        land_table(stream, table, f"{directory}/checkpoint", F.col("timestamp"), once=True)
    even = wire.where(F.col("seq") % 2 == 0)
    for _ in range(2):
        lake.insert(envelopes.parse_lake_events(even, F.col("timestamp")), table, "load-of-even")
    return _zoneless(lake.current_events(spark, table.partition(".")[0]), "created_at", "ingested_at")


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gateway over the same deliveries: what the topic holds after both rounds."""
    directory = shared_dir(spark, "intake")
    topic = f"{directory}/topic"
    for stream in _delivered_in_two_parts(spark, sf_dir, f"{directory}/wire"):
        accept(stream, f"{directory}/checkpoint", {}, "parquet", topic, F.col("timestamp"), once=True)
    return spark.read.parquet(topic).select("key", "value")


# Features ---------------------------------------------------------------------------------------------


def feature_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.event_rows(derived.interactions(spark, sf_dir), keep=("seq",))


def feature_availability_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.availability_rows(derived.interactions(spark, sf_dir), keep=("seq",))


def feature_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_snapshot(derived.interactions(spark, sf_dir))


def user_feature_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.entity_source(derived.interactions(spark, sf_dir), "user")


def item_feature_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.entity_source(derived.interactions(spark, sf_dir), "item")


def _store(spark: SparkSession, sf_dir: str) -> registry.FeatureRegistry:
    """Both views over their sources."""
    events = derived.interactions(spark, sf_dir)
    store = registry.FeatureRegistry()
    for view in registry.RANKING.views:
        store.apply(view, features.entity_source(events, view.entity.name))
    return store


def _pit(spark: SparkSession, sf_dir: str, view: registry.FeatureView) -> DataFrame:
    wanted = [f"{view.name}:{f}" for f in view.features]
    rows = _store(spark, sf_dir).historical(derived.training_rows(spark, sf_dir), wanted)
    return rows.select("seq", view.entity.join_key, "event_timestamp", "label", *view.features)


def pit_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pit(spark, sf_dir, registry.USER_VIEW)


def pit_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pit(spark, sf_dir, registry.ITEM_VIEW)


def pit_ranking_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: training rows with the user and item features as they were known at each row."""
    return _store(spark, sf_dir).historical(derived.training_rows(spark, sf_dir), registry.RANKING)


# Online -----------------------------------------------------------------------------------------------


def _end():
    return F.expr(MATERIALIZE_END)


def _latest(store: registry.FeatureRegistry, view: registry.FeatureView) -> DataFrame:
    return store.latest(view.name, _end() - F.lit(view.ttl), _end())


def online_latest_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(_store(spark, sf_dir), registry.USER_VIEW)


def online_latest_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(_store(spark, sf_dir), registry.ITEM_VIEW)


def online_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair that ever met, and for every user and item a pair with a partner never seen and one with none."""
    store = _store(spark, sf_dir)
    pairs = derived.interactions(spark, sf_dir).select("user_id", "item_id").distinct()
    unseen_item = pairs.select("user_id", F.lit("never").alias("item_id")).distinct()
    unseen_user = pairs.select(F.lit("never").alias("user_id"), "item_id").distinct()
    no_item = pairs.select("user_id", F.lit(None).cast("string").alias("item_id")).distinct()
    no_user = pairs.select(F.lit(None).cast("string").alias("user_id"), "item_id").distinct()
    asked = reduce(DataFrame.unionByName, [pairs, unseen_item, unseen_user, no_item, no_user])
    tables = {view.name: _latest(store, view) for view in registry.RANKING.views}
    return store.online(asked, registry.RANKING, tables, _end())


def online_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The online tables after three materializations: by the last, rows of the first have expired unless renewed."""
    store, directory = _store(spark, sf_dir), shared_dir(spark, "online")
    for days_before in MATERIALIZE_DAYS_BEFORE:
        store.materialize(directory, _end() - F.expr(f"INTERVAL '{days_before}' DAY"))
    tables = store.online_tables(directory)
    parts = []
    for view in registry.RANKING.views:
        key = F.col(view.entity.join_key).alias("key")
        values = [F.col(n).alias(n.removeprefix(f"{view.entity.name}_")) for n in view.features]
        parts.append(tables[view.name].select(F.lit(view.entity.name).alias("entity"), key, "event_timestamp", *values, "expires_at"))
    return reduce(DataFrame.unionByName, parts)


def offline_online_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each view read both ways at the moment of materialization, compared key by key. Sources are written once."""
    events = derived.interactions(spark, sf_dir)
    store = registry.FeatureRegistry()
    for view, path in zip(registry.RANKING.views, features.write_feature_sources(events, shared_dir(spark, "sources"))):
        store.apply(view, spark.read.parquet(path))
    parts = []
    for view in registry.RANKING.views:
        key, names = view.entity.join_key, view.features
        at_end = events.select(key).distinct().withColumn("event_timestamp", _end())
        offline = store.historical(at_end, [f"{view.name}:{n}" for n in names])
        mismatches = online.parity(offline, _latest(store, view), key, names)
        parts.append(mismatches.select(F.lit(key).alias("key"), "mismatches", "compared"))
    return reduce(DataFrame.unionByName, parts)


# Changes ----------------------------------------------------------------------------------------------


def cdc_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(changes.unwrap(derived.changelog(spark, sf_dir)).drop("ts_ms"), "created_at")


def cdc_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.refused(derived.changelog(spark, sf_dir)).select("lsn", "reason")


def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = changes.latest_images(changes.unwrap(derived.changelog(spark, sf_dir)))
    return _zoneless(changes.current_state(latest), "created_at")


def stream_cdc_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state, followed from a topic delivered in two parts, the second out of order."""
    log = derived.changelog(spark, sf_dir)
    directory = shared_dir(spark, "changes")
    wire = f"{directory}/wire"
    followed = FollowedTable(spark, directory)
    for part in (1, 0):
        log.where(F.coalesce("lsn", F.lit(0)) % 2 == part).write.mode("append").parquet(wire)
        followed.start(spark.readStream.schema(log.schema).parquet(wire), once=True)
    return _zoneless(followed.state(), "created_at")


_ALL: tuple[Query, ...] = (
    parse_envelopes, parse_lake_rows, event_type_counts,
    gateway_validate, gateway_normalize, gateway_route, gateway_quarantine, envelope_serialize, publish_keyed,
    arrival_watermark, tumbling_counts, late_events, window_firings, count_lines,
    lake_scan, lake_partitions, stream_counts, stream_late, stream_late_partitions, stream_lake_append, lake_table_append, stream_publish,
    feature_event_rows, feature_availability_rows, feature_snapshot, user_feature_source, item_feature_source,
    pit_user, pit_item, pit_ranking_features,
    online_latest_user, online_latest_item, online_lookup, online_merge, offline_online_parity,
    cdc_unwrap, cdc_refused, cdc_current_state, stream_cdc_state,
)


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


QUERIES: dict[str, Query] = {query.__name__: _configured(query) for query in _ALL}
