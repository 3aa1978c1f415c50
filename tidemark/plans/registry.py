"""Declared entities, feature views and services, resolved to DataFrames."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import asof, online
from tidemark.schemas import FEATURE_WINDOW, ITEM_FEATURES, USER_FEATURES, require_columns
from tidemark.sources.versions import VersionedTable


@dataclass(frozen=True)
class Entity:
    name: str
    join_key: str


@dataclass(frozen=True)
class FeatureView:
    """Features of one entity over a time-stamped source, usable up to ``ttl`` after their time."""

    name: str
    entity: Entity
    features: tuple[str, ...]
    ttl: timedelta = FEATURE_WINDOW
    time: str = "event_timestamp"
    created: str = "created_timestamp"

    @property
    def schema(self) -> T.StructType:
        """What the view's stored source must hold."""
        return T.StructType(
            [
                T.StructField(self.entity.join_key, T.StringType()),
                T.StructField(self.time, T.TimestampType()),
                T.StructField(self.created, T.TimestampType()),
                *[T.StructField(name, T.LongType()) for name in self.features],
            ]
        )


@dataclass(frozen=True)
class FeatureService:
    name: str
    views: tuple[FeatureView, ...]


USER = Entity("user", "user_id")
ITEM = Entity("item", "item_id")
USER_VIEW = FeatureView("user_interaction_features", USER, USER_FEATURES)
ITEM_VIEW = FeatureView("item_interaction_features", ITEM, ITEM_FEATURES)
RANKING = FeatureService("ranking_features", (USER_VIEW, ITEM_VIEW))


_DEFINITION = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("join_key", T.StringType()),
        T.StructField("members", T.ArrayType(T.StringType())),
        T.StructField("ttl_seconds", T.DoubleType()),
        T.StructField("time", T.StringType()),
        T.StructField("created", T.StringType()),
    ]
)


def save_definitions(spark: SparkSession, path: str, services: Iterable[FeatureService]) -> str:
    """Publish the services and their views as a table that other processes read back."""
    services = list(services)
    views = {view.name: view for service in services for view in service.views}
    rows = [
        ("view", v.name, v.entity.name, v.entity.join_key, list(v.features), v.ttl.total_seconds(), v.time, v.created)
        for v in views.values()
    ]
    rows += [("service", s.name, None, None, [v.name for v in s.views], None, None, None) for s in services]
    return VersionedTable(spark, path).replace(spark.createDataFrame(rows, _DEFINITION).coalesce(1))


def load_definitions(spark: SparkSession, path: str) -> dict[str, FeatureService]:
    """The services as last published, by name."""
    rows = VersionedTable(spark, path).current(_DEFINITION).collect()
    views = {
        r["name"]: FeatureView(
            r["name"], Entity(r["entity"], r["join_key"]), tuple(r["members"]), timedelta(seconds=r["ttl_seconds"]), r["time"], r["created"]
        )
        for r in rows
        if r["kind"] == "view"
    }
    return {r["name"]: FeatureService(r["name"], tuple(views[v] for v in r["members"])) for r in rows if r["kind"] == "service"}


def stored_source(spark: SparkSession, view: FeatureView, folder: str) -> DataFrame:
    """The view's stored source, read by its declared schema; refused if its files hold other types."""
    declared = {f.name: f.dataType for f in view.schema}
    actual = {f.name: f.dataType for f in spark.read.parquet(folder).schema}
    wrong = {n: f"{actual[n].simpleString()} instead of {t.simpleString()}" for n, t in declared.items() if n in actual and actual[n] != t}
    missing = sorted(set(declared) - set(actual))
    if wrong or missing:
        raise TypeError(f"source of {view.name}: missing {missing}, wrong types {wrong}")
    return spark.read.schema(view.schema).parquet(folder)


@dataclass
class FeatureRegistry:
    """Views with the DataFrames behind them. Sources are checked when a view is applied, before any job."""

    _sources: dict[str, tuple[FeatureView, DataFrame]] = field(default_factory=dict)

    def apply(self, view: FeatureView, source: DataFrame) -> FeatureRegistry:
        """Register a view."""
        key, types = view.entity.join_key, dict(source.dtypes)
        require_columns(source, (key, view.time, view.created, *view.features), view.name)
        if types[key] != "string":
            raise TypeError(f"{view.name}: join key {key} must be string, not {types[key]}")
        wrong = {n: types[n] for n in view.features if types[n] != "bigint"}
        if wrong:
            raise TypeError(f"{view.name}: features must be bigint: {wrong}")
        self._sources[view.name] = (view, source)
        return self

    def view(self, name: str) -> FeatureView:
        return self._entry(name)[0]

    def source(self, name: str) -> DataFrame:
        return self._entry(name)[1]

    def _entry(self, name: str) -> tuple[FeatureView, DataFrame]:
        if name not in self._sources:
            raise LookupError(f"feature view {name} is not registered")
        return self._sources[name]

    def resolve(self, features: FeatureService | Iterable[str]) -> list[tuple[FeatureView, tuple[str, ...]]]:
        """Views and the features wanted of each, from a service or ``view:feature`` references."""
        if isinstance(features, FeatureService):
            return [(self.view(v.name), v.features) for v in features.views]
        wanted: dict[str, list[str]] = {}
        for reference in features:
            view_name, _, feature = reference.partition(":")
            if feature not in self.view(view_name).features:
                raise LookupError(f"feature {reference} is not registered")
            wanted.setdefault(view_name, []).append(feature)
        return [(self.view(name), tuple(names)) for name, names in wanted.items()]

    def historical(self, entities: DataFrame, features: FeatureService | Iterable[str]) -> DataFrame:
        """Entity rows with point-in-time values of each view on its own key.

        Rows carry their columns from one view to the next, so the views' results are not joined together.
        """
        result = entities
        for view, names in self.resolve(features):
            key = view.entity.join_key
            require_columns(result, (key, "event_timestamp"), "entity rows")
            source = self.source(view.name).withColumnRenamed(view.time, "event_timestamp")
            result = asof.as_of_join(result, source, key, names, view.ttl, "event_timestamp", view.created)
        return result

    def latest(self, name: str, start: Column, end: Column) -> DataFrame:
        """Online table of one view: the latest values in ``[start, end]``."""
        view = self.view(name)
        return online.latest_values(
            self.source(name), view.entity.join_key, view.features, start, end, time=view.time, created=view.created
        )

    def materialize(self, directory: str, end: Column, span: timedelta = FEATURE_WINDOW) -> dict[str, str]:
        """Write the latest values of the span up to ``end`` into the online table of every view.

        Keys outside the span keep their values until they expire. Readers of a table are not disturbed: the new
        content is published when it is whole. Returns the folders of the published versions.
        """
        start, paths = end - F.lit(span), {}
        for name, (view, source) in self._sources.items():
            table = VersionedTable(source.sparkSession, f"{directory.rstrip('/')}/{name}")
            latest = self.latest(name, start, end)
            if table.exists():
                stored = table.current(latest.schema)
                latest = online.merge(stored, latest, view.entity.join_key, end, view.time)
            paths[name] = table.replace(latest)
        return paths

    def online_tables(self, directory: str) -> dict[str, DataFrame]:
        """The online tables as last materialized below the directory."""
        return {
            name: VersionedTable(source.sparkSession, f"{directory.rstrip('/')}/{name}").current()
            for name, (_, source) in self._sources.items()
        }

    def online(
        self,
        entities: DataFrame,
        features: FeatureService | Iterable[str],
        tables: dict[str, DataFrame],
        now: Column,
    ) -> DataFrame:
        """Entity rows with their current values from the online tables."""
        result = entities
        for view, names in self.resolve(features):
            result = online.look_up(result, tables[view.name], view.entity.join_key, names, now)
        return result
