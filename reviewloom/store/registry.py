"""Entities, sources and feature views, and the registry that validates them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Entity:
    """A join key; keys are strings unless declared otherwise."""

    name: str
    dtype: T.DataType = field(default_factory=T.StringType)
    description: str = ""


@dataclass(frozen=True)
class Source:
    """Where a view's rows come from: a Parquet path, a SQL query, or a frame-returning function."""

    name: str
    path: str | None = None
    query: str | None = None
    loader: Callable[[SparkSession], DataFrame] | None = None
    timestamp_field: str = "event_timestamp"
    created_field: str | None = None
    # Epoch-millisecond column behind the timestamp; time filters on it reach the Parquet scan.
    millis_field: str | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        given = [x for x in (self.path, self.query, self.loader) if x is not None]
        if len(given) != 1:
            raise ValueError(f"source {self.name} needs exactly one of path, query, loader")
        if self.path is not None:
            df = spark.read.parquet(self.path)
        elif self.query is not None:
            df = spark.sql(self.query)
        else:
            df = self.loader(spark)
        if self.timestamp_field not in df.columns and self.millis_field:
            df = df.withColumn(self.timestamp_field, F.timestamp_millis(F.col(self.millis_field)))
        return df


@dataclass(frozen=True)
class Partial:
    """A view as partial results that add up.

    ``fold`` turns raw rows into partial rows that hold the view's keys; ``combine``
    reduces partial rows of several intervals to one row for each of their own keys;
    ``finish`` turns them into the view's keys, event time and features.  Sums, counts,
    extremes and sets add up whatever the order that rows arrive in.
    """

    fold: Transform
    combine: Transform
    finish: Transform


@dataclass(frozen=True)
class FeatureView:
    """Named features of one or more entities with a time-to-live."""

    name: str
    entities: tuple[Entity, ...]
    schema: tuple[tuple[str, T.DataType], ...]
    source: Source
    ttl: timedelta | None = None
    transform: Transform | None = None
    online: bool = True
    offline: bool = True
    partial: Partial | None = None
    # What views of one source share: raw rows are folded once for all views with the same function.
    fold: Transform | None = None

    @property
    def keys(self) -> list[str]:
        return [e.name for e in self.entities]

    @property
    def features(self) -> list[str]:
        return [name for name, _ in self.schema]

    def rows(self, spark: SparkSession, raw: DataFrame | None = None) -> DataFrame:
        """Keys, event time and features, computed from the source or from ``raw`` source rows."""
        df = self.source.load(spark) if raw is None else raw
        return self.of_folded(df if self.fold is None else self.fold(df))

    def of_folded(self, df: DataFrame) -> DataFrame:
        """The view's rows from what ``fold`` made of the raw rows."""
        if self.partial is not None:
            df = self.partial.finish(self.partial.fold(df))
        if self.transform is not None:
            df = df.transform(self.transform)
        created = [self.source.created_field] if self.source.created_field in df.columns else []
        return df.select(*self.keys, self.source.timestamp_field, *self.features, *created)


def batch_feature_view(name: str, entities: Sequence[Entity], schema: Sequence[tuple[str, T.DataType]], source: Source,
                       ttl: timedelta | None = None, online: bool = True, offline: bool = False) -> Callable[[Transform], FeatureView]:
    """Declare a view computed from raw rows by the decorated ``DataFrame -> DataFrame`` function."""
    def wrap(transform: Transform) -> FeatureView:
        return FeatureView(name=name, entities=tuple(entities), schema=tuple(schema), source=source, ttl=ttl,
                           transform=transform, online=online, offline=offline)
    return wrap


REGISTRY_SCHEMA = "view string, keys array<string>, features array<string>, types array<string>, ttl_seconds double, online boolean, offline boolean"


class Registry:
    """The applied views of one project."""

    def __init__(self) -> None:
        self.views: dict[str, FeatureView] = {}

    def apply(self, spark: SparkSession, views: Sequence[FeatureView]) -> DataFrame:
        """Check each declared schema against the view's rows and register it."""
        for view in views:
            found = {f.name: f.dataType for f in view.rows(spark).schema.fields}
            for name, dtype in (*((e.name, e.dtype) for e in view.entities), *view.schema):
                if name not in found:
                    raise ValueError(f"view {view.name}: column {name} is missing")
                if not _compatible(found[name], dtype):
                    raise ValueError(f"view {view.name}: column {name} is {found[name].simpleString()}, declared {dtype.simpleString()}")
            self.views[view.name] = view
        return self.table(spark)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(v.name, v.keys, v.features, [t.simpleString() for _, t in v.schema],
                 v.ttl.total_seconds() if v.ttl else None, v.online, v.offline) for v in self.views.values()]
        return spark.createDataFrame(rows, REGISTRY_SCHEMA)

    def view(self, name: str) -> FeatureView:
        if name not in self.views:
            raise KeyError(f"feature view {name} is not registered")
        return self.views[name]

    def select(self, references: Sequence[str]) -> dict[str, list[str]]:
        """``view:feature`` references grouped by view, each checked against its declaration."""
        wanted: dict[str, list[str]] = {}
        for reference in references:
            view_name, _, feature = reference.partition(":")
            if not feature:
                raise ValueError(f"feature reference {reference!r} is not of the form view:feature")
            if feature not in self.view(view_name).features:
                raise KeyError(f"feature {feature} is not in view {view_name}")
            wanted.setdefault(view_name, []).append(feature)
        return wanted


def _compatible(found: T.DataType, declared: T.DataType) -> bool:
    """Equal types, or whole numbers and floats that widen without loss."""
    widening = {("int", "bigint"), ("smallint", "bigint"), ("float", "double"), ("int", "double")}
    pair = (found.simpleString(), declared.simpleString())
    return pair[0] == pair[1] or pair in widening
