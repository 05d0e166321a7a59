"""Point-in-time join: for each entity row the latest feature row at or before its time.

Usual keys take one shuffle and one sort: feature and entity rows are put in one
frame, ordered by time with features first, and the last feature row is carried
forward.  Keys holding very many rows are cut into time chunks at their own
quantiles, each chunk starting with the feature row carried over from before it,
so that no key has to fit one task.  Features with a single row per key, as a full
feature run leaves them, need no ordering and become an equi-join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta
from math import ceil

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.skew import HOT_ROWS, KeyLoad, join_unique, key_load, listed


@dataclass(frozen=True)
class KeyProfile:
    """What decides the plan: the keys too heavy for one task, and whether features have one row per key."""

    load: KeyLoad
    single_version: bool
    hottest: int = 0


def profile_keys(entities: DataFrame, features: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> KeyProfile:
    """Count rows per key on both sides; only the key columns are read and fewer keys return than rows over ``hot_rows``."""
    left = entities.groupBy(key).agg(F.count("*").alias("_e"))
    right = features.groupBy(key).agg(F.count("*").alias("_f"))
    both = (left.unionByName(right, allowMissingColumns=True)
                .groupBy(key).agg(F.coalesce(F.sum("_e"), F.lit(0)).alias("_e"), F.coalesce(F.sum("_f"), F.lit(0)).alias("_f")))
    seen = Observation()
    versions = F.max(F.when(F.col(key).isNotNull(), F.col("_f")))
    heavy = (both.observe(seen, versions.alias("versions"))
                 .filter(F.col("_e") + F.col("_f") > hot_rows))
    rows = heavy.collect()
    hot = [row[key] for row in rows]
    load = KeyLoad(tuple((k,) for k in hot if k is not None), None in hot)
    return KeyProfile(load, (seen.get["versions"] or 0) <= 1, max((row["_e"] + row["_f"] for row in rows), default=0))


def _ttl_floor(time: Column, ttl: timedelta) -> Column:
    """Times are compared in microseconds so that the bound is exact."""
    return time - F.lit(int(ttl / timedelta(microseconds=1)))


def _timeline(entities: DataFrame, features: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Carry the last feature payload forward to every entity row of its partition."""
    left = entities.withColumns({"_side": F.lit(1), "_payload": F.lit(None).cast(features.schema["_payload"].dataType)})
    right = features.withColumns({"_side": F.lit(0), "_entity": F.lit(None).cast(entities.schema["_entity"].dataType)})
    columns = [*partition, "_us", "_side", "_payload", "_entity"]
    line = left.select(*columns).unionByName(right.select(*columns))
    upto = (Window.partitionBy(*partition).orderBy("_us", "_side", *order)
                  .rowsBetween(Window.unboundedPreceding, 0))
    return (line.withColumn("_found", F.last("_payload", ignorenulls=True).over(upto))
                .filter(F.col("_side") == 1).select(*partition, "_us", "_entity", "_found"))


def _chunk_bounds(entities: DataFrame, features: DataFrame, key: str, hottest: int, hot_rows: int,
                  chunks: int | None) -> dict[object, np.ndarray]:
    """Chunk borders per hot key from its own time quantiles, about two per ``hot_rows`` rows.

    Keys are counted heavy, so the borders of all keys together are at most twice the
    number of rows over ``hot_rows``.
    """
    most = chunks or max(2, ceil(2 * hottest / hot_rows))
    times = features.select(key, "_us").unionByName(entities.select(key, "_us"))
    steps = [i / most for i in range(1, most)]
    sketched = times.groupBy(key).agg(F.count("*").alias("_n"), F.percentile_approx("_us", steps, max(10_000, 4 * most)).alias("_q"))
    # Each key keeps the borders that its own rows call for, before they are collected.
    wanted = F.lit(most) if chunks else F.greatest(F.lit(2), F.ceil(F.col("_n") * 2 / hot_rows)).cast("int")
    every = F.greatest(F.lit(1), F.floor(F.lit(most) / wanted)).cast("int")
    thinned = sketched.withColumn("_every", every).select(key, F.filter("_q", lambda _, i: i % F.col("_every") == 0).alias("_q"))
    bounds = {row[key]: np.unique(np.array(row["_q"], dtype=np.int64)) for row in thinned.collect()}
    return bounds


def _chunk_number(context: SparkContext, bounds: dict[object, np.ndarray]) -> Callable[[Column, Column], Column]:
    """Column function (key, time) -> chunk number, by binary search in the borders of the key."""
    sent = context.broadcast(bounds)

    @F.pandas_udf("int")
    def number(key: pd.Series, us: pd.Series) -> pd.Series:
        out = np.zeros(len(key), dtype=np.int32)
        moments = us.to_numpy()
        for value, at in key.groupby(key, sort=False).indices.items():
            borders = sent.value.get(value)
            if borders is not None:
                out[at] = np.searchsorted(borders, moments[at], side="right")
        return pd.Series(out)

    # Kept in place: as a deterministic column it would be repeated in pushed-down null filters.
    return number.asNondeterministic()


def _chunked(entities: DataFrame, features: DataFrame, key: str, hottest: int, hot_rows: int, chunks: int | None) -> DataFrame:
    """The same result for hot keys, with (key, time chunk) as the unit of work.

    Feature rows of equal key and time are folded first, and entity rows are resolved
    once per distinct (key, time) and joined back, so repeated times stay small too.
    """
    bounds = _chunk_bounds(entities, features, key, hottest, hot_rows, chunks)
    number = _chunk_number(entities.sparkSession.sparkContext, bounds)
    features = features.groupBy(key, "_us").agg(F.max_by("_payload", F.col("_payload.rank")).alias("_payload"))
    features = features.withColumn("_chunk", number(F.col(key), F.col("_us")))
    moments = entities.select(key, "_us").distinct().withColumn("_chunk", number(F.col(key), F.col("_us")))
    last = features.groupBy(key, "_chunk").agg(F.max_by(F.struct("_us", "_payload"), "_us").alias("_last"))
    shape = T.StructType([T.StructField(key, entities.schema[key].dataType), T.StructField("_borders", T.IntegerType())])
    sizes = entities.sparkSession.createDataFrame([(k, len(b)) for k, b in bounds.items()], shape)
    grid = sizes.select(key, F.explode(F.sequence(F.lit(0), F.col("_borders"))).alias("_chunk"))
    # One row per chunk: a key has about two for every hot_rows rows.
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (grid.join(last, [key, "_chunk"], "left")
                   .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
                   .filter(F.col("_carry").isNotNull())
                   .select(key, "_chunk", "_carry._us", "_carry._payload"))
    line = features.select(key, "_chunk", "_us", "_payload").unionByName(carried)
    found = _timeline(moments.withColumn("_entity", F.struct(F.lit(1).alias("one"))), line, [key, "_chunk"], [])
    return join_unique(entities, found.select(key, "_us", "_found"), [key, "_us"], "left", key_load(entities, [key, "_us"], hot_rows))


def asof_join(entities: DataFrame, features: DataFrame, key: str, columns: Sequence[str], *,
              entity_time: str = "event_timestamp", feature_time: str = "event_timestamp",
              ttl: timedelta | None = None, created: str | None = None, matched_time: str | None = None,
              hot_rows: int | None = HOT_ROWS, chunks: int | None = None, profile: KeyProfile | None = None) -> DataFrame:
    """Entity rows with the feature ``columns`` valid at their time; all entity rows are kept.

    A feature row is valid when ``f.time <= e.time`` and ``f.time > e.time - ttl``.  Of
    feature rows with equal time the last created one counts.  ``matched_time`` names an
    extra output column with the time of the chosen row.  Rows with a null key or time
    get null features.  ``hot_rows=None`` skips the key count and uses the usual plan;
    a ``profile`` counted earlier saves counting again.
    """
    usable = features.filter(F.col(key).isNotNull() & F.col(feature_time).isNotNull())
    if profile is None:
        profile = profile_keys(entities, usable, key, hot_rows) if hot_rows else KeyProfile(KeyLoad(), False)
    if profile.single_version:
        return _single_version(entities, usable, key, columns, entity_time, feature_time, ttl, matched_time, profile.load)

    moment = F.unix_micros(F.col(feature_time).cast("timestamp"))
    rank = ([F.col(created)] if created else []) + [F.col(c) for c in columns if features.schema[c].dataType.typeName() != "map"]
    payload = F.struct(
        moment.alias("us"),
        F.col(feature_time).cast("timestamp").alias("time"),
        F.struct(*[F.col(c) for c in columns]).alias("values"),
        F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)]).alias("rank"),
    )
    right = usable.select(F.col(key), moment.alias("_us"), payload.alias("_payload"))

    whole = F.struct(*[F.col(c) for c in entities.columns])
    has_key = F.col(key).isNotNull() & F.col(entity_time).isNotNull()
    left = entities.filter(has_key).select(
        F.col(key), F.unix_micros(F.col(entity_time).cast("timestamp")).alias("_us"), whole.alias("_entity"))
    no_key = entities.filter(~has_key).select(
        F.lit(None).cast("bigint").alias("_us"), whole.alias("_entity"),
        F.lit(None).cast(right.schema["_payload"].dataType).alias("_found"))

    if profile.load.keys:
        heavy = listed(left, [key], profile.load.keys)
        usual = _timeline(left.join(heavy, key, "left_anti"), right.join(heavy, key, "left_anti"), [key], ["_payload.rank"])
        dense = _chunked(left.join(heavy, key, "left_semi"), right.join(heavy, key, "left_semi"), key, profile.hottest,
                         hot_rows or HOT_ROWS, chunks)
        found = usual.select("_us", "_entity", "_found").unionByName(dense.select("_us", "_entity", "_found"))
    else:
        found = _timeline(left, right, [key], ["_payload.rank"]).select("_us", "_entity", "_found")
    found = found.unionByName(no_key)

    if ttl is not None:
        alive = F.col("_found.us") > _ttl_floor(F.col("_us"), ttl)
        found = found.withColumn("_found", F.when(alive, F.col("_found")))
    picked = [F.col(f"_found.values.{c}").alias(c) for c in columns]
    if matched_time:
        picked.append(F.col("_found.time").alias(matched_time))
    return found.select("_entity.*", *picked)


def _single_version(entities: DataFrame, features: DataFrame, key: str, columns: Sequence[str], entity_time: str,
                    feature_time: str, ttl: timedelta | None, matched_time: str | None, load: KeyLoad) -> DataFrame:
    """One feature row per key: an equi-join whose match is blanked outside its validity."""
    right = features.select(F.col(key), F.col(feature_time).cast("timestamp").alias("_time"),
                            *[F.col(c).alias(f"_f{i}") for i, c in enumerate(columns)])
    at, since = F.unix_micros(F.col(entity_time).cast("timestamp")), F.unix_micros("_time")
    valid = since <= at
    if ttl is not None:
        valid = valid & (since > _ttl_floor(at, ttl))
    picked = [F.when(valid, F.col(f"_f{i}")).alias(c) for i, c in enumerate(columns)]
    if matched_time:
        picked.append(F.when(valid, F.col("_time")).alias(matched_time))
    return join_unique(entities, right, key, "left", load).select(*entities.columns, *picked)
