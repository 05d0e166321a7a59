"""Queries: incremental publishing, partial results and overlapping runs of the feature store."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators import features as ft
from reviewloom.plans.catalogue import REVIEWS_SQL, USERS_SQL, query
from reviewloom.plans.review_queries import END, MIDDLE, START, TOTALS_SQL, event_store, event_view, online_rows, r6
from reviewloom.session import scratch_path
from reviewloom.sources import driver_tables as dt
from reviewloom.store import Entity, FeatureStore, FeatureView, Partial, Source
from reviewloom.store.views import partial_views


def event_sums(sf: str) -> FeatureView:
    """Event totals per user as counts and sums that add up."""
    def load(session: SparkSession) -> DataFrame:
        return dt.events(session, sf).withColumn("event_timestamp", F.col("ts"))

    def fold(raw: DataFrame) -> DataFrame:
        return raw.groupBy("user_id").agg(F.count("*").alias("events"), F.sum("value").alias("total"), F.max("event_timestamp").alias("event_timestamp"))

    def combine(parts: DataFrame) -> DataFrame:
        return parts.groupBy("user_id").agg(F.sum("events").alias("events"), F.sum("total").alias("total"),
                                            F.max("event_timestamp").alias("event_timestamp"))

    def finish(parts: DataFrame) -> DataFrame:
        return parts.withColumn("total", F.round("total", 4))

    return FeatureView("event_totals", (Entity("user_id", dtype=T.LongType()),), (("events", T.LongType()), ("total", T.DoubleType())),
                       Source("events", loader=load, millis_field="ms"), None, partial=Partial(fold, combine, finish))


@query("incremental_partial", TOTALS_SQL)
def incremental_partial(spark: SparkSession, sf: str) -> DataFrame:
    view = event_sums(sf)
    store = event_store(spark, view)
    store.materialize(START, MIDDLE)
    for end in (datetime(2024, 1, 20), datetime(2024, 1, 20), END):
        store.materialize_incremental(end, mode="partial")
    return online_rows(store, view)


@query("incremental_partial_users", f"""
WITH {REVIEWS_SQL}, {USERS_SQL}
SELECT user_id, round(user_avg_rating, 6) AS user_avg_rating, user_review_count, user_unique_items,
       round(user_avg_review_length, 6) AS user_avg_review_length, user_category_count, cast(user_tenure_days AS bigint) AS user_tenure_days, last_ms FROM user_features""")
def incremental_partial_users(spark: SparkSession, sf: str) -> DataFrame:
    """User features of ever longer spans, each from stored totals and the new reviews alone."""
    store = FeatureStore(spark, scratch_path(spark, "store"), buckets=8, max_parts=2)
    source = Source("raw_reviews", loader=lambda session: dt.reviews(session, sf), millis_field="timestamp")
    store.apply([v for v in partial_views(source) if v.name == "user_features"])
    now = datetime(2002, 6, 1)
    store.materialize(datetime(1990, 1, 1), datetime(1994, 6, 1), as_of=now)
    for end in (datetime(1996, 6, 1), datetime(1996, 9, 1), now):
        store.materialize_incremental(end, mode="partial", as_of=now)
    rows = store.online_table("user_features").withColumns(r6("user_avg_rating", "user_avg_review_length"))
    return rows.select("user_id", *[F.col(c).cast(t) for c, t in ((c, "bigint" if c == "user_tenure_days" else rows.schema[c].dataType) for c in ft.USER_FEATURES)],
                       F.unix_millis("event_timestamp").alias("last_ms"))


@query("overlapping_runs", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, (epoch_us(max(ts)) // 1000) AS ms
FROM events GROUP BY user_id""")
def overlapping_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs that publish their part of the month out of order; the newest row of a key counts whoever wrote last."""
    view = event_view(spark, sf)
    store = event_store(spark, view)
    for low, high in ((datetime(2024, 1, 20), END), (START, datetime(2024, 1, 10)), (datetime(2024, 1, 10), datetime(2024, 1, 20))):
        raw = view.source.load(spark).filter(F.col("event_timestamp").between(low, high))
        store.publish(view, store.latest(view, raw, END), low, high)
    return online_rows(store, view)


@query("touched_buckets", """
WITH changed AS (SELECT DISTINCT user_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)
SELECT 16::bigint AS buckets, true AS untouched_kept, true AS touched_grew, true AS rows_agree, (SELECT count(*) FROM changed) AS rows_written,
       (SELECT count(DISTINCT user_id) FROM events) AS online_rows""")
def touched_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """A late run over the last hour of events: which files it leaves alone, and what it writes."""
    view = event_view(spark, sf)
    store = FeatureStore(spark, scratch_path(spark, "store"), buckets=16)
    store.apply([view])
    events = view.source.load(spark)
    last = events.agg(F.max("event_timestamp")).first()[0]
    late = events.filter(F.col("event_timestamp") > F.lit(last) - F.expr("interval 1 hour"))
    table = store.table(view)
    store.publish(view, store.latest(view, events, last), START, END, whole=True)
    before = {b: {c.path for c, kept in table.live() if b in kept} for b in range(16)}
    written = store.publish(view, store.latest(view, late, last), START, END)
    after = {b: {c.path for c, kept in table.live() if b in kept} for b in range(16)}
    touched = table.commits()[-1].filled
    rows = store.online_table(view.name)
    same = rows.select("user_id", *view.features).exceptAll(store.latest(view, events, last).select("user_id", *view.features)).isEmpty()
    row = (16, all(before[b] == after[b] for b in range(16) if b not in touched),
           all(before[b] < after[b] for b in touched), same, written, rows.count())
    return spark.createDataFrame([row], "buckets bigint, untouched_kept boolean, touched_grew boolean, rows_agree boolean, rows_written bigint, online_rows bigint")
