from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.store import Entity, FeatureStore, FeatureView, Source, batch_feature_view
from reviewloom.store.feature_store import alive, within
from reviewloom.store.views import TRAINING_FEATURES, raw_reviews_source, raw_views, review_embeddings_view, stored_views
from reviewloom.sources.writers import key_bucket, write_keyed, write_placeholders
from reviewloom.operators.encode import hashing_encoder
from reviewloom.streaming.incremental import materialize_new_files

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
USER = Entity("user_id")


def day(n):
    return T0 + timedelta(days=n)


def write_events(spark, path, rows, mode="append"):
    df = spark.createDataFrame(rows, "user_id string, event_timestamp timestamp, score double")
    df.withColumn("ms", F.unix_millis("event_timestamp")).coalesce(1).write.mode(mode).parquet(path)


def score_view(path, ttl=None, name="scores"):
    return FeatureView(name, (USER,), (("score", T.DoubleType()),), Source("s", path=path, millis_field="ms"), ttl)


def totals_view(path):
    @batch_feature_view("totals", [USER], [("n", T.LongType()), ("total", T.DoubleType())], Source("s", path=path, millis_field="ms"))
    def totals(df):
        return df.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("score").alias("total"), F.max("event_timestamp").alias("event_timestamp"))
    return totals


def rows_of(store, view):
    names = [*view.keys, *view.features]
    return {tuple(r) for r in store.online_table(view.name).select(*names).collect()}


def test_apply_checks_declared_schema(spark, tmp_path):
    path = str(tmp_path / "e")
    write_events(spark, path, [("a", day(1), 1.0)])
    store = FeatureStore(spark, str(tmp_path / "store"))
    assert [r.view for r in store.apply([score_view(path)]).collect()] == ["scores"]
    assert spark.read.parquet(str(tmp_path / "store" / "registry")).count() == 1
    wrong = FeatureView("w", (USER,), (("score", T.StringType()),), Source("s", path=path))
    with pytest.raises(ValueError, match="declared string"):
        store.apply([wrong])
    with pytest.raises(KeyError):
        store.registry.select(["scores:nope"])
    with pytest.raises(KeyError):
        store.registry.select(["unknown:score"])
    with pytest.raises(ValueError):
        store.registry.select(["scores"])


def test_views_over_empty_placeholders(spark, tmp_path):
    base = str(tmp_path)
    write_placeholders(spark, base)
    store = FeatureStore(spark, f"{base}/store")
    store.apply(stored_views(base))
    asked = spark.createDataFrame([("SAMPLE_USER_1", "B000000001", T0), ("SAMPLE_USER_2", "B000000002", T0)],
                                  "user_id string, item_id string, event_timestamp timestamp")
    got = store.get_historical_features(asked, TRAINING_FEATURES)
    assert got.count() == 2 and got.filter("user_avg_rating is not null").count() == 0
    assert got.columns == [*asked.columns, *[f.split(":")[1] for f in TRAINING_FEATURES]]


def test_historical_and_online_features(spark, tmp_path):
    base = str(tmp_path)
    users = [("SAMPLE_USER_1", day(-5), 4.5, 10, 3, 20.0, 2, 7), ("SAMPLE_USER_2", day(3), 1.0, 1, 1, 1.0, 1, 0)]
    spark.createDataFrame(users, "user_id string, event_timestamp timestamp, user_avg_rating double, user_review_count bigint, user_unique_items bigint, "
                          "user_avg_review_length double, user_category_count bigint, user_tenure_days int").write.parquet(f"{base}/user_features")
    items = [("B000000001", day(-9), 3.5, None, 1, 5, 9.0, 2.5)]
    spark.createDataFrame(items, "item_id string, event_timestamp timestamp, item_avg_rating double, item_rating_stddev double, item_review_count bigint, "
                          "item_total_helpful_votes bigint, item_avg_review_length double, item_price float").write.parquet(f"{base}/item_features")
    store = FeatureStore(spark, f"{base}/store", buckets=3)
    store.apply(stored_views(base))
    wanted = ["user_features:user_avg_rating", "user_features:user_review_count", "item_features:item_avg_rating", "item_features:item_review_count"]
    asked = spark.createDataFrame([("SAMPLE_USER_1", "B000000001", T0), ("SAMPLE_USER_2", "B000000002", T0)],
                                  "user_id string, item_id string, event_timestamp timestamp")
    old = {r.user_id: r for r in store.get_historical_features(asked, wanted).collect()}
    assert old["SAMPLE_USER_1"].user_avg_rating == 4.5 and old["SAMPLE_USER_1"].item_review_count == 1
    assert old["SAMPLE_USER_2"].user_avg_rating is None   # the feature row lies in the future
    with pytest.raises(KeyError):
        store.get_online_features(wanted, asked)
    assert store.materialize(day(-30), day(30)) == {"user_features": 2, "item_features": 1}
    new = {r.user_id: r for r in store.get_online_features(wanted, asked.drop("event_timestamp")).collect()}
    assert new["SAMPLE_USER_2"].user_avg_rating == 1.0 and new["SAMPLE_USER_2"].item_avg_rating is None


def test_filters_use_inclusive_bounds(spark):
    df = spark.createDataFrame([(i, day(i)) for i in range(6)], "i int, t timestamp").withColumn("ms", F.unix_millis("t"))
    for millis in (None, "ms"):
        assert [r.i for r in within(df, "t", day(1), day(3), millis).orderBy("i").collect()] == [1, 2, 3]
    assert [r.i for r in alive(df, "t", timedelta(days=2), day(5)).orderBy("i").collect()] == [3, 4, 5]
    assert within(df, "t", day(1) + timedelta(microseconds=1), None, "ms").count() == 4


def test_latest_row_and_ttl(spark, tmp_path):
    path = str(tmp_path / "e")
    write_events(spark, path, [("a", day(1), 1.0), ("a", day(4), 4.0), ("a", day(9), 9.0), ("b", day(0), 5.0)])
    view = score_view(path, ttl=timedelta(days=5))
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.apply([view])
    assert store.materialize(day(0), day(6), as_of=day(6)) == {"scores": 1}
    assert rows_of(store, view) == {("a", 4.0)}


def test_incremental_recompute_equals_one_full_run(spark, tmp_path):
    path = str(tmp_path / "e")
    write_events(spark, path, [("a", day(1), 1.0), ("b", day(1), 2.0), ("a", day(5), 3.0), ("c", day(6), 4.0)])
    view = totals_view(path)
    full, steps, interval = (FeatureStore(spark, str(tmp_path / n)) for n in ("full", "steps", "interval"))
    for store in (full, steps, interval):
        store.apply([view])
    full.materialize(day(0), day(7))
    for store, mode in ((steps, "recompute"), (interval, "interval")):
        with pytest.raises(ValueError, match="give start"):
            store.materialize_incremental(day(3), mode=mode)
        store.materialize_incremental(day(3), mode=mode, start=day(0))
        store.materialize_incremental(day(7), mode=mode)
    assert rows_of(steps, view) == rows_of(full, view) == {("a", 2, 4.0), ("b", 1, 2.0), ("c", 1, 4.0)}
    assert rows_of(interval, view) == {("a", 1, 3.0), ("b", 1, 2.0), ("c", 1, 4.0)}
    assert steps.current("totals")["version"] == 2 and steps.current("totals")["end_time"] == day(7)
    with pytest.raises(ValueError, match="mode"):
        steps.materialize_incremental(day(8), mode="other")


def test_stream_picks_up_new_files_once(spark, tmp_path):
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    write_events(spark, path, [("a", day(1), 1.0), ("b", day(2), 2.0)])
    view = score_view(path)
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.apply([view])
    schema = spark.read.parquet(path).schema
    materialize_new_files(store, "scores", path, schema, checkpoint)
    assert rows_of(store, view) == {("a", 1.0), ("b", 2.0)}
    write_events(spark, path, [("a", day(0), 9.0), ("b", day(5), 5.0), ("c", day(3), 3.0)])
    materialize_new_files(store, "scores", path, schema, checkpoint)
    assert rows_of(store, view) == {("a", 1.0), ("b", 5.0), ("c", 3.0)}
    version = store.current("scores")["version"]
    materialize_new_files(store, "scores", path, schema, checkpoint)
    assert store.current("scores")["version"] == version


def test_raw_views_and_embeddings(spark, tmp_path):
    rows = [("u1", "i1", 5.0, "Title", "long enough review text", 1_704_067_200_000, 1, "x"), ("u1", "i2", 3.0, None, "short", 1_704_153_600_000, 0, "y")]
    schema = "user_id string, asin string, rating double, title string, text string, timestamp bigint, helpful_vote int, category string"
    spark.createDataFrame(rows, schema).write.partitionBy("category").parquet(str(tmp_path / "raw"))
    source = raw_reviews_source(f"{tmp_path}/raw/*/")
    embeddings = review_embeddings_view(source, hashing_encoder(8))
    views = [*raw_views(source), embeddings]
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.apply(views)
    assert store.materialize(day(-1), day(5), as_of=day(5)) == {"user_features": 1, "item_features": 2, "review_embeddings": 1}
    row = store.online_table("review_embeddings").first()
    assert (row.item_id, row.review_title, len(row.embedding), len(row.review_id)) == ("i1", "Title", 8, 64)
    # The recompute finds an item's raw rows through their original column; nothing new, nothing written.
    assert store.materialize_incremental(day(6), ["item_features"], as_of=day(6)) == {"item_features": 0}
    assert store.online_table("item_features").count() == 2


def test_one_task_writes_one_bucket(spark, tmp_path):
    path = str(tmp_path / "keyed")
    assert write_keyed(spark.range(500).withColumn("k", F.col("id").cast("string")), ["k"], path, 6) == 500
    df = spark.read.parquet(path)
    assert df.select("bucket").distinct().count() == 6 == len(df.inputFiles())
    assert df.filter(F.col("bucket") != key_bucket(["k"], 6)).count() == 0
