"""Bucketed tables, their commit log, and partial results of the feature store."""

import threading
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators import features as ft
from reviewloom.store import Entity, FeatureStore, FeatureView, Partial, Source
from reviewloom.store.buckets import BucketTable, CommitLog, VersionTaken
from reviewloom.store.views import partial_views

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def day(n):
    return T0 + timedelta(days=n)


def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"), F.max("_order").alias("last"))


def table_of(spark, path, buckets=5, **options):
    return BucketTable(spark, str(path), ["k"], buckets, lambda r: summed(r).drop("last"), **options)


def counted(spark, rows):
    return spark.createDataFrame(rows, "k string, n long")


def content(table):
    rows = table.rows()
    return {} if rows is None else {r.k: r.n for r in rows.collect()}


def files(tmp_path):
    return {str(p) for p in tmp_path.rglob("*.parquet")}


def test_rows_add_up_and_untouched_buckets_keep_their_files(spark, tmp_path):
    table = table_of(spark, tmp_path)
    assert content(table) == {} and table.compact() is None
    table.append(counted(spark, [(f"k{i}", 1) for i in range(40)]), {})
    old = files(tmp_path)
    change = table.append(counted(spark, [("k3", 5)]), {})
    assert len(change.filled) == 1 and len(files(tmp_path) - old) == 1 and old <= files(tmp_path)
    table.append(counted(spark, []), {})
    table.append(counted(spark, [("new", 7)]), {})
    assert content(table) == {**{f"k{i}": 1 for i in range(40)}, "k3": 6, "new": 7}
    asked = spark.createDataFrame([("k3",), ("gone",)], "k string")
    near = table.lookup(asked)
    assert {r.k: r.n for r in near.join(asked, "k").collect()} == {"k3": 6} and near.count() < 41
    assert "PartitionFilters: [isnotnull(bucket" in near._jdf.queryExecution().toString() or "bucket" in near._jdf.queryExecution().toString()


def test_compaction_rewrites_full_buckets_only(spark, tmp_path):
    table = table_of(spark, tmp_path, max_parts=2)
    table.append(counted(spark, [(f"k{i}", 1) for i in range(40)]), {})
    for _ in range(3):
        table.append(counted(spark, [("k3", 1)]), {})
    before, live = content(table), {b for c, kept in table.live() for b in kept}
    done = table.compact()
    assert len(done.filled) == 1 and content(table) == before == {**{f"k{i}": 1 for i in range(40)}, "k3": 4}
    assert {b for c, kept in table.live() for b in kept} == live and table.compact() is None
    # Rows that another writer added meanwhile were not folded and still count.
    table.append(counted(spark, [("k3", 10)]), {})
    assert content(table)["k3"] == 14
    table.replace(counted(spark, [("only", 1)]), {})
    assert content(table) == {"only": 1}


def test_compaction_counts_as_its_newest_version(spark, tmp_path):
    """A version committed between reading and compacting is newer than what was compacted."""
    newest = BucketTable(spark, str(tmp_path), ["k"], 1, lambda r: r.groupBy("k").agg(F.max_by("n", "_order").alias("n")), max_parts=1)
    newest.append(counted(spark, [("a", 1)]), {})
    newest.append(counted(spark, [("a", 2)]), {})
    seen = newest.commits()
    late = newest.append(counted(spark, [("a", 3)]), {})
    newest.commits = lambda: seen
    done = newest.compact()
    del newest.commits
    assert done.version > late.version and {r.n for r in newest.rows().collect()} == {3}


def test_one_writer_gets_a_version(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    got, lock = [], threading.Lock()

    def claim(i):
        for _ in range(5):
            version = log.claim({"writer": i})
            with lock:
                got.append((version, i))

    threads = [threading.Thread(target=claim, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(v for v, _ in got) == list(range(1, 31))
    assert {v: e["writer"] for v, e in log.read().items()} == dict(got)
    with pytest.raises(VersionTaken):
        log.claim({}, after=29)
    assert log.claim({}, after=30) == 31


def sums_view(path):
    def fold(raw):
        return raw.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("score").alias("total"), F.max("event_timestamp").alias("event_timestamp"))

    def combine(parts):
        return parts.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("event_timestamp").alias("event_timestamp"))

    return FeatureView("sums", (Entity("user_id"),), (("n", T.LongType()), ("total", T.DoubleType())), Source("s", path=path, millis_field="ms"),
                       partial=Partial(fold, combine, lambda parts: parts))


def write_events(spark, path, rows):
    df = spark.createDataFrame(rows, "user_id string, event_timestamp timestamp, score double")
    df.withColumn("ms", F.unix_millis("event_timestamp")).coalesce(1).write.mode("append").parquet(path)


def online(store, view):
    return {tuple(r) for r in store.online_table(view.name).select(*view.keys, *view.features).collect()}


def test_overlapping_runs_both_survive(spark, tmp_path):
    path = str(tmp_path / "e")
    write_events(spark, path, [(f"u{i}", day(i), float(i)) for i in range(8)])
    view = FeatureView("scores", (Entity("user_id"),), (("score", T.DoubleType()),), Source("s", path=path, millis_field="ms"))
    stores = [FeatureStore(spark, str(tmp_path / "store"), buckets=3) for _ in range(4)]
    for s in stores:
        s.registry.views[view.name] = view
    rows = view.source.load(spark)

    def run(i):
        part = rows.filter(F.col("user_id").isin(f"u{2 * i}", f"u{2 * i + 1}"))
        stores[i].publish(view, stores[i].latest(view, part, day(9)), day(2 * i), day(2 * i + 1))

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert online(stores[0], view) == {(f"u{i}", float(i)) for i in range(8)}
    now = stores[0].current("scores")
    assert now["version"] >= 4 and (now["start_time"], now["end_time"]) == (day(0), day(7))
    assert stores[0].history("scores").count() == 4


def test_partial_results_equal_one_full_run_without_reading_history(spark, tmp_path):
    path, later = str(tmp_path / "e"), str(tmp_path / "later")
    write_events(spark, path, [("a", day(1), 1.0), ("b", day(1), 2.0), ("a", day(3), 3.0)])
    view = sums_view(path)
    store = FeatureStore(spark, str(tmp_path / "store"), buckets=3, max_parts=1)
    store.apply([view])
    with pytest.raises(ValueError, match="give start"):
        store.materialize_incremental(day(3), mode="partial")
    store.materialize_incremental(day(3), mode="partial", start=day(0))
    assert online(store, view) == {("a", 2, 4.0), ("b", 1, 2.0)}
    # The source now holds nothing but the new rows: what was folded is not needed again.
    write_events(spark, later, [("a", day(5), 10.0), ("c", day(6), 4.0), ("a", day(3), 99.0)])
    view = sums_view(later)
    store.registry.views["sums"] = view
    assert store.materialize_incremental(day(7), mode="partial") == {"sums": 2}
    # The row at the stored end is behind the open start: each row is added once.
    assert online(store, view) == {("a", 3, 14.0), ("b", 1, 2.0), ("c", 1, 4.0)}
    assert store.materialize_incremental(day(7), mode="partial") == {"sums": 0}
    assert online(store, view) == {("a", 3, 14.0), ("b", 1, 2.0), ("c", 1, 4.0)}


def test_a_run_lost_between_state_and_publishing_is_caught_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "e")
    write_events(spark, path, [("a", day(1), 1.0), ("b", day(4), 2.0), ("a", day(8), 4.0)])
    view = sums_view(path)
    store = FeatureStore(spark, str(tmp_path / "store"), buckets=3)
    store.apply([view])
    store.materialize(day(0), day(2))
    with monkeypatch.context() as broken:
        broken.setattr(FeatureStore, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.materialize_incremental(day(5), mode="partial")
    assert online(store, view) == {("a", 1, 1.0)}
    assert store.materialize_incremental(day(9), mode="partial") == {"sums": 2}
    assert online(store, view) == {("a", 2, 5.0), ("b", 1, 2.0)}


def test_two_runs_over_one_interval_add_it_once(spark, tmp_path):
    path = str(tmp_path / "e")
    write_events(spark, path, [("a", day(1), 1.0), ("b", day(4), 2.0)])
    view = sums_view(path)
    store = FeatureStore(spark, str(tmp_path / "store"), buckets=2)
    store.apply([view])
    store.materialize(day(0), day(2))
    threads = [threading.Thread(target=store.materialize_incremental, args=(day(5),), kwargs={"mode": "partial"}) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert online(store, view) == {("a", 1, 1.0), ("b", 1, 2.0)}
    assert {r.n for r in store.state(view).rows().filter("user_id = 'b'").collect()} == {1}


def test_feature_views_from_partial_totals(spark, tmp_path):
    rows = [(f"u{i % 3}", f"i{i % 4}", float(i % 5 + 1), "t", "x" * i, 1_704_067_200_000 + i * 86_400_000, i, f"c{i % 2}") for i in range(30)]
    rows.append(("u0", "i0", None, None, None, 1_704_067_200_000, None, None))
    schema = "user_id string, parent_asin string, rating double, title string, text string, timestamp bigint, helpful_vote int, category string"
    raw = spark.createDataFrame(rows, schema)
    raw.write.parquet(str(tmp_path / "raw"))
    source = Source("raw", path=str(tmp_path / "raw"), millis_field="timestamp")
    store = FeatureStore(spark, str(tmp_path / "store"), buckets=2)
    views = partial_views(source)
    store.apply(views)
    store.materialize(day(-1), day(9))
    for end in (day(9), day(15), day(40)):
        store.materialize_incremental(end, mode="partial")
    full = FeatureStore(spark, str(tmp_path / "full"), buckets=2)
    full.apply(views)
    full.materialize(day(-1), day(40))
    for view in views:
        def rounded(s):
            return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in online(s, view)}
        assert rounded(store) == rounded(full) and len(rounded(full)) in (3, 4)
    # A run that folds the whole history agrees with partial ones.
    store.materialize_incremental(day(50), mode="recompute")
    assert ft.USER_FEATURES == tuple(views[0].features)
