import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import timeseries as ts
from reviewloom.operators.aggregates import request_stats

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def samples(spark, rows):
    return spark.createDataFrame([(s, T0 + timedelta(seconds=t), v) for s, t, v in rows], "series string, ts timestamp, value double")


def test_increase_over_resets_and_window_borders(spark):
    rows = [("c", 0, 10.0), ("c", 30, 15.0), ("c", 70, 18.0), ("c", 80, 2.0), ("c", 250, 5.0), ("d", 10, 7.0)]
    got = {(r.series, r.window_start - int(T0.timestamp())): r.increase for r in ts.counter_increase(samples(spark, rows), 60).collect()}
    assert got == {("c", 0): 5.0, ("c", 60): 5.0, ("c", 240): 3.0, ("d", 0): 0.0}
    rate = {(r.series, r.window_start - int(T0.timestamp())): r.rate for r in ts.counter_rate(samples(spark, rows), 60).collect()}
    assert rate[("c", 0)] == pytest.approx(5 / 60)


@pytest.mark.parametrize("chunk_rows", [10 ** 6, 7])
def test_one_series_with_half_the_rows(spark, chunk_rows):
    """Chunks of a busy window add up to what one pass in order gives."""
    rng = random.Random(4)
    rows = [("busy", rng.randrange(120), float(rng.randrange(50))) for _ in range(600)]
    rows += [(f"s{i % 20}", rng.randrange(200), float(rng.randrange(9))) for i in range(500)] + [("busy", 5, None), (None, 1, 3.0), (None, 2, 4.5)]
    want, last = {}, {}
    for s, t, v in sorted((r for r in rows if r[2] is not None), key=lambda r: (str(r[0]), r[1], r[2])):
        key = (s, t // 60 * 60)
        delta = 0.0 if s not in last else v - last[s] if v >= last[s] else v
        total, n = want.get(key, (0.0, 0))
        want[key], last[s] = (total + delta, n + 1), v
    got = ts.counter_increase(samples(spark, rows), 60, chunk_rows=chunk_rows)
    assert {(r.series, r.window_start - int(T0.timestamp())): (r.increase, r.samples) for r in got.collect()} == want
    assert "SortAggregate" not in got._jdf.queryExecution().toString()


def test_ratios_over_increases(spark):
    rows = [("hit", 0, 10.0), ("hit", 10, 40.0), ("miss", 5, 1.0), ("miss", 20, 11.0), ("hit", 70, 40.0), ("other", 30, 9.0)]
    got = ts.counter_hit_ratio(samples(spark, rows), 60, "hit", "miss").collect()
    assert [(r.hits, r.misses, r.hit_ratio, r.on_target) for r in got] == [(30.0, 10.0, 0.75, False)]
    mean = ts.counter_average(samples(spark, rows), 60, "hit", "miss").orderBy("window_start").collect()
    assert [(r.total, r.requests, r.average) for r in mean] == [(30.0, 10.0, 3.0), (0.0, 0.0, None)]


def test_hit_ratio_drops_empty_windows(spark):
    rows = [("hit", 0, 1.0), ("hit", 1, 1.0), ("miss", 2, 1.0), ("other", 100, 1.0)]
    got = ts.hit_ratio(samples(spark, rows), 60, "hit", "miss").collect()
    assert [(round(r.hit_ratio, 4), r.on_target) for r in got] == [(0.6667, False)]


def test_histogram_and_quantiles(spark):
    rows = [("s", i, v) for i, v in enumerate([0.5, 1.0, 1.5, 8.0, 50.0])] + [("empty", 0, None)]
    buckets = ts.histogram(samples(spark, rows), (1.0, 2.0, 5.0, 10.0), ["series"])
    got = {r.le: r.bucket for r in buckets.filter("series = 's'").collect()}
    assert got == {1.0: 2, 2.0: 3, 5.0: 3, 10.0: 4, float("inf"): 5}
    assert buckets.filter("series = 's'").first()["sum"] == 61.0

    def q(level):
        return {r.series: r.quantile for r in ts.histogram_quantile(buckets, level, ["series"]).collect()}

    assert q(0.5)["s"] == pytest.approx(1.5)       # halfway into the second bucket
    assert q(0.2)["s"] == pytest.approx(0.5)       # inside the first bucket, from zero
    assert q(0.8)["s"] == pytest.approx(10.0)
    assert q(0.99)["s"] == 10.0                    # beyond the last finite edge
    assert q(0.5)["empty"] is None


def test_gauges_and_averages(spark):
    rows = [("g", 0, 1.0), ("g", 1, 3.0), ("g", 61, 8.0)]
    got = ts.gauge_stats(samples(spark, rows), 60, scale=2.0).orderBy("window_start").collect()
    assert [(r["mean"], r.total, r.peak) for r in got] == [(1.0, 2.0, 1.5), (4.0, 4.0, 4.0)]
    per = ts.average_per_request(samples(spark, rows), 60, F.col("value"), F.lit(1)).orderBy("window_start").collect()
    assert [r.average for r in per] == [2.0, 8.0]


def test_request_stats(spark):
    log = spark.createDataFrame([("rec", 10.0), ("rec", 30.0), ("rag", 50.0)], "service string, latency_ms double")
    got = {r.service: (r.total, r.avg, r.best, r.worst) for r in request_stats(log).collect()}
    assert got == {"rec": (2, 20.0, 10.0, 30.0), "rag": (1, 50.0, 50.0, 50.0), "all": (3, 30.0, 10.0, 50.0)}


def test_run_comparison(spark):
    rows = [("c1", "cpu", 1.0, 800.0, 100.0, "FINISHED", 40.0), ("c2", "cpu", 2.0, 600.0, 150.0, "FINISHED", 30.0),
            ("c3", "cpu", 3.0, 1.0, 1.0, "FAILED", 1.0), ("g1", "gpu", 1.0, 300.0, 300.0, "FINISHED", 0.0)]
    runs = spark.createDataFrame(rows, "run_name string, mode string, start_time double, total_elapsed_s double, throughput double, status string, users double")
    got = {r["mode"]: r for r in ts.compare_runs(runs, stages=["users"]).collect()}
    assert got["cpu"].run_name == "c2" and got["cpu"].speedup == 1.0
    assert got["gpu"].speedup == 2.0 and got["gpu"].throughput_gain == 2.0 and got["gpu"].users_speedup is None
