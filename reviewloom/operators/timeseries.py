"""Service metrics over sample tables: rates, ratios, histograms, quantiles, run comparison.

Samples are rows of (series, time, value).  Work is split by series and time window,
so one busy series does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import written

# Bucket edges of the service histograms.
BUCKETS = {
    "rec_request_seconds": (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5),
    "rec_candidates": (10.0, 25.0, 50.0, 100.0, 200.0, 500.0),
    "rag_request_seconds": (0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0),
    "rag_retrieval_seconds": (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5),
    "rag_sources": (0.0, 1.0, 3.0, 5.0, 10.0, 20.0),
}
HIT_RATIO_TARGET = 0.95

CHUNK_ROWS = 1_000_000  # times of one series and window that one task takes in order


def window_start(time: Column | str, seconds: int) -> Column:
    """Start of the tumbling window, as epoch seconds."""
    at = F.col(time) if isinstance(time, str) else time
    return F.floor(F.unix_millis(at) / F.lit(seconds * 1000)).cast("bigint") * seconds


def counter_increase(samples: DataFrame, seconds: int, series: str = "series", time: str = "ts",
                     value: str = "value", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per series and window the increase of a counter; a fall counts as a reset to zero.

    Samples of one series and time are folded first, in order of value.  Deltas are taken
    inside a chunk of time: a window is one chunk, or as many as its times need to have at
    most about ``chunk_rows`` each.  The last sample of the chunk before is carried in as
    the first row, so no delta is lost at a border and no task gets a whole busy window.
    """
    at = samples.filter(F.col(value).isNotNull()).select(
        F.col(series).alias("series"), F.col(time).alias("ts"), F.col(value).cast("double").alias("value"))
    folded = at.groupBy("series", "ts").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"))
    folded = written(folded.withColumn("window_start", window_start("ts", seconds)), "samples")
    counts = folded.groupBy("series", "window_start").agg(F.count("*").alias("_times"))
    # At most one row for every chunk_rows times.
    busy = [(*r[:2], -(-r[2] // chunk_rows)) for r in counts.filter(F.col("_times") > chunk_rows).collect()]
    chunk = F.lit(0).cast("bigint")
    if busy:
        kinds = folded.select("series", "window_start").schema
        cut = samples.sparkSession.createDataFrame(busy, T.StructType([*kinds.fields, T.StructField("_parts", T.LongType())]))
        cut = cut.select(F.col("series").alias("_series"), F.col("window_start").alias("_window"), "_parts")
        folded = folded.join(F.broadcast(cut), F.col("series").eqNullSafe(F.col("_series")) & (F.col("window_start") == F.col("_window")), "left")
        inside = F.unix_micros(F.col("ts").cast("timestamp")) - F.col("window_start") * 1_000_000
        chunk = F.coalesce(F.floor(inside / F.lit(seconds * 1_000_000.0) * F.col("_parts")), F.lit(0)).cast("bigint")
    line = folded.select("series", "window_start", chunk.alias("chunk"), "ts", "low", "high", "n")
    last = line.groupBy("series", "window_start", "chunk").agg(F.max("ts").alias("ts"), F.max_by("high", "ts").alias("high"))
    # One row per series and chunk that has samples.
    before_chunk = Window.partitionBy("series").orderBy("window_start", "chunk")
    carried = (last.withColumns({"_ts": F.lag("ts").over(before_chunk), "_high": F.lag("high").over(before_chunk)}).filter(F.col("_ts").isNotNull())
                   .select("series", "window_start", "chunk", F.col("_ts").alias("ts"), F.col("_high").alias("low"), F.col("_high").alias("high"),
                           F.lit(0).cast("bigint").alias("n")))
    before = F.lag("high").over(Window.partitionBy("series", "window_start", "chunk").orderBy("ts"))
    step = F.when(before.isNull(), F.lit(0.0)).when(F.col("low") >= before, F.col("low") - before).otherwise(F.col("low"))
    grown = line.unionByName(carried).withColumn("_delta", step + F.col("high") - F.col("low")).filter("n > 0")
    return grown.groupBy("series", "window_start").agg(F.sum("_delta").alias("increase"), F.sum("n").alias("samples"))


def counter_rate(samples: DataFrame, seconds: int, series: str = "series", time: str = "ts",
                 value: str = "value") -> DataFrame:
    """Per-second rate of a counter over tumbling windows."""
    grown = counter_increase(samples, seconds, series, time, value)
    return grown.withColumn("rate", F.col("increase") / F.lit(float(seconds)))


def hit_ratio(samples: DataFrame, seconds: int, hit: str, miss: str, series: str = "series", time: str = "ts",
              value: Column | None = None, target: float = HIT_RATIO_TARGET) -> DataFrame:
    """Hits over hits plus misses per window; windows with neither are dropped."""
    amount = F.lit(1.0) if value is None else value
    summed = samples.groupBy(window_start(time, seconds).alias("window_start")).agg(
        F.sum(F.when(F.col(series) == hit, amount).otherwise(0.0)).alias("hits"),
        F.sum(F.when(F.col(series) == miss, amount).otherwise(0.0)).alias("misses"))
    ratio = F.col("hits") / F.nullif(F.col("hits") + F.col("misses"), F.lit(0.0))
    return (summed.withColumn("hit_ratio", ratio).filter(F.col("hit_ratio").isNotNull())
                  .withColumn("on_target", F.col("hit_ratio") > target))


def counter_hit_ratio(samples: DataFrame, seconds: int, hit: str, miss: str, target: float = HIT_RATIO_TARGET, **columns) -> DataFrame:
    """Hits over hits plus misses per window, both as increases of counters; windows in which neither grew are dropped."""
    grown = counter_increase(samples.filter(F.col(columns.get("series", "series")).isin(hit, miss)), seconds, **columns)
    summed = grown.groupBy("window_start").agg(*[
        F.sum(F.when(F.col("series") == name, F.col("increase")).otherwise(0.0)).alias(out) for name, out in ((hit, "hits"), (miss, "misses"))])
    ratio = F.col("hits") / F.nullif(F.col("hits") + F.col("misses"), F.lit(0.0))
    return (summed.withColumn("hit_ratio", ratio).filter(F.col("hit_ratio").isNotNull())
                  .withColumn("on_target", F.col("hit_ratio") > target))


def counter_average(samples: DataFrame, seconds: int, total: str, requests: str, **columns) -> DataFrame:
    """Average per request per window: the increase of one counter over that of another; null where no request came."""
    grown = counter_increase(samples.filter(F.col(columns.get("series", "series")).isin(total, requests)), seconds, **columns)
    summed = grown.groupBy("window_start").agg(*[
        F.sum(F.when(F.col("series") == name, F.col("increase")).otherwise(0.0)).alias(out) for name, out in ((total, "total"), (requests, "requests"))])
    return summed.withColumn("average", F.col("total") / F.nullif(F.col("requests"), F.lit(0.0)))


def histogram(samples: DataFrame, edges: Sequence[float], keys: Sequence[str | Column] = (),
              value: str = "value") -> DataFrame:
    """Cumulative bucket counts per edge (and +Inf), with sum and count of each group.

    Edges become conditional counts of one aggregate; the unfolding to one row per edge
    comes after it, when each group is a single row.
    """
    names = [f"_b{i}" for i in range(len(edges))]
    grouped = samples.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= F.lit(float(e))).alias(n) for e, n in zip(edges, names)],
        F.count(value).alias("count"), F.sum(value).alias("sum"))
    rows = [F.struct(F.lit(float(e)).alias("le"), F.col(n).alias("bucket")) for e, n in zip(edges, names)]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("count").alias("bucket")))
    rest = [c for c in grouped.columns if c not in names]
    return grouped.select(*rest, F.explode(F.array(*rows)).alias("_row")).select(*rest, "_row.le", "_row.bucket")


def status_counts(samples: DataFrame, keys: Sequence[str], status: str = "status") -> DataFrame:
    """Request counters by status."""
    return samples.groupBy(*keys, status).agg(F.count("*").alias("requests"))


def histogram_quantile(buckets: DataFrame, q: float, keys: Sequence[str] = ()) -> DataFrame:
    """Quantile from cumulative buckets by linear interpolation inside the bucket it falls in.

    The first bucket starts at zero (or at its edge when that is not positive); a quantile
    in the +Inf bucket is the highest finite edge; an empty histogram gives null.
    """
    # Only len(edges) rows per group reach these windows.
    line = Window.partitionBy(*keys).orderBy("le")
    whole = Window.partitionBy(*keys)
    steps = (buckets.withColumn("_total", F.max("bucket").over(whole))
                    .withColumn("_rank", F.col("_total") * F.lit(float(q)))
                    .withColumn("_low", F.lag("le").over(line))
                    .withColumn("_below", F.coalesce(F.lag("bucket").over(line), F.lit(0))))
    hit = (F.col("bucket") >= F.col("_rank")) & (F.col("_total") > 0)
    first = steps.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.when(hit, 0).otherwise(1), "le"))) \
                 .filter(F.col("_nth") == 1)
    low = F.coalesce("_low", F.when(F.col("le") > 0, 0.0).otherwise(F.col("le")))
    inside = low + (F.col("le") - low) * (F.col("_rank") - F.col("_below")) / F.nullif(
        (F.col("bucket") - F.col("_below")).cast("double"), F.lit(0.0))
    value = (F.when(F.col("_total") == 0, F.lit(None).cast("double"))
              .when(F.col("le") == float("inf"), F.col("_low"))
              .otherwise(F.coalesce(inside, F.col("le"))))
    return first.select(*keys, value.alias("quantile"))


def gauge_stats(samples: DataFrame, seconds: int, keys: Sequence[str] = (), time: str = "ts", value: str = "value",
                scale: float = 1.0) -> DataFrame:
    """Mean, sum and maximum of a gauge per window, with a unit scale."""
    scaled = F.col(value) / F.lit(scale)
    return samples.groupBy(*keys, window_start(time, seconds).alias("window_start")).agg(
        F.avg(scaled).alias("mean"), F.sum(scaled).alias("total"), F.max(scaled).alias("peak"))


def average_per_request(samples: DataFrame, seconds: int, total: Column, requests: Column, time: str = "ts") -> DataFrame:
    """Summed quantity over the number of requests per window."""
    grouped = samples.groupBy(window_start(time, seconds).alias("window_start")).agg(
        F.sum(total).alias("total"), F.sum(requests).alias("requests"))
    return grouped.withColumn("average", F.col("total") / F.nullif(F.col("requests").cast("double"), F.lit(0.0)))


def compare_runs(runs: DataFrame, baseline: str = "cpu", mode: str = "mode", stages: Sequence[str] = ()) -> DataFrame:
    """Latest finished run per mode against the latest baseline run.

    ``speedup`` is baseline time over run time, ``throughput_gain`` the ratio of throughputs;
    each stage column gets a ``<stage>_speedup``.
    """
    finished = runs.filter(F.col("status") == "FINISHED")
    columns = ["run_name", "start_time", "total_elapsed_s", "throughput", *stages]
    latest = finished.groupBy(mode).agg(F.max_by(F.struct(*columns), F.struct("start_time", "run_name")).alias("_run"))
    latest = latest.select(mode, "_run.*")
    # One row per mode is left, so the frame without partitions is a handful of rows.
    everyone = Window.partitionBy()
    joined = latest.withColumns({
        f"_base_{c}": F.max(F.when(F.col(mode) == baseline, F.col(c))).over(everyone)
        for c in ("total_elapsed_s", "throughput", *stages)})
    ratios = {f"{s}_speedup": F.col(f"_base_{s}") / F.nullif(F.col(s), F.lit(0.0)) for s in stages}
    return joined.select(
        mode, "run_name", "total_elapsed_s", "throughput",
        (F.col("_base_total_elapsed_s") / F.nullif(F.col("total_elapsed_s"), F.lit(0.0))).alias("speedup"),
        (F.col("throughput") / F.nullif(F.col("_base_throughput"), F.lit(0.0))).alias("throughput_gain"),
        *[c.alias(n) for n, c in ratios.items()])
