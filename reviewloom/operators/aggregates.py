"""Mean vectors and request statistics."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_vectors(df: DataFrame, key: str = "item_id", vector: str = "embedding",
                 out: str = "item_embedding_avg") -> DataFrame:
    """Mean vector per key; partial sums per task keep a hot key to one row per task."""
    usable = df.filter(F.col(vector).isNotNull())
    packed = usable.select(F.col(key), array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    mean = vector_to_array(Summarizer.mean(F.col("_v")), "float64")
    return packed.groupBy(key).agg(mean.alias(out))


def request_stats(log: DataFrame, service: str = "service", latency: str = "latency_ms") -> DataFrame:
    """Per service and overall: requests, average, best and worst latency."""
    rolled = log.rollup(service).agg(
        F.count("*").alias("total"), F.avg(latency).alias("avg"), F.min(latency).alias("best"),
        F.max(latency).alias("worst"), F.grouping(service).alias("_all"))
    name = F.when(F.col("_all") == 1, "all").otherwise(F.col(service))
    return rolled.select(name.alias(service), "total", "avg", "best", "worst")
