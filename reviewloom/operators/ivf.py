"""Approximate vector search through clusters of unit vectors."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.vectors import l2_normalize
from reviewloom.operators.topk import cluster_top_k, top_k
from reviewloom.session import written

# Fixed value: number of clusters of the index.
N_LIST = 128


def _features(vectors: DataFrame, vector: str) -> DataFrame:
    unit = vectors.withColumn("_unit", l2_normalize(vector)).filter(F.col("_unit").isNotNull())
    return unit.withColumn("features", array_to_vector("_unit")).drop("_unit")


def fit_clusters(vectors: DataFrame, vector: str = "embedding", n_list: int = N_LIST, seed: int = 42) -> KMeansModel:
    """Cluster centres, learnt on all vectors."""
    points = _features(vectors, vector).select("features")
    return KMeans(k=max(2, min(n_list, points.count())), seed=seed, maxIter=10, predictionCol="cluster").fit(points)


def assign_clusters(model: KMeansModel, vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Vectors with their ``cluster``; written by this column, a search reads the probed clusters only."""
    return model.transform(_features(vectors, vector)).drop("features")


def approximate_top_k(queries: DataFrame, clustered: DataFrame, model: KMeansModel, k: int = 5, nprobe: int = 8, *,
                      query_id: str = "query_id", query_vec: str = "query_vec", vector_id: str = "vector_id",
                      vector_vec: str = "embedding") -> DataFrame:
    """Exact top-k inside the ``nprobe`` clusters nearest to each query."""
    spark = queries.sparkSession
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                    "centre bigint, vec array<double>")
    nearest = top_k(queries, centres, nprobe, query_id=query_id, query_vec=query_vec, vector_id="centre", vector_vec="vec")
    probes = (nearest.select(F.col("query_id").alias(query_id), F.col("vector_id").cast("int").alias("cluster"))
                     .join(queries.select(query_id, query_vec), query_id))
    return cluster_top_k(probes, clustered, k, query_id=query_id, query_vec=query_vec, vector_id=vector_id,
                         vector_vec=vector_vec)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact hits (query_id, vector_id) that were found; 1.0 if there are none."""
    hits = exact.select("query_id", "vector_id").join(found.select("query_id", "vector_id", F.lit(1).alias("_hit")), ["query_id", "vector_id"], "left")
    return hits.agg(F.coalesce(F.avg(F.coalesce("_hit", F.lit(0))), F.lit(1.0))).first()[0]


def measured_top_k(queries: DataFrame, clustered: DataFrame, model: KMeansModel, k: int = 5, nprobe: int = 8, least: float = 0.9, *,
                   query_id: str = "query_id", query_vec: str = "query_vec", vector_id: str = "vector_id",
                   vector_vec: str = "embedding") -> DataFrame:
    """``approximate_top_k`` with as many more probes, by half each time, as the recall over all queries needs to reach ``least``."""
    names = {"query_id": query_id, "query_vec": query_vec, "vector_id": vector_id, "vector_vec": vector_vec}
    exact = written(top_k(queries, clustered, k, **names), "exact")
    clusters = len(model.clusterCenters())
    nprobe = min(nprobe, clusters)
    while True:
        found = written(approximate_top_k(queries, clustered, model, k, nprobe, **names), "found")
        if nprobe == clusters or recall(found, exact) >= least:
            return found
        nprobe = min(clusters, nprobe + max(1, nprobe // 2))
