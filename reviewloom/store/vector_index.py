"""A stored inverted-file index of vectors: centres, one folder per cluster, batches that can be added.

Centres are learnt once on a bounded sample; every vector is assigned to its nearest
centre and written below ``cluster=``, so a search reads the folders of the clusters it
probes and no others.  How many clusters to probe is settled when the index is built, from a
bounded number of vectors whose true neighbours are found by one pass over the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.vectors import l2_normalize
from reviewloom.operators.sampling import sample_exact
from reviewloom.operators.topk import cluster_top_k, top_k
from reviewloom.session import written
from reviewloom.store.buckets import CommitLog

# Fixed value: number of clusters of the index.
N_LIST = 128

FIT_PER_LIST = 256       # vectors per cluster that centres are learnt on
SAMPLE = 200             # vectors whose true neighbours settle the number of probes
RECALL = 0.9             # share of true neighbours that a search is to find
MARGIN = 0.03            # aimed at above it, for the sample's own error
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class IndexState:
    """What the log says now: centres, data folders and how a search was calibrated."""

    version: int
    centres: np.ndarray
    paths: list[str]
    rows: int
    nprobe: int
    recall: float


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has a direction: not null, all entries finite, not all zero."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col(vector).isNotNull() & finite & F.exists(values, lambda x: x != 0))


def _nearest_centres(rows: DataFrame, vector: str, centres: np.ndarray, most: int, out: str, kind: T.DataType) -> DataFrame:
    """``rows`` with the numbers of their nearest centres, best first, ties to the smaller; one number with ``most`` 1."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, kind)])
    at = rows.columns.index(vector)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            unit = values / np.linalg.norm(values, axis=1, keepdims=True)
            scores = np.round(unit @ centres.T, 12)
            if most == 1:
                made = pa.array(scores.argmax(axis=1).astype(np.int32))
            else:
                made = pa.array(list(np.argsort(-scores, axis=1, kind="stable")[:, :most].astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=schema.names)

    return rows.mapInArrow(assign, schema)


class VectorIndex:
    """An index below ``path``; rows keep the columns they were given with."""

    def __init__(self, spark: SparkSession, path: str, vector_id: str = "vector_id", vector: str = "embedding") -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.vector_id, self.vector = vector_id, vector
        self.log = CommitLog(spark, f"{self.path}/log")

    def build(self, vectors: DataFrame, n_list: int = N_LIST, k: int = 5, least: float = RECALL, seed: int = 42) -> IndexState:
        """Index all usable rows of ``vectors`` instead of what is there; returns the new state.

        Vectors must have one length.  Fewer rows than clusters give as many clusters as rows.
        """
        rows = usable(vectors, self.vector)
        total = rows.count()
        lists = max(1, min(n_list, total))
        centres = self._fitted(rows, lists, total, seed)
        path, count = self._assigned(rows, centres, total)
        nprobe, recall = (1, 1.0) if not total else self._calibrated(path, centres, k, least)
        self.log.claim({"kind": "build", "path": path, "rows": count, "nprobe": nprobe, "recall": recall, "centres": centres.tolist()})
        return self.state()

    def append(self, vectors: DataFrame) -> IndexState:
        """Add rows to the clusters of their nearest centres; folders that are there stay as they are."""
        now = self.state()
        rows = usable(vectors, self.vector)
        path, count = self._assigned(rows, now.centres, rows.count())
        self.log.claim({"kind": "append", "path": path, "rows": count, "of": now.version})
        return self.state()

    def state(self) -> IndexState:
        entries = self.log.read()
        built = [v for v, e in entries.items() if e["kind"] == "build"]
        if not built:
            raise KeyError(f"no index below {self.path}")
        first = entries[max(built)]
        added = [e for e in entries.values() if e["kind"] == "append" and e["of"] == max(built)]
        return IndexState(max(built), np.array(first["centres"]), [e["path"] for e in (first, *added) if e["rows"]],
                          first["rows"] + sum(e["rows"] for e in added), first["nprobe"], first["recall"])

    def rows(self, clusters: list[int] | None = None, state: IndexState | None = None) -> DataFrame:
        """Indexed rows with their ``cluster``; with ``clusters`` only those folders are read."""
        now = state or self.state()
        out = None
        for path in now.paths:
            part = self.spark.read.parquet(path)
            part = part if clusters is None else part.filter(F.col("cluster").isin(clusters))
            out = part if out is None else out.unionByName(part)
        if out is None:
            raise ValueError(f"the index below {self.path} is empty")
        return out

    def probed(self, queries: DataFrame, nprobe: int | None = None, query_id: str = "query_id", query_vec: str = "query_vec",
               state: IndexState | None = None) -> DataFrame:
        """``query_id, query_vec, cluster`` of every cluster a query looks into."""
        now = state or self.state()
        asked = usable(queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("query_vec")), "query_vec")
        most = min(nprobe or now.nprobe, len(now.centres))
        # The smallest list has two entries, so that the column is a list in either case.
        listed = _nearest_centres(asked, "query_vec", now.centres, max(2, most), "_clusters", T.ArrayType(T.IntegerType()))
        return listed.select("query_id", "query_vec", F.explode(F.slice("_clusters", 1, most)).alias("cluster"))

    def search(self, queries: DataFrame, k: int = 5, nprobe: int | None = None, query_id: str = "query_id",
               query_vec: str = "query_vec") -> DataFrame:
        """``query_id, vector_id, score, rank``: the best by cosine in the clusters nearest to each query."""
        now = self.state()
        probes = written(self.probed(queries, nprobe, query_id, query_vec, now), "probes")
        # At most as many numbers as the index has clusters.
        wanted = sorted(r[0] for r in probes.select("cluster").distinct().collect())
        found = self.rows(wanted, now).select(F.col(self.vector_id).alias("vector_id"), F.col(self.vector).alias("embedding"), "cluster")
        return cluster_top_k(probes, found, k)

    def measured(self, queries: DataFrame, k: int = 5, most: int = SAMPLE, query_id: str = "query_id", query_vec: str = "query_vec") -> float:
        """Recall of at most ``most`` of the queries, drawn by digest, against one pass over all indexed vectors."""
        drawn = written(sample_exact(queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("query_vec")), most, ("query_id",)), "drawn")
        exact = top_k(drawn, self.rows(), k, vector_id=self.vector_id, vector_vec=self.vector)
        found = self.search(drawn, k)
        hits = exact.select("query_id", "vector_id").join(found.select("query_id", "vector_id", F.lit(1.0).alias("_hit")), ["query_id", "vector_id"], "left")
        return hits.agg(F.coalesce(F.avg(F.coalesce("_hit", F.lit(0.0))), F.lit(1.0))).first()[0]

    def _fitted(self, rows: DataFrame, lists: int, total: int, seed: int) -> np.ndarray:
        """Unit centres, learnt on at most ``FIT_PER_LIST`` vectors per cluster, drawn by digest of their id."""
        some = rows.select(self.vector_id, self.vector)
        if total > FIT_PER_LIST * lists:
            some = sample_exact(some, FIT_PER_LIST * lists, (self.vector_id,), seed)
        if lists == 1:
            dim = rows.select(F.size(self.vector)).first()
            return np.eye(1, dim[0] if dim else 1)
        points = written(some.select(array_to_vector(l2_normalize(self.vector)).alias("features")), "points")
        fitted = np.array(KMeans(k=lists, seed=seed, maxIter=15).fit(points).clusterCenters())
        norms = np.linalg.norm(fitted, axis=1, keepdims=True)
        return (fitted / np.where(norms > 0, norms, 1.0))[norms[:, 0] > 0]

    def _assigned(self, rows: DataFrame, centres: np.ndarray, total: int) -> tuple[str, int]:
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        marked = _nearest_centres(rows, self.vector, centres, 1, "cluster", T.IntegerType())
        # A cluster may hold a large share of all rows: it is cut by the digest of ids.
        parts = max(1, -(-total // ROWS_PER_FILE))
        dealt = marked.repartition(F.col("cluster"), F.pmod(F.xxhash64(self.vector_id), F.lit(parts)))
        dealt.write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("cluster").parquet(path)
        return path, total

    def _calibrated(self, path: str, centres: np.ndarray, k: int, least: float) -> tuple[int, float]:
        """Fewest clusters that hold enough of the sample's true neighbours, and the share they hold."""
        stored = self.spark.read.parquet(path).select(F.col(self.vector_id).alias("vector_id"), F.col(self.vector).alias("embedding"), "cluster")
        drawn = written(sample_exact(stored, SAMPLE, ("vector_id",)).select(F.col("vector_id").alias("query_id"), F.col("embedding").alias("query_vec")), "drawn")
        true = top_k(drawn, stored, k + 1).filter(F.col("query_id") != F.col("vector_id"))
        placed = true.join(stored.select("vector_id", "cluster"), "vector_id").select("query_id", "cluster")
        order = _nearest_centres(drawn.withColumn("query_vec", F.col("query_vec").cast("array<double>")), "query_vec", centres, max(2, len(centres)),
                                 "_clusters", T.ArrayType(T.IntegerType()))
        ranks = placed.join(order, "query_id").select(F.array_position("_clusters", F.col("cluster")).alias("rank"))
        # At most SAMPLE times k + 1 numbers.
        at = np.sort([r[0] for r in ranks.collect()])
        if not len(at):
            return 1, 1.0
        aim = min(1.0, least + MARGIN)
        nprobe = int(at[min(len(at) - 1, int(np.ceil(aim * len(at))) - 1)])
        return nprobe, float((at <= nprobe).mean())

