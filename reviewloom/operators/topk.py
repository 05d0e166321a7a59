"""Exact top-k of a vector table per query vector, without emitting pairs.

Few queries travel to the vectors: a counted, bounded query matrix is broadcast and
each partition keeps its own best ``k`` per query.  Many queries meet the vectors in
a grid of bounded cells, each cell again keeping ``k`` per query.  Only those local
winners are shuffled and ranked.  A cell is worked off in smaller blocks, so small blocks
do not mean many copies of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.skew import join_counted

FEW_QUERIES = 4_096
BLOCK_QUERIES = 4_096
BLOCK_VECTORS = 65_536
CLUSTER_BLOCK = 16_384  # vectors of a cluster that meet its queries in one Python task, which holds them several times
QUERY_STRIPE, VECTOR_STRIPE = 256, 4_096
MIN_BLOCK = 1_024
# Every row is sent to each cell of its grid row or column.  Up to so many cells a side as
# blocks are asked for; more only where a cell would exceed so many rows.
COPIES, CELL_ROWS = 8, 65_536
# Scores are ranked after rounding to this many digits, so that equal vectors tie
# exactly wherever they are computed; ties go to the smaller vector id.
RANK_DIGITS = 9


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equal-length list column as a float64 matrix."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(rows) == 0:
        return np.zeros((0, 0))
    lengths = np.unique(np.diff(rows.offsets.to_numpy()))
    if len(lengths) != 1:
        raise ValueError(f"vectors differ in length: {lengths.tolist()}")
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), int(lengths[0]))


def _ready(matrix: np.ndarray, names: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be compared, scaled to unit length for cosine.

    Rows with a null, NaN or infinite element have no score and are left out, as are
    zero rows for cosine, which have no direction.
    """
    if matrix.size == 0:
        return matrix, names
    kept = np.isfinite(matrix).all(axis=1)
    matrix, names = matrix[kept], names[kept]
    if metric == "dot":
        return matrix, names
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    kept = (norms > 0) & np.isfinite(norms)
    return matrix[kept] / norms[kept, None], names[kept]


def _best(table: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = table.sort_values(["q", "score", "vid"], ascending=[True, False, True], kind="stable")
    return ordered[ordered.groupby("q", sort=False).cumcount() < k]


def _first_hits(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the best ``k`` rounded scores of every row, of those that tie at the k-th the first."""
    if scores.shape[1] <= k:
        rows, cols = np.indices(scores.shape)
        return rows.ravel(), cols.ravel()
    floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
    above, level = scores > floor, scores == floor
    left = k - above.sum(axis=1, dtype=np.int32)
    return np.nonzero(above | (level & (np.cumsum(level, axis=1, dtype=np.int32) <= left[:, None])))


def _stripe_top(wanted: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, vector number and score of the best ``k`` of a stripe of queries, vectors taken in stripes too.

    Vectors are in the order of their ids: one of a later stripe that ties with the k-th score loses.
    """
    q, at, score = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    floor = np.full(len(wanted), -np.inf)
    for start in range(0, len(vectors), VECTOR_STRIPE):
        raw = wanted @ vectors[start:start + VECTOR_STRIPE].T
        if start == 0:
            raw = np.round(raw, RANK_DIGITS)
            rows, cols = _first_hits(raw, k)
            values = raw[rows, cols]
        else:
            # What rounds to more than the k-th score is not far below it; only that is rounded.
            least = floor + 0.4 * 10.0 ** -RANK_DIGITS - 1e-15 * np.abs(np.where(np.isfinite(floor), floor, 0.0))
            rows, cols = np.nonzero(raw >= least[:, None])
            values = np.round(raw[rows, cols], RANK_DIGITS)
            higher = values > floor[rows]
            rows, cols, values = rows[higher], cols[higher], values[higher]
            if not len(rows):
                continue
        q, at, score = np.concatenate([q, rows]), np.concatenate([at, cols + start]), np.concatenate([score, values])
        order = np.lexsort((at, -score, q))
        q, at, score = q[order], at[order], score[order]
        first = np.searchsorted(q, q)
        kept = np.arange(len(q)) - first < k
        q, at, score = q[kept], at[kept], score[kept]
        counts = np.bincount(q, minlength=len(wanted))
        full = counts >= k
        floor[full] = score[np.cumsum(counts)[full] - 1]
    return q, at, score


def _local_top(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """Best ``k`` rows of one block for every query; stripes bound the score matrix.

    Scores are rounded first.  Of rows that tie at the k-th score those with the smallest
    ids stay, so no query keeps more than ``k`` rows however many vectors are equal.
    """
    found = [pd.DataFrame({"q": np.zeros(0, int), "vid": ids[:0], "score": np.zeros(0)})]
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    for start in range(0, len(queries) if len(vectors) else 0, QUERY_STRIPE):
        q, at, score = _stripe_top(queries[start:start + QUERY_STRIPE], vectors, k)
        found.append(pd.DataFrame({"q": q + start, "vid": ids[at], "score": score}))
    return pd.concat([f for f in found if len(f)] or found[:1], ignore_index=True)


def _result_schema(queries: DataFrame, vectors: DataFrame, query_id: str, vector_id: str) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema[query_id].dataType),
        T.StructField("vector_id", vectors.schema[vector_id].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _numbers(count: Column) -> Column:
    """Block numbers 0 .. count-1."""
    return F.sequence(F.lit(0).cast("bigint"), count.cast("bigint") - 1)


def _rank(local: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vector_id")
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _broadcast_search(query_rows: list, queries: DataFrame, vectors: DataFrame, k: int, query_id: str,
                      query_vec: str, vector_id: str, vector_vec: str, metric: str) -> DataFrame:
    context = vectors.sparkSession.sparkContext
    ids = np.array([r[query_id] for r in query_rows], dtype=object)
    matrix = np.array([r[query_vec] for r in query_rows], dtype=np.float64)
    sent = context.broadcast(_ready(matrix, ids, metric))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, names = sent.value
        best = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block, found = _ready(_matrix(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False), metric)
            top = _local_top(wanted, block, found, k)
            best = top if best is None else _best(pd.concat([best, top], ignore_index=True), k)
        if best is not None and len(best):
            yield pa.RecordBatch.from_pydict({
                "query_id": names[best["q"].to_numpy()].tolist(), "vector_id": best["vid"].tolist(),
                "score": best["score"].to_numpy(),
            }, schema=out)

    plain = vectors.select(vector_id, vector_vec)
    schema = _result_schema(queries, vectors, query_id, vector_id)
    out = _arrow_schema(schema)
    return plain.mapInArrow(search, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


def _block_search(queries: DataFrame, vectors: DataFrame, blocks: int, schema: T.StructType, k: int, metric: str) -> DataFrame:
    """Search within cells.  Inputs carry ``_r, _c`` cell numbers, an id and a vector.

    The cells are few bytes but much arithmetic, so their number of partitions is fixed
    and not coalesced by size.
    """
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return out.empty_table()
        wanted, names = _ready(_matrix(left.column("vec")), left.column("id").to_numpy(), metric)
        block, found = _ready(_matrix(right.column("vec")), right.column("id").to_numpy(), metric)
        top = _local_top(wanted, block, found, k)
        return pa.Table.from_pydict({
            "query_id": names[top["q"].to_numpy()].tolist(), "vector_id": top["vid"].tolist(), "score": top["score"].to_numpy(),
        }, schema=out)

    out = _arrow_schema(schema)
    parts = min(max(queries.sparkSession.sparkContext.defaultParallelism, blocks), 100_000)
    left, right = (df.repartition(parts, "_r", "_c").groupBy("_r", "_c") for df in (queries, vectors))
    return left.cogroup(right).applyInArrow(search, schema)


def _cells(rows: int, block: int) -> int:
    """How many cells a side of ``rows`` rows is cut into for blocks of ``block`` rows."""
    return max(1, min(ceil(rows / block), max(COPIES, ceil(rows / CELL_ROWS))))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, *, query_id: str = "query_id",
          query_vec: str = "query_vec", vector_id: str = "vector_id", vector_vec: str = "embedding",
          metric: str = "cosine", few_queries: int = FEW_QUERIES, block_queries: int = BLOCK_QUERIES,
          block_vectors: int = BLOCK_VECTORS) -> DataFrame:
    """``query_id, vector_id, score, rank`` for the ``k`` best vectors of every query.

    Vectors with null, NaN or infinite elements take no part, neither as queries.
    """
    if any(f.dataType not in (T.LongType(), T.StringType()) for f in _result_schema(queries, vectors, query_id, vector_id).fields[:2]):
        raise TypeError("query and vector ids must be bigint or string")
    queries = queries.filter(F.col(query_vec).isNotNull())
    vectors = vectors.filter(F.col(vector_vec).isNotNull())
    head = queries.select(query_id, query_vec).limit(few_queries + 1).collect()
    if len(head) <= few_queries:
        if not head:
            return _rank(vectors.sparkSession.createDataFrame([], _result_schema(queries, vectors, query_id, vector_id)), k)
        return _rank(_broadcast_search(head, queries, vectors, k, query_id, query_vec, vector_id, vector_vec, metric), k)

    cols = _cells(queries.count(), block_queries)
    n_vectors = vectors.count()
    rows = _cells(n_vectors, block_vectors)
    # Small tables are cut finer, so that every core gets a cell.
    cores = queries.sparkSession.sparkContext.defaultParallelism
    rows = max(rows, min(ceil(2 * cores / cols), ceil(n_vectors / MIN_BLOCK)))
    left = queries.select(
        F.col(query_id).alias("id"), F.col(query_vec).alias("vec"),
        F.pmod(F.xxhash64(query_id), F.lit(cols)).alias("_c"),
        F.explode(_numbers(F.lit(rows))).alias("_r"))
    right = vectors.select(
        F.col(vector_id).alias("id"), F.col(vector_vec).alias("vec"),
        F.pmod(F.xxhash64(vector_id), F.lit(rows)).alias("_r"),
        F.explode(_numbers(F.lit(cols))).alias("_c"))
    return _rank(_block_search(left, right, rows * cols, _result_schema(queries, vectors, query_id, vector_id), k, metric), k)


def cluster_top_k(probes: DataFrame, clustered: DataFrame, k: int = 5, *, query_id: str = "query_id",
                  query_vec: str = "query_vec", vector_id: str = "vector_id", vector_vec: str = "embedding",
                  metric: str = "cosine", block_vectors: int = CLUSTER_BLOCK, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Top-k among the vectors of the probed clusters.

    ``probes`` lists (query, cluster); both frames carry ``cluster``.  Large clusters and
    clusters probed by many queries are cut into bounded blocks by their counted size.
    """
    # One row per searched cluster.
    sizes = (clustered.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(block_vectors)).alias("_rows"))
             .join(probes.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(block_queries)).alias("_cols")), "cluster"))
    blocks = sizes.agg(F.sum(F.col("_rows") * F.col("_cols"))).first()[0] or 1

    def block(cluster: Column, number: Column) -> Column:
        return cluster.cast("bigint") * F.lit(1 << 32) + number

    left = (join_counted(probes, sizes, "cluster", "inner")
            .select("*", F.explode(_numbers(F.col("_rows"))).alias("_row"))
            .select(F.col(query_id).alias("id"), F.col(query_vec).alias("vec"),
                    block(F.col("cluster"), F.col("_row")).alias("_r"),
                    F.pmod(F.xxhash64(query_id), F.col("_cols")).alias("_c")))
    right = (join_counted(clustered, sizes, "cluster", "inner")
             .select("*", F.explode(_numbers(F.col("_cols"))).alias("_c"))
             .select(F.col(vector_id).alias("id"), F.col(vector_vec).alias("vec"),
                     block(F.col("cluster"), F.pmod(F.xxhash64(vector_id), F.col("_rows"))).alias("_r"), "_c"))
    return _rank(_block_search(left, right, int(blocks), _result_schema(probes, clustered, query_id, vector_id), k, metric), k)
