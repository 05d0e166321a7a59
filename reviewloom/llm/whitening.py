"""Embedding whitening by spectral divide and conquer.

The vectors' covariance is summed on the executors; it has as many rows as a vector has
entries, whatever the table's size, so its components are found on the driver.  The
polar factor of the covariance less a shift, by the dynamically weighted Halley
iteration in its QR form, gives the projector on all components above the shift; bases
of its range and of the rest split the covariance into two smaller ones, and so on until
single components are left.  Their matrix is then sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import written

SCALE, OFFSET = 64, 1_000_000   # an entry c becomes floor(SCALE * c) + OFFSET
COMPONENTS = 16
LONGEST = 4_096                 # entries of a vector; its covariance of up to 128 MB is worked on in the driver
EPS = float(np.finfo(float).eps)
NOTHING = 1e-13                 # share of the largest eigenvalue below which a component counts as empty
SEED = 17


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by the QR-based dynamically weighted Halley iteration."""
    n = len(a)
    scale = float(np.linalg.norm(a))
    if scale == 0:
        return np.eye(n)
    x, low = a / scale, EPS
    # From the least lower bound, six steps bring every singular value to 1; a step more is never needed.
    for _ in range(9):
        gap = max(0.0, 4 * (1 - low * low) / low ** 4) ** (1 / 3)
        root = (1 + gap) ** 0.5
        wa = root + 0.5 * max(0.0, 8 - 4 * gap + 8 * (2 - low * low) / (low * low * root)) ** 0.5
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([wc ** 0.5 * x, np.eye(n)]))
        new = (wb / wc) * x + (wa - wb / wc) / wc ** 0.5 * (q[:n] @ q[n:].T)
        moved = float(np.linalg.norm(new - x))
        x = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if moved <= (4 * EPS) ** (1 / 3) and abs(low - 1) < 1e-8:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the components above and below ``shift``; None where the shift parts none off cleanly."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(float(np.trace(projector))))
    if not 0 < rank < n:
        return None
    basis = projector @ np.random.default_rng(SEED).normal(size=(n, n))
    # A second pass through the projector takes out what a poor draw leaves.
    q, _ = np.linalg.qr(basis)
    q, _ = np.linalg.qr(np.hstack([projector @ q[:, :rank], q[:, rank:]]))
    upper, lower = q[:, :rank], q[:, rank:]
    left_over = float(np.linalg.norm(lower.T @ a @ upper))
    return (upper, lower) if left_over <= 1e-12 * n * float(np.linalg.norm(a)) else None


def spectral_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix from large to small, and unit eigenvectors in the columns."""
    n = len(a)
    whole = float(np.linalg.norm(a)) or 1.0
    done: list[tuple[float, np.ndarray]] = []
    waiting = [(a, np.eye(n))]
    while waiting:
        block, basis = waiting.pop()
        diagonal = np.diag(block)
        if len(block) == 1 or float(np.linalg.norm(block - np.diag(diagonal))) <= EPS * whole:
            # Already diagonal: its axes are components.
            done.extend(zip(diagonal.tolist(), basis.T))
            continue
        # The mean lies between the ends; the median halves the work.  The others are for shifts that meet an eigenvalue.
        mean, spread = float(diagonal.mean()), float(np.linalg.norm(block)) / len(block) ** 0.5
        shifts = [float(np.median(diagonal)), mean] + [mean + s * f * spread for f in (0.01, 0.1, 0.3, 1e-4, 1e-6) for s in (1, -1)]
        parts = next((p for s in shifts if (p := _split(block, s)) is not None), None)
        if parts is None:
            # No shift parts eigenvalues that agree to double precision; any basis of them will do.
            done.extend(zip(diagonal.tolist(), basis.T))
            continue
        for part in parts:
            inner = part.T @ block @ part
            waiting.append(((inner + inner.T) / 2, basis @ part))
    done.sort(key=lambda pair: -pair[0])
    vectors = np.array([v for _, v in done]).T
    vectors, _ = np.linalg.qr(vectors)
    return _refined(a, vectors)


def _refined(a: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of first-order correction: what recursion left between components, divided by their distance."""
    inner = vectors.T @ a @ vectors
    values = np.diag(inner).copy()
    apart = values[None, :] - values[:, None]
    # Components too near each other to be told apart stay as they are.
    clear = np.abs(apart) > 1e4 * EPS * float(np.linalg.norm(a))
    turn = np.where(clear, inner / np.where(clear, apart, 1.0), 0.0)
    np.fill_diagonal(turn, 0.0)
    vectors, r = np.linalg.qr(vectors + vectors @ turn)
    vectors = vectors * np.sign(np.diag(r))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _coded(embeddings: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """``vec_id`` and ``x`` of every row whose vector is whole, finite and small enough for a long."""
    values = F.col(vector).cast("array<double>")
    rows = embeddings.select(F.col(vector_id).alias("vec_id"), values.alias("v")).filter(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0 ** 56)))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("bigint") + OFFSET).alias("x"))


def _rows_of(batch: pa.RecordBatch, column: int, dimension: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dimension)


def _summed(rows: DataFrame, dimension: int, width: int, each) -> np.ndarray:
    """Sum over all fit vectors of ``each(x).T @ each(x)``: one matrix per task, its rows added up by number."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = each(_rows_of(batch, 0, dimension))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "g"])

    def added(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [part["i"].iloc[0]], "g": [np.sum(np.stack(part["g"].to_numpy()), axis=0)]})

    schema = "i int, g array<double>"
    # In two turns, so that no task gets a row from every other one.
    tasks = rows.select("x").mapInArrow(products, schema).withColumn("_part", F.spark_partition_id() % 64)
    first = tasks.groupBy("i", "_part").applyInPandas(lambda part: added(part), schema)
    total = first.groupBy("i").applyInPandas(lambda part: added(part), schema).collect()  # width rows of width numbers
    out = np.zeros((width, width))
    for r in total:
        out[r["i"]] = r["g"]
    return out


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row and component ``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    An entry c counts as x = floor(64 c) + 1000000.  The fit list is each distinct x
    vector once: ``n`` vectors with sums S.  ``deviation`` is the exact sum of (n x - S)^2 over a
    row's entries, null where it is beyond a long.  ``whitened`` is x - S/n on the unit
    eigenvectors of the fit list's covariance by falling eigenvalue e, over sqrt(e);
    ``explained`` is e over the sum of all; ``identity_error`` the largest absolute entry
    of the whitened fit list's covariance less the identity, the same in all rows.

    Vectors that are null, hold null or non-finite entries or entries of 2^56 and more,
    or have another length than most take no part; zero vectors do.  Repeated rows each
    have their results, null ids too.  Components without spread (constant entries, fewer
    distinct vectors than components) have no rows, so equal vectors alone, or an empty
    table, give an empty result.  Other columns are ignored.
    """
    spark = embeddings.sparkSession
    schema = T.StructType([embeddings.select(F.col(vector_id).alias("vec_id")).schema["vec_id"], *[T.StructField(n, t) for n, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))]])
    coded = _coded(embeddings, vector_id, vector)
    lengths = coded.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if lengths is None or lengths["length"] == 0:
        return spark.createDataFrame([], schema)
    dimension = lengths["length"]
    if dimension > LONGEST:
        raise ValueError(f"vectors of {dimension} entries; at most {LONGEST} are whitened")
    rows = coded.filter(F.size("x") == dimension)
    fit = written(rows.select("x").distinct(), "fit")
    sums = fit.agg(F.count("*").alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(dimension)]).alias("s")).first()
    n, s = sums["n"], sums["s"]
    mean = np.array([float(v // n) + (v % n) / n for v in s])
    covariance = _summed(fit, dimension, dimension, lambda x: x - mean) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = spectral_components(covariance)
    trace = float(np.trace(covariance))
    found = int((values[:components] > NOTHING * max(values[0], 0.0)).sum()) if trace > 0 else 0
    if not found:
        return spark.createDataFrame([], schema)
    axes = vectors[:, :found] / np.sqrt(values[:found])
    # The constant beside the coordinates carries their mean into the same sum of products.
    moments = _summed(fit, dimension, found + 1, lambda x: np.hstack([(x - mean) @ axes, np.ones((len(x), 1))])) / n
    middle = moments[found, :found]
    error = float(np.abs(moments[:found, :found] - np.outer(middle, middle) - np.eye(found)).max())
    explained = (values[:found] / trace).tolist()
    exact_sums = np.array(s, dtype=object)

    def deviations(x: np.ndarray) -> list[int | None]:
        widest = max(int(x.max()), -int(x.min())) * n + max(abs(v) for v in s)
        if widest < 2 ** 62:
            apart = x * n - exact_sums.astype(np.int64)
            if max(int(apart.max()), -int(apart.min())) ** 2 * dimension < 2 ** 63:
                return (apart * apart).sum(axis=1).tolist()
        exact = ((x.astype(object) * n - exact_sums) ** 2).sum(axis=1)
        return [v if v < 2 ** 63 else None for v in exact]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows_of(batch, 1, dimension)
            rows_in = np.repeat(np.arange(batch.num_rows), found)
            deviation = pa.array(deviations(x), pa.int64()).take(pa.array(rows_in))
            size = batch.num_rows * found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows_in)), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), batch.num_rows)),
                 pa.array(np.full(size, n)), deviation, pa.array(((x - mean) @ axes).ravel()), pa.array(explained * batch.num_rows, pa.float64()),
                 pa.array(np.full(size, error))], names=schema.names)

    return rows.mapInArrow(projected, schema)
