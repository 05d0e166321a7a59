"""Exact top-k of many queries against many vectors, block by block with bounds.

Vectors are cut into blocks that lie close together, known by their centre, radius and
largest norm.  Blocks of the largest norms come first; a bounded round of blocks is broadcast at
a time, so each vector is sent once per round and executor, not once per block of
queries.  A query keeps its best so far and skips every block whose bound cannot reach
its k-th score; a query that no block left can improve takes no part in further rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.sampling import sample_exact
from reviewloom.operators.skew import join_counted
from reviewloom.operators.topk import RANK_DIGITS
from reviewloom.session import discard, written

BLOCK_VECTORS = 2_048
ROUND_BYTES = 64 << 20    # vectors of one round as doubles
ROUND_VECTORS = 1 << 20   # of short vectors so many at most, whose ids take as much
STRIPE = 512              # queries that meet the blocks at a time
CENTRES = 64              # groups of like direction that blocks are cut from
FIT_VECTORS = 16_384      # vectors that these are learnt on
SLACK = 2 * 10.0 ** -RANK_DIGITS  # rounding of scores, which bounds must not fall below


def _prepared(rows: DataFrame, name: str, vector: str, metric: str) -> DataFrame:
    """``id`` and ``vec`` of the rows that can be compared: finite, and for cosine scaled to unit length."""
    value = F.col(vector).cast("array<double>")
    kept = rows.select(F.col(name).alias("id"), value.alias("vec")).filter(
        F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    if metric == "dot":
        return kept.withColumn("norm", norm)
    unit = kept.withColumn("_n", norm).filter((F.col("_n") > 0) & (F.col("_n") < float("inf")))
    return unit.select("id", F.expr("transform(vec, x -> x / _n)").alias("vec"), F.lit(1.0).alias("norm"))


def _blocked(vectors: DataFrame, seed: int) -> tuple[DataFrame, list[tuple[str, float, int]]]:
    """``vectors`` with their ``block``, and per block its name, largest norm and size: the highest norms first."""
    some = sample_exact(vectors, FIT_VECTORS, ("id",), seed).select("vec").collect()
    points = np.array([r["vec"] for r in some])
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:CENTRES]]
    for _ in range(5):
        own = np.argmin((centres ** 2).sum(1) - 2 * points @ centres.T, axis=1)
        centres = np.array([points[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
    schema = T.StructType([*vectors.schema.fields, T.StructField("near", T.IntegerType())])
    offset = (centres ** 2).sum(1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                near = np.argmin(offset - 2 * values @ centres.T, axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=schema.names)

    # Tiers of norm within a group; a large one is cut by the digest of ids.
    tier = F.floor(F.log2(F.greatest("norm", F.lit(1e-300))) * 4).cast("int")
    near = written(vectors.mapInArrow(assign, schema).withColumn("tier", tier), "near")
    sizes = near.groupBy("near", "tier").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("_parts"))
    cut = join_counted(near, written(sizes, "sizes"), ["near", "tier"], "inner")
    named = cut.withColumn("block", F.concat_ws(".", "near", "tier", F.pmod(F.xxhash64("id"), F.col("_parts")))).select("block", "id", "vec", "norm")
    named = written(named, "blocked")
    discard(near)
    # One row per block of about BLOCK_VECTORS vectors.
    rows = named.groupBy("block").agg(F.max("norm").alias("top"), F.count("*").alias("n")).orderBy(F.desc("top"), "block").collect()
    return named, [(r["block"], r["top"], r["n"]) for r in rows]


def _rounds(blocks: list[tuple[str, float, int]], most: int) -> list[list[tuple[str, float, int]]]:
    out, size = [[]], 0
    for block in blocks:
        if out[-1] and size + block[2] > most:
            out.append([])
            size = 0
        out[-1].append(block)
        size += block[2]
    return out


def _merge(best: list[tuple[float, object]], scores: np.ndarray, ids: pa.Array, k: int) -> list[tuple[float, object]]:
    """The ``k`` best of what there is and of a block whose ids are in order; entries are (minus score, id)."""
    floor = -best[-1][0] if len(best) == k else -np.inf
    if len(scores) > k:
        floor = max(floor, np.partition(scores, len(scores) - k)[-k])
    at = np.flatnonzero(scores >= floor)
    at = at[np.argsort(-scores[at], kind="stable")][:k]
    return sorted(best + list(zip((-scores[at]).tolist(), ids.take(pa.array(at)).to_pylist())))[:k]


def pruned_top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, *, query_id: str = "query_id", query_vec: str = "query_vec",
                 vector_id: str = "vector_id", vector_vec: str = "embedding", metric: str = "cosine",
                 round_bytes: int = ROUND_BYTES, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``query_id, vector_id, score, rank`` as ``top_k`` gives them, and per round what was compared and skipped.

    The second frame has one row per round: ``round``, ``vectors`` sent, ``queries`` still
    asking, and of their pairs with blocks how many were ``compared`` and ``skipped``.
    """
    spark = queries.sparkSession
    asked = written(_prepared(queries, query_id, query_vec, metric), "asked")
    prepared = written(_prepared(vectors, vector_id, vector_vec, metric), "prepared")
    kinds = {"query_id": asked.schema["id"].dataType, "vector_id": prepared.schema["id"].dataType}
    if any(not isinstance(t, (T.LongType, T.StringType)) for t in kinds.values()):
        raise TypeError("query and vector ids must be bigint or string")
    found_schema = T.StructType([*[T.StructField(n, t) for n, t in kinds.items()], T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    report_schema = "round int, vectors bigint, queries bigint, compared bigint, skipped bigint"
    first = prepared.first()
    if first is None or asked.isEmpty():
        return spark.createDataFrame([], found_schema), spark.createDataFrame([], report_schema)
    blocked, blocks = _blocked(prepared, seed)
    rounds = _rounds(blocks, max(1, min(ROUND_VECTORS, round_bytes // (8 * len(first["vec"])))))
    of_block = spark.createDataFrame([(b, i) for i, r in enumerate(rounds) for b, _, _ in r], "block string, round int")
    path_rows = written_by_round(join_counted(blocked, of_block, "block", "inner"))
    discard(blocked)
    ids = T.ArrayType(kinds["vector_id"])
    state_schema = T.StructType([T.StructField("id", kinds["query_id"]), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("ids", ids),
                                 T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("open", T.BooleanType()),
                                 T.StructField("compared", T.LongType()), T.StructField("skipped", T.LongType())])
    state = asked.select("id", "vec", F.array().cast(ids).alias("ids"), F.array().cast("array<double>").alias("scores"),
                         F.lit(True).alias("open"), F.lit(0).cast("bigint").alias("compared"), F.lit(0).cast("bigint").alias("skipped"))
    finished, report = [], []
    for number, blocks_now in enumerate(rounds):
        left = max((top for r in rounds[number + 1:] for _, top, _ in r), default=None)
        # At most ROUND_BYTES of vectors.
        sent = spark.sparkContext.broadcast(_packed(path_rows.filter(F.col("round") == number)))
        after = written(state.mapInArrow(_step(sent, k, left, state_schema), state_schema), "best")
        seen = after.agg(F.count("*").alias("q"), F.sum("compared").alias("c"), F.sum("skipped").alias("s"), F.count_if("open").alias("o")).first()
        report.append((number, sum(n for _, _, n in blocks_now), seen["q"], seen["c"], seen["s"]))
        sent.destroy()
        finished.append(after.filter(~F.col("open")).select("id", "ids", "scores"))
        if not seen["o"]:
            break
        state = after.filter("open").withColumns({"compared": F.lit(0).cast("bigint"), "skipped": F.lit(0).cast("bigint")})
    done = finished[0]
    for part in finished[1:]:
        done = done.unionByName(part)
    pairs = done.select(F.col("id").alias("query_id"), F.posexplode(F.arrays_zip("ids", "scores")).alias("_at", "_hit"))
    found = pairs.select("query_id", F.col("_hit.ids").alias("vector_id"), F.col("_hit.scores").alias("score"), (F.col("_at") + 1).alias("rank"))
    return found, spark.createDataFrame(report, report_schema)


def written_by_round(rows: DataFrame) -> DataFrame:
    """Rows in one folder per round, read back so that a round reads its own folder."""
    from reviewloom.session import scratch_path
    path = scratch_path(rows.sparkSession, "rounds")
    rows.repartition("round", "block").write.partitionBy("round").parquet(path)
    return rows.sparkSession.read.parquet(path)


def _packed(rows: DataFrame) -> list[tuple[pa.Array, np.ndarray, np.ndarray, float, float]]:
    """Blocks of one round: ids in order, vectors, centre, radius and largest norm; ids and vectors stay Arrow and numpy."""
    held = rows.select("block", "id", "vec").toArrow().combine_chunks()
    held = held.take(pc.sort_indices(held.select(["block", "id"]), sort_keys=[("block", "ascending"), ("id", "ascending")]))
    if not held.num_rows:
        return []
    names, ids = held.column("block").combine_chunks(), held.column("id").combine_chunks()
    vectors = held.column("vec").combine_chunks().flatten().to_numpy().reshape(held.num_rows, -1)
    runs = pc.run_end_encode(names)
    ends = runs.run_ends.to_numpy()
    out = []
    for start, end in zip(np.concatenate([[0], ends[:-1]]), ends):
        values = vectors[start:end].copy()
        centre = values.mean(axis=0)
        radius = float(np.sqrt(((values - centre) ** 2).sum(axis=1).max()))
        # Joined anew, so that a block does not carry the ids of its whole round.
        own = pa.concat_arrays([ids.slice(start, end - start), ids.slice(0, 0)])
        out.append((own, values, centre, radius, float(np.sqrt((values ** 2).sum(axis=1).max()))))
    return sorted(out, key=lambda b: -b[4])


def _step(sent, k: int, left: float | None, schema: T.StructType):
    """One round over the queries of a task: blocks by falling bound, each only for the queries it can improve."""
    kinds = {T.LongType: pa.int64(), T.StringType: pa.string()}
    id_kind = kinds[type(schema["ids"].dataType.elementType)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sent.value
        centres = np.array([b[2] for b in blocks])
        radii, tops = np.array([b[3] for b in blocks]), np.array([b[4] for b in blocks])
        # A stripe's scores against one block, and its bounds on all blocks, are what a task holds beside the round.
        for batch in (b.slice(at, STRIPE) for b in batches for at in range(0, b.num_rows, STRIPE)):
            q = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            norms = np.sqrt((q ** 2).sum(axis=1))
            best = [sorted(zip((-s for s in scores), ids)) for ids, scores in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            floor = np.array([-b[-1][0] if len(b) == k else -np.inf for b in best])
            bound = np.minimum(q @ centres.T + norms[:, None] * radii, norms[:, None] * tops) + SLACK * np.maximum(1.0, norms[:, None] * tops)
            compared = np.zeros(batch.num_rows, dtype=np.int64)
            # Blocks that promise most to the batch come first and raise the floors.
            for b in np.argsort(-(bound / np.maximum(norms, 1e-300)[:, None]).mean(axis=0), kind="stable"):
                wanted = np.flatnonzero(bound[:, b] >= floor)
                if not len(wanted):
                    continue
                compared[wanted] += 1
                names, values = blocks[b][0], blocks[b][1]
                scores = np.round(q[wanted] @ values.T, RANK_DIGITS)
                for row in np.flatnonzero(scores.max(axis=1) >= floor[wanted]):
                    i = wanted[row]
                    best[i] = _merge(best[i], scores[row], names, k)
                    if len(best[i]) == k:
                        floor[i] = -best[i][-1][0]
            open_ = np.zeros(batch.num_rows, dtype=bool) if left is None else norms * left + SLACK * np.maximum(1.0, norms * left) >= floor
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([[i for _, i in b] for b in best], pa.list_(id_kind)),
                pa.array([[-s for s, _ in b] for b in best], pa.list_(pa.float64())), pa.array(open_),
                pa.array(compared), pa.array(len(blocks) - compared)], names=schema.names)

    return step
