"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree gives a vector a string of bits, the sides of random planes through the
mean.  Rows of a tree, sorted by that string, hold all that share a prefix with a query
next to each other.  A query descends to its longest matching prefix in every tree and
ascends in all of them together, to shorter prefixes, until enough candidates are
matched; those are compared by exact distance.

Trees are cut into blocks by a short prefix and, where many rows share it, by digest;
a task sorts the strings of one block and finds a query's prefix by binary search.
How many candidates are enough is measured: a fixed number of queries is answered
exactly first, and the number is doubled until their recall is reached.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import written

TREES = 16
BITS = 48               # of a hash string
BLOCK = 4_096           # vectors in a block, about
PROBES = 100            # queries answered exactly to choose the number of candidates
RECALL = 0.97           # of the probes, on which the candidates are chosen
FIRST_CANDIDATES = 256
SEED = 5


def planes(dimension: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(TREES * BITS, dimension))


def hash_strings(vectors: np.ndarray, mean: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Bits of every tree as one number, the first bit highest: (vectors, trees)."""
    sides = ((vectors - mean) @ normals.T > 0).reshape(len(vectors), TREES, BITS)
    return sides @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _usable(embeddings: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """Distinct vectors with their ids, without those that are null, zero, or hold null or non-finite components."""
    values = F.col(vector).cast("array<double>")
    kept = embeddings.select(F.col(vector_id).cast("bigint").alias("id"), values.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return kept


def _distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, one query at a time so that every way of cutting gives the same bits."""
    apart = rows - query
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 10, vector_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank (from 1), vec_id and score (Euclidean distance).

    ``queries`` has rows like ``embeddings``; candidates are all rows but those with the
    query's own id.  Nearest first, ties to the smaller id; all candidates where there
    are fewer than ``k``.  Vectors that are null, zero, of another length than most, or
    hold null or non-finite components take no part, neither do null ids; rows that
    repeat id and vector count once.  Equal vectors are indexed once, with their ``k + 1``
    smallest ids, as no query can return more of them.
    """
    spark = embeddings.sparkSession
    usable, asked = _usable(embeddings, vector_id, vector), _usable(queries, vector_id, vector)
    lengths = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dimension = lengths["n"]
    of_length = F.size("v") == dimension
    points = written(_least_ids(usable.filter(of_length), k + 1), "points")
    probes = written(asked.filter(of_length).groupBy("v").agg(F.min("id").alias("q")).select("q", "v"), "queries")
    total = points.count()
    mean = np.array(points.select(F.array(*[F.avg(F.col("v")[i]) for i in range(dimension)])).first()[0])
    normals = planes(dimension)
    depth = max(0, int(np.ceil(np.log2(max(total, 1) / BLOCK))))

    def strings(ids: str) -> T.StructType:
        return T.StructType([T.StructField(ids, T.LongType()), T.StructField("tree", T.IntegerType()), T.StructField("bits", T.LongType()),
                             T.StructField("v", T.ArrayType(T.DoubleType()))])

    def hashed(ids: str):
        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    codes = hash_strings(np.stack(batch["v"].to_numpy()), mean, normals)
                    for tree in range(TREES):
                        yield pd.DataFrame({ids: batch[ids], "tree": np.int32(tree), "bits": codes[:, tree], "v": batch["v"]})
        return each

    # Blocks: rows of one tree with one short prefix, cut by digest where there are many.
    rows = points.select("p", "v").mapInPandas(hashed("p"), strings("p")).withColumn("prefix", F.shiftright("bits", BITS - depth))
    rows = written(rows, "forest")
    parts = written(rows.groupBy("tree", "prefix").agg(F.ceil(F.count("*") / (2 * BLOCK)).cast("int").alias("parts")), "parts")
    blocks = rows.join(parts, ["tree", "prefix"]).withColumn("part", F.pmod(F.xxhash64("p"), F.col("parts")).cast("int")).drop("parts")
    searched = probes.mapInPandas(hashed("q"), T.StructType([T.StructField("q", T.LongType()), *strings("p").fields[1:]]))
    searched = written(searched, "searched")
    exact = _exact(points, probes, k)
    sought = written(_descents(blocks, searched, parts, depth), "descents")
    levels = _levels(sought, exact, searched, rows, total)
    return _expand(_compared(blocks, searched, parts, levels, depth, k), points, asked.filter(of_length), k)


def _least_ids(usable: DataFrame, most: int) -> DataFrame:
    """Distinct vectors: ``p`` (smallest id), ``v`` and ``ids``, the smallest ``most`` of its ids."""
    # Ids are first reduced in as many parts as their digest gives, so that a vector of very many rows is not gathered.
    parts = usable.groupBy("v", F.pmod(F.xxhash64("id"), F.lit(64)).alias("_part")).agg(
        *[F.slice(F.array_sort(F.collect_set("id")), 1, most).alias("_ids")])
    whole = parts.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("_ids"))), 1, most).alias("ids"))
    return whole.select(F.col("ids")[0].alias("p"), "v", "ids")


def _exact(points: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """True neighbours (q, p) of a fixed number of queries, by comparing them with every vector."""
    drawn = probes.orderBy(F.xxhash64("q"), "q").limit(PROBES).collect()  # at most PROBES rows
    ids = np.array([r["q"] for r in drawn], dtype=np.int64)
    vectors = np.array([r["v"] for r in drawn], dtype=float)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            rows, names = np.stack(batch["v"].to_numpy()), batch["p"].to_numpy()
            for q, v in zip(ids, vectors):
                d = np.where(names == q, np.inf, _distances(rows, v))
                at = np.argsort(d, kind="stable")[:k]
                at = at[np.isfinite(d[at])]
                yield pd.DataFrame({"q": q, "p": names[at], "d": d[at]})

    near = points.select("p", "v").mapInPandas(best, "q long, p long, d double")
    # Each task has sent k rows for every probe and batch.
    ranked = near.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "p"))), 1, k).alias("best"))
    return ranked.select("q", F.explode("best").alias("b")).select("q", F.col("b.p").alias("p"))


def _meetings(blocks: DataFrame, searched: DataFrame, parts: DataFrame, depth: int) -> DataFrame:
    """Rows of blocks and the queries that meet them, grouped by block.

    ``searched`` has ``level``, the length of prefix that a query needs at least: shorter
    than a block's prefix it meets every block below it.
    """
    wide = searched.withColumn("_short", F.least("level", F.lit(depth)))
    spread = wide.select("q", "tree", "bits", "v", "level", F.explode(F.expr(
        f"sequence(shiftleft(shiftright(bits, cast({BITS} - _short as int)), cast({depth} - _short as int)), "
        f"shiftleft(shiftright(bits, cast({BITS} - _short as int)) + 1, cast({depth} - _short as int)) - 1)")).alias("prefix"))
    met = spread.join(parts, ["tree", "prefix"]).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
    return (blocks.select("tree", "prefix", "part", F.col("p").alias("id"), "bits", "v", F.lit(None).cast("int").alias("level"))
                  .unionByName(met.select("tree", "prefix", "part", F.col("q").alias("id"), "bits", "v", "level")))


def _found(strings: np.ndarray, bits: np.ndarray, length: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and row after the last whose string shares the first ``length`` bits, in a sorted array."""
    shift = BITS - np.asarray(length, dtype=np.int64)
    low = (bits >> shift) << shift
    return np.searchsorted(strings, low), np.searchsorted(strings, low + (np.int64(1) << shift))


def _descents(blocks: DataFrame, searched: DataFrame, parts: DataFrame, depth: int) -> DataFrame:
    """How many rows share at least so many bits with a query, in all trees: ``q`` and ``counts`` for each length of prefix."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["level"].notna().to_numpy()
        strings, bits = np.sort(group["bits"].to_numpy()[~asks]), group["bits"].to_numpy()[asks]
        counts = np.zeros((len(bits), BITS + 1), dtype=np.int64)
        for length in range(depth, BITS + 1):
            first, last = _found(strings, bits, length)
            counts[:, length] = last - first
        return pd.DataFrame({"q": group["id"].to_numpy()[asks], "counts": pd.Series(list(counts), dtype=object)})

    slim = [c.drop("v").withColumn("v", F.lit(None).cast("array<double>")) for c in (blocks, searched)]
    met = _meetings(slim[0], slim[1].withColumn("level", F.lit(depth)), parts, depth).drop("v")
    per_block = met.groupBy("tree", "prefix", "part").applyInPandas(count, "q long, counts array<long>")
    inside = per_block.groupBy("q").agg(*[F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(depth, BITS + 1)])
    # Prefixes shorter than those of blocks: from the sizes of blocks.
    if not depth:
        return inside.select("q", F.array(*[F.col(f"c{i}") for i in range(BITS + 1)]).alias("counts"))
    sizes = blocks.groupBy("tree", "prefix").count()
    short = None
    for length in range(depth):
        above = sizes.groupBy("tree", F.shiftright("prefix", depth - length).alias("_top")).agg(F.sum("count").alias("_rows"))
        one = (searched.select("q", "tree", F.shiftright("bits", BITS - length).alias("_top")).join(above, ["tree", "_top"])
                       .groupBy("q").agg(F.sum("_rows").alias("_rows")).withColumn("_length", F.lit(length)))
        short = one if short is None else short.unionByName(one)
    short = short.groupBy("q").agg(*[F.max(F.when(F.col("_length") == i, F.col("_rows"))).alias(f"c{i}") for i in range(depth)])
    return inside.join(short, "q").select("q", F.array(*[F.col(f"c{i}") for i in range(BITS + 1)]).alias("counts"))


def _levels(sought: DataFrame, exact: DataFrame, searched: DataFrame, rows: DataFrame, total: int) -> DataFrame:
    """``q`` and ``level``: the longest prefix at which all trees together match enough rows."""
    own = exact.join(searched.select("q", "tree", F.col("bits").alias("_q")), "q").join(
        rows.select("p", "tree", F.col("bits").alias("_p")), ["p", "tree"])
    differ = F.col("_q").bitwiseXOR(F.col("_p"))
    shared = F.when(differ == 0, BITS).otherwise(F.lit(BITS - 1) - F.floor(F.log2(differ.cast("double"))).cast("int"))
    reach = written(own.groupBy("q", "p").agg(F.max(shared).alias("_reach")), "reach")
    enough = FIRST_CANDIDATES
    while True:
        level = F.expr(f"coalesce(array_max(filter(transform(counts, (c, i) -> if(c >= {enough}, i, -1)), x -> x >= 0)), 0)").cast("int")
        levels = sought.select("q", level.alias("level"))
        recall = reach.join(levels, "q").agg(F.avg((F.col("_reach") >= F.col("level")).cast("double"))).first()[0]
        if recall is None or recall >= RECALL or enough >= total * TREES:
            return levels
        enough *= 2


def _compared(blocks: DataFrame, searched: DataFrame, parts: DataFrame, levels: DataFrame, depth: int, k: int) -> DataFrame:
    """The ``k + 1`` best distinct vectors of each query: q, p, d."""
    met = _meetings(blocks, searched.join(levels, "q"), parts, depth)

    def best(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["level"].notna().to_numpy()
        rows, queries = group[~asks].sort_values(["bits", "id"]), group[asks]
        empty = pd.DataFrame({"q": np.empty(0, np.int64), "p": np.empty(0, np.int64), "d": np.empty(0)})
        if not len(rows) or not len(queries):
            return empty
        vectors, names = np.stack(rows["v"].to_numpy()), rows["id"].to_numpy()
        first, last = _found(rows["bits"].to_numpy(), queries["bits"].to_numpy(), queries["level"].to_numpy().astype(np.int64))
        found = [empty]
        for q, v, a, b in zip(queries["id"], queries["v"], first, last):
            if b > a:
                d = _distances(vectors[a:b], np.asarray(v))
                at = np.lexsort((names[a:b], d))[:k + 1]
                found.append(pd.DataFrame({"q": q, "p": names[a:b][at], "d": d[at]}))
        return pd.concat(found)

    near = met.groupBy("tree", "prefix", "part").applyInPandas(best, "q long, p long, d double").distinct()
    # Each block has sent k + 1 rows for a query.
    top = near.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "p"))), 1, k + 1).alias("best"))
    return top.select("q", F.explode("best").alias("b")).select("q", "b.p", "b.d")


def _expand(near: DataFrame, points: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Ids of equal vectors for distinct ones, for every query id of an equal query."""
    listed = near.join(points.select("p", "ids"), "p").select("q", "d", F.explode("ids").alias("id"))
    per_vector = listed.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "id"))), 1, k + 1).alias("best"))
    of_vector = asked.groupBy("v").agg(F.min("id").alias("q"))
    ids = asked.select("id", "v").distinct().join(of_vector, "v").select("q", F.col("id").alias("query_id"))
    ranked = ids.join(per_vector, "q").select("query_id", F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.d").alias("score"))
