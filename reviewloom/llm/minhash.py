"""Near-duplicate documents by b-bit MinHash.

Documents with equal shingle sets are one node.  Bands of full minima put nodes into
buckets; signatures keep only the low bits of the minima, packed, and their bit
counts estimate the similarity of a candidate pair, corrected for chance equality.
Pairs that may be similar enough are confirmed on the full shingle sets.

Within a bucket not all pairs are tried.  Every member meets the bucket's smallest
node.  Once components are known, what still lies in different components of one
bucket is compared in blocks of bounded size, first by signature and then, where that
leaves a chance, by full sets.  Pairs inside one component need no test, so no link
between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.components import components
from reviewloom.llm.text import in_small_batches
from reviewloom.llm.words import hashed_texts, mix64, series, shingles
from reviewloom.session import written

BANDS, ROWS = 40, 6   # a pair at similarity 0.8 misses all bands once in 190,000 pairs
LOW_BITS = 4          # kept of each minimum
SLACK = 6.5           # standard deviations that an estimate may lie below the threshold
BUCKET_BLOCK = 1_000  # members of a bucket in one task
BROADCAST_NODES = 1_000_000  # documents whose texts are asked for, 8 bytes each; for more all texts are dealt out
SET_BLOCK = 1_000_000  # shingles in one task
CHUNK = 2048          # shingles whose hashes are formed at a time


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    n = BANDS * ROWS
    return series(n, 101)[:, None], series(n, 202)[:, None]


def minima(values: np.ndarray) -> np.ndarray:
    """Least 32-bit hash of a set under every permutation."""
    factors, shifts = _permutations()
    least = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    for first in range(0, len(values), CHUNK):
        hashed = ((values[None, first:first + CHUNK] * factors + shifts) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    total = (rows * series(ROWS, 303)[None, :]).sum(axis=1, dtype=np.uint64)
    return mix64(total + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def packed(least: np.ndarray) -> bytes:
    """The low bits of all minima, two minima to a byte."""
    low = (least & np.uint32(2 ** LOW_BITS - 1)).astype(np.uint8)
    return (low[::2] | (low[1::2] << 4)).tobytes()


_EQUAL_HALVES = np.array([(not b & 15) + (not b >> 4) for b in range(256)], dtype=np.uint16)


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of signatures (bytes in the last axis), corrected for low bits that are equal by chance."""
    equal = _EQUAL_HALVES[left ^ right].sum(axis=-1) / (BANDS * ROWS)
    chance = 2.0 ** -LOW_BITS
    return (equal - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    chance = 2.0 ** -LOW_BITS
    p = similarity + (1 - similarity) * chance
    return similarity - SLACK * (p * (1 - p) / (BANDS * ROWS)) ** 0.5 / (1 - chance)


def _described(docs: DataFrame, text: str, doc_id: str, length: int) -> DataFrame:
    """One row per document: set size, digest of the set, band keys and packed signature."""
    schema = "doc_id long, n_shingles long, set_key binary, bands array<long>, signature binary"

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for batch in batches:
            texts = [t.lower() if t else t for t in batch.column(1).to_pylist()]  # bytes: only A-Z change
            sizes, keys, bands, signatures = [], [], [], []
            for words in hashed_texts(texts):
                values = np.unique(shingles(words, length, short_as_one=True))
                sizes.append(len(values))
                if len(values):
                    least = minima(values)
                    keys.append(hashlib.md5(values.tobytes()).digest())
                    bands.append(band_keys(least).tolist())
                    signatures.append(packed(least))
                else:
                    keys.append(None), bands.append(None), signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "bands", "signature"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(describe, schema)


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, length: int, percent: int) -> DataFrame:
    """Of pairs (a, b) of nodes, those whose full sets are similar enough."""
    floor = least_estimate(percent / 100)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
                           for c in (2, 3))
            keep = pa.array(estimates(left, right) >= floor)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in (0, 1)], names=["a", "b"])

    # Set sizes alone rule out many pairs: the smaller must reach the share of the larger.
    signed = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("_sa"), F.col("n_shingles").alias("_na")), "a")
                   .join(nodes.select(F.col("node").alias("b"), F.col("signature").alias("_sb"), F.col("n_shingles").alias("_nb")), "b")
                   .filter(F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * percent))
    near = written(signed.select("a", "b", "_sa", "_sb").mapInArrow(likely, "a long, b long").distinct(), "candidates")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full_set(raw: bytes) -> np.ndarray:
            return np.unique(shingles(next(hashed_texts([raw.lower()])), length, short_as_one=True))

        for batch in batches:
            a, b, text_a, text_b = (batch.column(c).to_pylist() for c in range(4))
            kept = []
            previous, right = None, None
            for i in range(len(a)):
                if text_b[i] != previous:
                    previous, right = text_b[i], full_set(text_b[i])
                left = full_set(text_a[i])
                shared = len(left) + len(right) - len(np.union1d(left, right))
                if 100 * shared >= percent * (len(left) + len(right) - shared):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64())],
                                             names=["a", "b"])

    asked = written(near.select(F.col("a").alias("node")).union(near.select("b")).distinct(), "asked")
    if asked.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        texts = texts.join(F.broadcast(asked), "node", "left_semi")
    both = (near.join(texts.select(F.col("node").alias("a"), F.col("_text").alias("_ta")), "a")
                .join(texts.select(F.col("node").alias("b"), F.col("_text").alias("_tb")), "b"))
    return both.select("a", "b", "_ta", "_tb").mapInArrow(exact, "a long, b long").distinct()


def _between(members: DataFrame, weight: str, most: int, link: Callable[..., Iterator[tuple[int, int]]]) -> DataFrame:
    """Links between different components of one group, as few as connect what ``link`` connects.

    ``members``: group, node, component, n_shingles, signature, values.  The largest
    component of a group need not meet itself: every other member meets all members.  A
    group is cut into blocks of at most about ``most`` of ``weight``; a task compares
    blocks, so neither a large group nor its pairs are ever in one place.
    """
    parts = members.groupBy("group", "component").agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"))
    groups = parts.groupBy("group").agg(F.max_by("component", "_n").alias("_main"), F.sum("_w").alias("_all"),
                                        F.count("*").alias("_parts")).filter("_parts > 1")
    groups = written(groups.select("group", "_main", F.ceil(F.col("_all") / most).cast("int").alias("_blocks")), "groups")
    placed = members.join(groups, "group").withColumns({
        "_own": F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"), "_strays": F.col("component") != F.col("_main")})
    every = F.expr("sequence(0, _blocks - 1)")
    columns = ["group", "node", "component", "n_shingles", "signature", "values"]
    strays = placed.filter("_strays")
    # A block meets the blocks that hold strays; strays meet every block.
    asked = strays.select("group", F.col("_own").alias("_j")).distinct()
    sent = placed.select(*columns, F.col("_own").alias("_i"), F.lit(False).alias("asks")).join(asked, "group").unionByName(
        strays.select(*columns, F.col("_own").alias("_j"), F.lit(True).alias("asks"), F.explode(every).alias("_i")))
    total = groups.agg(F.sum("_blocks")).first()[0] or 1
    shards = max(1, int(total) if weight == "n_shingles" else members.count() // most)

    def compare(shard: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, task in shard.groupby(["group", "_i", "_j"], sort=False):
            asks = task["asks"].to_numpy()
            if asks.any() and not asks.all():
                found.extend(link(task[asks], task[~asks]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    # Small groups share a task; whole blocks stay together.
    spread = sent.withColumn("_shard", F.pmod(F.xxhash64("group", "_i", "_j"), F.lit(shards)))
    return spread.groupBy("_shard").applyInPandas(compare, "a long, b long").distinct()


class _Joined:
    """Which components a task has already connected."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.parent.get(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _likely_in(percent: int) -> Callable[..., Iterator[tuple[int, int]]]:
    """Components that have a likely pair."""
    floor = least_estimate(percent / 100)

    def link(asking: pd.DataFrame, asked: pd.DataFrame) -> Iterator[tuple[int, int]]:
        signatures = np.frombuffer(b"".join(asked["signature"]), dtype=np.uint8).reshape(len(asked), -1)
        parts, sizes = asked["component"].to_numpy(), asked["n_shingles"].to_numpy()
        joined = _Joined()
        for part, size, signature in zip(asking["component"], asking["n_shingles"], asking["signature"]):
            at = np.flatnonzero((parts != part) & (np.minimum(sizes, size) * 100 >= np.maximum(sizes, size) * percent))
            if len(at):
                at = at[estimates(signatures[at], np.frombuffer(signature, dtype=np.uint8)) >= floor]
                for other in np.unique(parts[at]).tolist():
                    if joined.join(part, other):
                        yield max(part, other), min(part, other)

    return link


def _exact_in(percent: int) -> Callable[..., Iterator[tuple[int, int]]]:
    """Pairs of nodes whose full sets are similar enough, one for each two components that they connect."""
    floor = least_estimate(percent / 100)

    def link(asking: pd.DataFrame, asked: pd.DataFrame) -> Iterator[tuple[int, int]]:
        signatures = np.frombuffer(b"".join(asked["signature"]), dtype=np.uint8).reshape(len(asked), -1)
        nodes, parts, sizes = (asked[c].to_numpy() for c in ("node", "component", "n_shingles"))
        values = np.concatenate(asked["values"].to_list())
        ends = np.cumsum(sizes)
        joined = _Joined()
        for node, part, size, signature, own in zip(*(asking[c] for c in ("node", "component", "n_shingles", "signature", "values"))):
            at = np.flatnonzero((parts != part) & (np.minimum(sizes, size) * 100 >= np.maximum(sizes, size) * percent))
            if len(at):
                at = at[estimates(signatures[at], np.frombuffer(signature, dtype=np.uint8)) >= floor]
            for i in at.tolist():
                if joined.root(part) == joined.root(int(parts[i])):
                    continue
                other = values[ends[i] - sizes[i]:ends[i]]
                place = np.minimum(np.searchsorted(own, other), size - 1)
                shared = int((own[place] == other).sum())
                if 100 * shared >= percent * (size + int(sizes[i]) - shared):
                    joined.join(part, int(parts[i]))
                    yield max(node, int(nodes[i])), min(node, int(nodes[i]))

    return link


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` (size of its set), ``component_id`` and ``kept``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text of fewer
    than ``length`` words, but not none, has its whole sequence as the one shingle.
    Documents are linked when 100 times their common shingles reach ``percent`` times
    the joint ones; a component has the smallest id reached and that document is kept.
    Null and empty texts have no set and are linked with nothing.  Rows that share an id
    count as one document; rows with a null id take no part (null component, kept).  An
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    described = written(_described(docs, text, doc_id, length), "sets")
    usable = described.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = written(usable.groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes")
    nodes = written(usable.join(classes.select("set_key", F.col("node").alias("doc_id")), ["set_key", "doc_id"])
                          .select(F.col("doc_id").alias("node"), "n_shingles", "bands", "signature")
                          .dropDuplicates(["node", "signature"]), "nodes")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("node"), F.col(text).cast("binary").alias("_text")).filter(
        F.col("_text").isNotNull())

    keyed = nodes.select("node", F.explode("bands").alias("key"))
    ends = keyed.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("_last"), F.count("*").alias("members"))
    # Written, so that the join deals out both sides anew and a hot bucket can be split.
    ends = written(ends.filter("centre < _last").drop("_last"), "ends")
    shared = written(keyed.join(ends, "key"), "buckets")

    links = written(_confirmed(shared.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(),
                               nodes, texts, length, percent), "links")
    labels = written(components(links), "labels")
    # The centre has met all others; buckets of three and more may hold further links.
    larger = shared.filter("members > 2 and node <> centre").select(F.col("key").alias("group"), "node")
    rest = _open(larger, nodes, labels)
    # Strays meet the smallest of their group; some of them have the same neighbours.
    strays = written(_stray_pairs(rest), "strays")
    more = written(_confirmed(strays, nodes, texts, length, percent), "more")
    if not more.isEmpty():
        links = written(links.unionByName(more), "links")
        labels = written(components(links), "labels")
        rest = _open(larger, nodes, labels)
    # Components with a likely pair in one bucket form a group, and full sets of its members decide.
    signed = nodes.select("node", "n_shingles", "signature", F.lit(None).cast("array<bigint>").alias("values"))
    likely = _between(rest.withColumn("_one", F.lit(1)).join(signed, "node"), "_one", BUCKET_BLOCK, _likely_in(percent))
    groups = written(components(written(likely, "likely")), "groups")
    judged = (rest.select("node", "component").distinct()
                  .join(groups.select(F.col("node").alias("component"), F.col("component").alias("group")), "component"))
    full = _full_sets(texts.join(judged.select("node"), "node"), length)
    judged = written(judged.join(nodes.select("node", "n_shingles", "signature"), "node").join(full, ["node", "n_shingles"]), "judged")
    last = _between(judged, "n_shingles", SET_BLOCK, _exact_in(percent))

    # Ids that share a set, and sets that share an id, belong together.
    same = usable.join(classes.select("set_key", "node"), "set_key").filter("doc_id <> node").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b"))
    labels = components(links.union(last).union(same))
    out = described.select("doc_id", "n_shingles").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _open(members: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``group``, ``node``, ``component``: what may still be linked, one group for every component that strays share buckets with.

    In a bucket whose members lie in several components, the others are strays of the one
    with most documents anywhere.  Buckets are reduced to their components first, so a document is here
    once for each such component and not once for every bucket; a component is in no group
    of a smaller one, so a large one does not come again with every straggler that it shares a bucket with.
    """
    sizes = labels.groupBy("component").agg(F.count("*").alias("_size"))
    sized = labels.join(written(sizes, "sizes"), "component")
    parts = members.join(sized, "node", "left").select("group", F.coalesce("component", "node").alias("component"),
                                                       F.coalesce("_size", F.lit(1)).alias("_size")).distinct()
    parts = written(parts, "parts")
    mains = parts.groupBy("group").agg(F.max_by("component", F.struct("_size", "component")).alias("_main"),
                                       F.count("*").alias("_parts")).filter("_parts > 1")
    met = parts.join(written(mains.drop("_parts"), "mains"), "group").select(F.col("_main").alias("group"), "component").distinct()
    placed = nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return written(placed.join(written(met, "met"), "component").select("group", "node", "component"), "rest")


def _stray_pairs(rest: DataFrame) -> DataFrame:
    """Members that are strays of their group (``a``), each with the smallest of them (``b``)."""
    strays = written(rest.filter(F.col("component") != F.col("group")).select("group", "node"), "apart")
    centres = strays.groupBy("group").agg(F.min("node").alias("b"))
    return strays.join(written(centres, "centres"), "group").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def _full_sets(texts: DataFrame, length: int) -> DataFrame:
    """``node``, ``n_shingles`` and the sorted hashes of its full set."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingles(words, length, short_as_one=True))
                    for words in hashed_texts([t.lower() for t in batch.column(1).to_pylist()])]
            # As signed numbers in signed order.
            signed = [np.sort(s.view(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(signed, pa.list_(pa.int64()))], names=["node", "n_shingles", "values"])

    return texts.select("node", "_text").mapInArrow(read, "node long, n_shingles long, values array<long>")


def drop_near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; rows with a null id stay."""
    judged = near_duplicates(docs, length, percent)
    gone = judged.filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
