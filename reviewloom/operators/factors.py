"""Alternating least squares in turns over samples that lie in order of either side.

The samples are written twice, in order of users and of items, many to a row.  In a turn
the factors of one side are sent to the tasks in stripes of bounded size, every row adds up
the normal equations of its ids, and the sums of a row from all stripes meet and are
solved.  What a turn shuffles follows the ids, not the samples or blocks that they meet.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import discard, written

CHUNK = 1 << 14          # samples of a row
NEAR = 256               # ids beside each other that are dealt to one task
STRIPE_BYTES = 1 << 27   # factors of so many ids beside each other are sent to the tasks at once
SUMS = 1 << 20           # numbers of the normal equations of a row at most, and of the products that are held at a time
LAID_OUT = "key int, stripe int, ids binary, counts binary, others binary, labels binary"
FACTORS = "stripe int, ids binary, factors binary"


def _row(kinds: list[pa.DataType], names: str, *values: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in names.split(", ")])


def checked(samples: DataFrame, user: str, item: str, label: str) -> DataFrame:
    """``own``, ``other`` and ``label`` of the samples; ids and labels must be there, and labels finite."""
    def present(c: Column, name: str, kind: str, wrong: Column) -> Column:
        return F.when(wrong, F.raise_error(F.lit(f"{name} must be a number")).cast(kind)).otherwise(c.cast(kind))

    y = F.col(label).cast("float")
    ids = [present(F.col(c), c, "int", F.col(c).isNull()).alias(n) for c, n in ((user, "own"), (item, "other"))]
    return samples.select(*ids, present(y, label, "float", y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))).alias("label"))


def ids_per_stripe(rank: int) -> int:
    return max(1, STRIPE_BYTES // (4 * rank))


def laid_out(samples: DataFrame, blocks: int, rank: int) -> DataFrame:
    """Samples in order of ``own``, some ``CHUNK`` to a row, written.

    All samples of an id are in one row, but those of an id that has ``CHUNK`` and more:
    they are in rows of their own.  Rows begin with the id that is their ``key``.
    """
    stripe, most, chunk = ids_per_stripe(rank), max(1, SUMS // _width(rank)), CHUNK
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]

    def packed(own: np.ndarray, other: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.diff(own, prepend=own[0] - np.int64(1)))
        counts = np.diff(starts, append=len(own)).astype("<i4")
        # Steps between neighbours take less room than the ids.
        steps = np.diff(other.astype("<i8"), prepend=0).astype("<i4")
        return _row(kinds, LAID_OUT, int(own[0]), int(own[0]) // stripe, own[starts].astype("<i4").tobytes(), counts.tobytes(),
                    steps.tobytes(), label.astype("<f4").tobytes())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = [np.zeros(0, "<i4"), np.zeros(0, "<i4"), np.zeros(0, "<f4")], None
        waiting, n = [], 0

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, large
            columns, at = held, 0
            while at < len(columns[0]) and (last or len(columns[0]) - at > chunk):
                own = columns[0][at:at + chunk + 1]
                first, end = int(own[0]), min(len(own), chunk)
                run = int(np.searchsorted(own[:end], first, side="right"))
                if first == large or run == chunk:
                    large, end = first, run
                else:
                    if len(own) > chunk:
                        end = int(np.searchsorted(own, own[chunk]))  # the id that goes on begins the next row
                    end = int(np.searchsorted(own[:end], (first // stripe + 1) * stripe))
                    changes = np.flatnonzero(np.diff(own[:end]))
                    end = int(changes[most - 1]) + 1 if len(changes) >= most else end
                yield packed(*[c[at:at + end] for c in columns])
                at += end
            held = [c[at:] for c in columns]

        for batch in batches:
            waiting.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)])
            n += batch.num_rows
            if n > 8 * chunk:
                held = [np.concatenate(c) for c in zip(held, *waiting)]
                waiting, n = [], 0
                yield from rows(False)
        held = [np.concatenate(c) for c in zip(held, *waiting)]
        yield from rows(True)

    ordered = samples.repartition(blocks, F.floor(F.col("own") / NEAR)).sortWithinPartitions("own", "other")
    return written(ordered.mapInArrow(pack, LAID_OUT), "laid-out", "zstd")


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Key, stripe, ids, their numbers of samples, other ids and labels of every row."""
    for batch in batches:
        for at in range(batch.num_rows):
            key, stripe, *parts = (c[at].as_py() for c in batch.columns)
            ids, counts, steps, label = (np.frombuffer(p, k) for p, k in zip(parts, ("<i4", "<i4", "<i4", "<f4")))
            yield key, stripe, ids, counts, np.cumsum(steps, dtype="<i8"), label


def turned(layout: DataFrame) -> DataFrame:
    """The samples of a layout with their two sides exchanged."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, ids, counts, other, label in _samples(batches):
            yield pa.RecordBatch.from_arrays([pa.array(other.astype("<i4")), pa.array(np.repeat(ids, counts)), pa.array(label)], names=["own", "other", "label"])

    return layout.mapInArrow(unpack, "own int, other int, label float")


def _width(rank: int) -> int:
    return rank * (rank + 1) // 2 + rank + 1


def drawn(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """A vector of length one for every id, in a direction drawn by seed and id."""
    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53

    place = ids.astype(np.uint64)[:, None] * np.uint64(2 * rank) + np.arange(2 * rank, dtype=np.uint64) + np.uint64(1)
    parts = mixed(place * np.uint64(0x9E3779B97F4A7C15) + mixed_seed(seed))
    normal = np.sqrt(-2 * np.log1p(-parts[:, :rank])) * np.cos(2 * np.pi * parts[:, rank:])
    return normal / np.maximum(np.linalg.norm(normal, axis=1, keepdims=True), 1e-12)


def mixed_seed(seed: int) -> np.uint64:
    return np.uint64(seed * 0xD1342543DE82EF95 % 2 ** 64)


def _equations(ids: np.ndarray, counts: np.ndarray, vectors: np.ndarray, label: np.ndarray, which: np.ndarray) -> np.ndarray:
    """For every id the upper triangle of its sum of products, its sum of labels times vectors and its number of samples."""
    rank = vectors.shape[1]
    left, right = np.triu_indices(rank)
    out = np.zeros((len(ids), _width(rank)))
    piece = max(256, SUMS // out.shape[1])
    for at in range(0, len(which), piece):
        v, y, w = vectors[at:at + piece], label[at:at + piece, None], which[at:at + piece]
        starts = np.flatnonzero(np.diff(w, prepend=-1))
        out[w[starts]] += np.add.reduceat(np.hstack([v[:, left] * v[:, right], v * y, np.ones_like(y)]), starts)
    return out


def _table(solved: DataFrame, rank: int) -> tuple[int, np.ndarray]:
    """Smallest id of a stripe, and the factors from there on."""
    got = solved.select("ids", "factors").toArrow()  # at most STRIPE_BYTES and the ids
    ids = np.concatenate([np.frombuffer(x, "<i4") for x in got["ids"].to_pylist()])
    low = int(ids.min())
    table = np.zeros((int(ids.max()) - low + 1, rank), "<f4")
    table[ids - low] = np.concatenate([np.frombuffer(x, "<f4") for x in got["factors"].to_pylist()]).reshape(-1, rank)
    return low, table


def _solve(sums: DataFrame, rank: int, reg: float) -> DataFrame:
    """Factors from the sums of every row's ids, of all stripes."""
    kinds = [pa.int32(), pa.binary(), pa.binary()]

    def solve(table: pa.Table) -> pa.Table:
        ids = table["ids"][0].as_py()
        total = sum(np.frombuffer(s) for s in table["sums"].to_pylist()).reshape(len(ids) // 4, -1)
        left, right = np.triu_indices(rank)
        square = np.empty((len(total), rank, rank))
        square[:, left, right] = square[:, right, left] = total[:, :len(left)]
        square[:, np.arange(rank), np.arange(rank)] += reg * total[:, -1:]
        factors = np.linalg.solve(square, total[:, len(left):-1, None])[..., 0].astype("<f4")
        return pa.Table.from_batches([_row(kinds, FACTORS, table["stripe"][0].as_py(), ids, factors.tobytes())])

    return sums.groupBy("key").applyInArrow(solve, FACTORS)


def half_turn(layout: DataFrame, given: DataFrame | None, rank: int, reg: float, seed: int) -> DataFrame:
    """Factors of the layout's own side for those ``given`` of the other, or drawn ones; written."""
    context = layout.sparkSession.sparkContext
    schema = "key int, stripe int, ids binary, sums binary"
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    stripes = [None] if given is None else sorted(r["stripe"] for r in given.select("stripe").distinct().collect())
    parts = []
    for number in stripes:
        sent = context.broadcast(None if number is None else _table(given.filter(F.col("stripe") == number), rank))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for key, stripe, ids, counts, other, label in _samples(batches):
                which = np.repeat(np.arange(len(ids)), counts)
                if sent.value is None:
                    vectors = drawn(other, rank, seed)
                else:
                    low, table = sent.value
                    inside = (other >= low) & (other < low + len(table))
                    if not inside.all():
                        other, label, which = other[inside], label[inside], which[inside]
                    vectors = table[other - low].astype(float)
                made = _equations(ids, counts, vectors, label.astype(float), which)
                yield _row(kinds, schema, key, stripe, ids.tobytes(), made.tobytes())

        made = layout.mapInArrow(sums, schema)
        # One stripe is solved as it comes; sums of several wait for each other.
        parts.append(written(_solve(made, rank, reg), "factors") if len(stripes) == 1 else written(made, "sums"))
        sent.destroy()
    if len(parts) == 1:
        return parts[0]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    solved = written(_solve(whole, rank, reg), "factors")
    for part in parts:
        discard(part)
    return solved


def _by_id(solved: DataFrame, rank: int) -> DataFrame:
    """One row per id: ``id`` and ``features``."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, factors in zip(batch.column(1), batch.column(2)):
                own, values = np.frombuffer(ids.as_py(), "<i4"), np.frombuffer(factors.as_py(), "<f4")
                ends = np.arange(len(own) + 1, dtype="<i4") * rank
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["id", "features"])

    return solved.mapInArrow(unpack, "id int, features array<float>")


def alternate(samples: DataFrame, rank: int, iterations: int, reg: float, seed: int, blocks: int,
              user: str = "user_idx", item: str = "item_idx", label: str = "label") -> ALSModel:
    """Factors that take turns in minimising the squared error plus ``reg`` times samples times squared length of every id's vector."""
    if iterations < 1:
        raise ValueError("factors need one turn at least")
    by_user = laid_out(checked(samples, user, item, label), blocks, rank)
    if by_user.isEmpty():
        raise ValueError("no samples to fit factors on")
    by_item = laid_out(turned(by_user), blocks, rank)
    users = items = None
    for _ in range(iterations):
        before, items = items, half_turn(by_item, users, rank, reg, seed)
        _let_go(before, users)
        users = half_turn(by_user, items, rank, reg, seed)
    _let_go(by_user, by_item)
    return _model(samples.sparkSession, rank, _by_id(users, rank), _by_id(items, rank), user, item)


def _let_go(*tables: DataFrame | None) -> None:
    for table in tables:
        if table is not None:
            discard(table)


def _model(spark: SparkSession, rank: int, users: DataFrame, items: DataFrame, user: str, item: str) -> ALSModel:
    made = spark.sparkContext._jvm.org.apache.spark.ml.recommendation.ALSModel(f"als-{uuid.uuid4().hex}", rank, users._jdf, items._jdf)
    made.setUserCol(user).setItemCol(item).setColdStartStrategy("drop")
    return ALSModel(made).setUserCol(user).setItemCol(item).setColdStartStrategy("drop")
