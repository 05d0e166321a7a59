"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as an embedding of the word and the mean embedding of its character
n-grams.  The network reads windows of words in both directions, attention weighs the
states of a window, and a document scores as its highest window.  Windows overlap by
half and cover the whole text.  Fitting uses a bounded sample of labelled documents in
one task; scoring is a map over Arrow batches without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.text import in_small_batches
from reviewloom.llm.words import NORMAL_GAPS, bounds, hash_words, mix64

WINDOW, STEP = 32, 16        # words of a window, and from one window to the next
HIDDEN, WIDTH = 8, 12        # states of one direction, numbers of an embedding
WORD_SLOTS, CHAR_SLOTS = 1 << 13, 1 << 13
GRAMS = (3, 5, 7)            # bytes of a character n-gram; words are framed by boundary marks
CHUNK = 4_096                # windows run at a time
MOST_PER_CLASS = (1_500, 2_500)  # labelled documents to fit on: toxic, clean
LONGEST_FIT = 24_000         # characters of a document to fit on; all are scored whole
UPDATES, DOCS_PER_UPDATE = 700, 48
TOP_WINDOWS = 2              # windows of a document that an update follows
RATE = 0.01
PAD = 0                      # row of the word table that stands for no word


@dataclass
class Words:
    """Distinct words of some texts: slots of the word, and slots of its n-grams in one flat array."""

    word_slot: np.ndarray
    gram_slots: np.ndarray
    gram_starts: np.ndarray
    gram_counts: np.ndarray


def read_words(texts: list[bytes | None]) -> tuple[Words, list[np.ndarray]]:
    """The distinct normalised words, and each text as row numbers into them plus one (0 is no word)."""
    data = np.frombuffer(b"\n".join((t or b"").lower() for t in texts), dtype=np.uint8)
    starts, ends = bounds(data, NORMAL_GAPS)
    hashes = hash_words(data, starts, ends)
    distinct, first, row = np.unique(hashes, return_index=True, return_inverse=True)
    sizes = np.array([len(t or b"") + 1 for t in texts])
    cuts = np.searchsorted(starts, np.cumsum(sizes))
    rows = np.split(row.astype(np.int32) + 1, cuts[:-1]) if len(texts) else []
    return _words(data, starts[first], ends[first], distinct), rows


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> Words:
    # Words framed by marks, laid out one after another.
    lengths = ends - starts + 2
    offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    framed = np.full(int(lengths.sum()), ord("^"), dtype=np.uint64)
    inner = np.arange(int((ends - starts).sum()))
    before = np.concatenate(([0], np.cumsum(ends - starts)))[:-1]
    shift = np.repeat(offsets + 1 - before, ends - starts)
    framed[inner + shift] = data[inner + np.repeat(starts - before, ends - starts)]
    framed[offsets + lengths - 1] = ord("$")
    owner = np.repeat(np.arange(len(starts)), lengths)
    slots, owners = [], []
    for n in GRAMS:
        if len(framed) < n:
            continue
        value = np.zeros(len(framed) - n + 1, dtype=np.uint64)
        for j in range(n):
            value = value * np.uint64(257) + framed[j:len(framed) - n + 1 + j]
        inside = owner[:len(value)] == owner[n - 1:]
        slots.append((mix64(value[inside] + np.uint64(n)) % np.uint64(CHAR_SLOTS)).astype(np.int32))
        owners.append(owner[:len(value)][inside])
    flat, of = np.concatenate(slots) if slots else np.empty(0, np.int32), np.concatenate(owners) if owners else np.empty(0, int)
    order = np.argsort(of, kind="stable")
    counts = np.bincount(of, minlength=len(starts))
    return Words((hashes % np.uint64(WORD_SLOTS)).astype(np.int32), flat[order],
                 np.concatenate(([0], np.cumsum(counts)))[:-1].astype(int), counts)


def window_rows(rows: np.ndarray) -> np.ndarray:
    """All overlapping windows of a text, one in each row; a text without words has one empty window."""
    count = 1 + max(0, -(-(len(rows) - WINDOW) // STEP))
    padded = np.zeros((count - 1) * STEP + WINDOW, dtype=np.int32)
    padded[:len(rows)] = rows
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, d = HIDDEN, WIDTH

        def start(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": start(WORD_SLOTS, d, scale=0.1), "char": start(CHAR_SLOTS, d, scale=0.1),
            "in": start(d, 6 * h, scale=0.5), "in_bias": np.zeros(6 * h, np.float32),
            "forth": start(h, 3 * h, scale=0.3), "back": start(h, 3 * h, scale=0.3),
            "look": start(2 * h, scale=0.3), "out": start(2 * h, scale=0.5), "out_bias": np.zeros(1, np.float32),
        }

    @classmethod
    def of(cls, weights: dict[str, np.ndarray]) -> Network:
        net = cls.__new__(cls)
        net.p = weights
        return net

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Embedded words and their input to the gates of both directions; row 0 is no word."""
        embedded = self.p["word"][words.word_slot]
        if len(words.gram_slots):
            has = words.gram_counts > 0
            sums = np.add.reduceat(self.p["char"][words.gram_slots], words.gram_starts[has], axis=0)
            embedded[has] += sums / words.gram_counts[has, None].astype(np.float32)
        gates = np.zeros((len(embedded) + 1, 6 * HIDDEN), dtype=np.float32)
        gates[1:] = embedded @ self.p["in"] + self.p["in_bias"]
        return embedded, gates

    def _direction(self, gates: np.ndarray, rows: np.ndarray, weights: np.ndarray, steps: range, first: int, keep: list | None, states: np.ndarray) -> None:
        h = HIDDEN
        state = np.zeros((rows.shape[0], h), dtype=np.float32)
        for t in steps:
            x = gates[rows[:, t], first:first + 3 * h]
            u = state @ weights
            zr = _sigmoid(x[:, :2 * h] + u[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(x[:, 2 * h:] + r * u[:, 2 * h:])
            new = n + z * (state - n)
            if keep is not None:
                keep.append((t, state, z, r, n, u[:, 2 * h:]))
            states[t] = new
            state = new

    def run(self, gates: np.ndarray, rows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of every window."""
        h, n = HIDDEN, rows.shape[0]
        states = np.empty((WINDOW, n, 2 * h), dtype=np.float32)
        for name, first, steps in (("forth", 0, range(WINDOW)), ("back", 3 * h, range(WINDOW - 1, -1, -1))):
            half = states[:, :, :h] if name == "forth" else states[:, :, h:]
            if keep is not None:
                keep[name] = []
            self._direction(gates, rows, self.p[name], steps, first, None if keep is None else keep[name], half)
        looks = states @ self.p["look"]
        looks[rows.T == PAD] = -np.inf
        top = looks.max(axis=0)
        weight = np.exp(looks - np.where(np.isfinite(top), top, 0))
        weight /= np.maximum(weight.sum(axis=0), 1e-30)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        if keep is not None:
            keep |= {"states": states, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["out_bias"][0]

    def gradients(self, words: Words, rows: np.ndarray, toward: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the loss, whose derivative by each window's logit is ``toward``."""
        h = HIDDEN
        embedded, gates = self.inputs(words)
        keep: dict = {}
        self.run(gates, rows, keep)
        states, weight, pooled = keep["states"], keep["weight"], keep["pooled"]
        g = {"out": pooled.T @ toward, "out_bias": np.array([toward.sum()], np.float32)}
        d_pooled = toward[:, None] * self.p["out"]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_look = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["look"] = np.einsum("tn,tnh->h", d_look, states)
        d_states = weight[:, :, None] * d_pooled + d_look[:, :, None] * self.p["look"]
        d_gates = np.zeros_like(gates)
        for name, first, half in (("forth", 0, d_states[:, :, :h]), ("back", 3 * h, d_states[:, :, h:])):
            u = self.p[name]
            g[name] = np.zeros_like(u)
            later = np.zeros((rows.shape[0], h), dtype=np.float32)
            for t, state, z, r, n, inner in reversed(keep[name]):
                d = half[t] + later
                d_n = d * (1 - z) * (1 - n * n)
                d_z = d * (state - n) * z * (1 - z)
                d_r = d_n * inner * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_n * r], axis=1)
                g[name] += state.T @ d_u
                later = d * z + d_u @ u.T
                np.add.at(d_gates[:, first:first + 3 * h], rows[:, t], np.concatenate([d_z, d_r, d_n], axis=1))
        d_gates = d_gates[1:]
        g["in"], g["in_bias"] = embedded.T @ d_gates, d_gates.sum(axis=0)
        d_embedded = d_gates @ self.p["in"].T
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(g["word"], words.word_slot, d_embedded)
        shares = d_embedded / np.maximum(words.gram_counts, 1)[:, None].astype(np.float32)
        np.add.at(g["char"], words.gram_slots, np.repeat(shares, words.gram_counts, axis=0))
        return g

    def logits(self, gates: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.run(gates, rows[i:i + CHUNK]) for i in range(0, len(rows), CHUNK)])

    def scores(self, texts: list[bytes | None]) -> list[float]:
        """Probability of each text: that of its highest window."""
        words, rows = read_words(texts)
        _, gates = self.inputs(words)
        windows = [window_rows(r) for r in rows]
        starts = np.concatenate(([0], np.cumsum([len(w) for w in windows])))[:-1]
        highest = np.maximum.reduceat(self.logits(gates, np.concatenate(windows)), starts)
        return _sigmoid(highest.astype(np.float64)).tolist()


def _subset(words: Words, rows: np.ndarray) -> tuple[Words, np.ndarray]:
    """Only the words that ``rows`` uses."""
    used, new = np.unique(rows, return_inverse=True)
    new = new.reshape(rows.shape).astype(np.int32)
    if used[0] != PAD:
        new += 1
    used = used[used != PAD] - 1
    counts = words.gram_counts[used]
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1].astype(int)
    at = np.arange(int(counts.sum())) - np.repeat(starts, counts) + np.repeat(words.gram_starts[used], counts)
    return Words(words.word_slot[used], words.gram_slots[at], starts, counts), new


def fit(texts: list[bytes | None], toxic: list[int], seed: int = 7, updates: int | None = None) -> Network | float:
    """A network, or the share of toxic texts where one class is missing."""
    updates = updates or UPDATES
    labels = np.array(toxic, dtype=np.float32)
    if not len(labels) or labels.min() == labels.max():
        return float(labels.mean()) if len(labels) else 0.0
    net, rng = Network(seed), np.random.default_rng(seed)
    words, rows = read_words(texts)
    windows = [window_rows(r) for r in rows]
    by_class = [np.flatnonzero(labels == c) for c in (1, 0)]
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    half = DOCS_PER_UPDATE // 2
    for update in range(1, updates + 1):
        docs = np.concatenate([rng.choice(c, half) for c in by_class])
        small, at = _subset(words, np.concatenate([windows[i] for i in docs]))
        sizes = np.array([len(windows[i]) for i in docs])
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        logit = net.logits(net.inputs(small)[1], at)
        picked, toward = [], []
        for doc, start, size in zip(docs, starts, sizes):
            best = start + np.argsort(-logit[start:start + size], kind="stable")[:TOP_WINDOWS if labels[doc] == 0 else 1]
            picked.append(best)
            toward.append((_sigmoid(logit[best]) - labels[doc]) / len(best))
        chosen, chosen_rows = _subset(words, np.concatenate([windows[i] for i in docs])[np.concatenate(picked)])
        grads = net.gradients(chosen, chosen_rows, (np.concatenate(toward) / len(docs)).astype(np.float32))
        rate = RATE * min(1.0, 2 * (1 - update / (updates + 1)))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net.p[k] -= rate * (first[k] / (1 - 0.9 ** update)) / (np.sqrt(second[k] / (1 - 0.99 ** update)) + 1e-6)
    return net


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from fitting; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = MOST_PER_CLASS) -> Network | float:
    """Fit on labelled documents that are not held out: at most ``per_class`` toxic and clean ones, drawn by digest."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    drawn = None
    for value, most in zip((1, 0), per_class):
        part = usable.filter(F.col("toxic") == value).select("doc_id", "toxic").distinct().orderBy(
            F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most the documented number of ids on the driver, and as many texts of bounded length in one task.
    drawn = docs.sparkSession.createDataFrame(drawn.collect(), "doc_id long, toxic int")
    rows = (docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("binary").alias("_text"))
                .filter((F.length("text") <= LONGEST_FIT) & F.col("_id").isNotNull())
                .join(F.broadcast(drawn), F.col("_id") == F.col("doc_id")).select("_id", "_text", "toxic"))
    updates = UPDATES

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = sorted(row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3))))
        model = fit([text for _, text, _ in given], [toxic for *_, toxic in given], updates=updates)
        weights = model if isinstance(model, float) else model.p
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(weights)], pa.binary())], names=["weights"])

    found = rows.repartition(1).mapInArrow(train, "weights binary").first()
    weights = 0.0 if found is None else pickle.loads(found["weights"])
    return weights if isinstance(weights, float) else Network.of(weights)


def score_toxicity(docs: DataFrame, model: Network | float, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored, by all overlapping windows; only the text enters a score.
    Null and empty texts score as a window without words.  Without labelled rows of both
    classes the model is the share of toxic ones, the same score for all.  Columns of
    those two names are replaced; an empty table gives an empty result.
    """
    in_small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    source = docs.select(*kept, F.col(text).cast("binary").alias("_toxicity_text"))
    schema = T.StructType([*[source.schema[c] for c in kept], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            values = ([model] * len(texts) if isinstance(model, float) else model.scores(texts)) if texts else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(values, pa.float64()),
                                              pa.array([int(v >= threshold) for v in values], pa.int32())], names=[*kept, "score", "predicted"])

    return source.mapInArrow(scored, schema)
