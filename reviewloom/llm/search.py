"""Ranked lexical search by range maxima over posting lists.

Texts are read once and leave, per document, the terms that some query asks for with
their counts.  Tasks gather those into blocks of bounded postings.  In a block every
posting list has a sparse table, so the largest impact of a term in any interval of
documents is two lookups away; the weighted sum of these answers bounds the score of
every document of the interval.  A query starts with the whole block, takes the
intervals of highest bound first, scores the document of largest impact in each and
goes on with what lies left and right of it, until no bound reaches the ``k``-th score.
That score is carried on to the task's next block.

Scores are integers, so cutting into blocks cannot change a result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.text import in_small_batches, normal_words
from reviewloom.session import written

QUERY_TERMS = 500_000       # terms of the queries of one pass over the index, about 60 bytes each in every task
BLOCK_POSTINGS = 1_500_000  # postings of a block, whose sparse tables have at most 21 rows of 4 bytes each
STEP_CELLS = 1 << 18        # intervals by terms that are expanded at once
MANY = 10 ** 9              # scale of an impact
NO_DOC = 2 ** 63 - 1          # stands for a null id, which ranks last

# Bytes of normalised words: lower-case letters and digits stay, other ASCII parts words, all else stays.
_NORMAL = bytes(b if b >= 128 or chr(b).islower() or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isupper() else 32
                for b in range(256))


class Postings:
    """Posting lists of one block: documents by number, impacts, and range maxima of every list."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_docs: int) -> None:
        order = np.lexsort((docs, terms))
        self.n_docs = n_docs
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(order)).astype(np.int64)
        self.docs, self.impacts = docs[order].astype(np.int64), impacts[order].astype(np.int32)
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64), np.diff(self.starts)) * n_docs + self.docs
        # Row l holds where the maximum of 2^l postings from a place on lies; an interval never leaves its list.
        longest = int(np.diff(self.starts).max(initial=1))
        row = np.arange(len(order), dtype=np.int32)
        self.rows = [row]
        for level in range(1, longest.bit_length()):
            half, last = 1 << (level - 1), self.rows[-1]
            ahead = np.concatenate([last[half:], np.full(min(half, len(last)), len(order) - 1, dtype=np.int32)])
            self.rows.append(np.where(self.impacts[ahead] > self.impacts[last], ahead, last))
        self.table = np.stack(self.rows)

    def place(self, lists: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """First posting of each list (columns) at or after each document (rows)."""
        return np.searchsorted(self.keys, lists[None, :] * self.n_docs + docs[:, None])

    def highest(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and impact of the largest posting in ``first`` up to, not with, ``last``; impact 0 where there is none."""
        size = last - first
        some = size > 0
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        a = self.table[level, np.where(some, first, 0)]
        b = self.table[level, np.where(some, last - (1 << level), 0)]
        at = np.where(self.impacts[b] > self.impacts[a], b, a)
        return at, np.where(some, self.impacts[at], 0)


@dataclass
class Best:
    """The ``k`` highest scores of a query so far, with document ids; equal scores by smaller id."""

    k: int
    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls, k: int) -> Best:
        return cls(k, np.empty(0, np.int64), np.empty(0, np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]

    @property
    def floor(self) -> int:
        """Scores below this cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1


def search_block(block: Postings, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Let the block's documents into ``best``; ``weights`` of the query's distinct ``terms``.  Returns how many were scored."""
    at = np.searchsorted(block.terms, terms)
    at[at == len(block.terms)] = 0
    here = (block.terms[at] == terms) & (weights > 0)
    lists, weights = at[here].astype(np.int64), weights[here]
    if not len(lists):
        return 0

    def judged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval of documents and the document of its largest weighted impact."""
        where, most = block.highest(block.place(lists, low), block.place(lists, high))
        shares = most * weights
        top = shares.argmax(axis=1)
        return shares.sum(axis=1), block.docs[where[np.arange(len(low)), top]]

    low, high = np.array([0], dtype=np.int64), np.array([block.n_docs], dtype=np.int64)
    bound, centre = judged(low, high)
    step, scored = max(1, STEP_CELLS // len(lists)), 0
    while len(low):
        open_ = bound >= best.floor
        low, high, bound, centre = low[open_], high[open_], bound[open_], centre[open_]
        if not len(low):
            break
        # The intervals of highest bound; at first few, so that the floor rises before many are opened.
        take = min(len(low), step, max(2 * best.k, scored))
        chosen = np.argpartition(-bound, take - 1)[:take] if take < len(low) else np.arange(len(low))
        centres = centre[chosen]
        found = block.place(lists, centres)
        inside = np.minimum(found, len(block.keys) - 1)
        own = block.keys[inside] == lists[None, :] * block.n_docs + centres[:, None]
        scores = (np.where(own, block.impacts[inside], 0) * weights).sum(axis=1)
        scored += take
        good = scores >= best.floor
        best.add(scores[good], ids[centres[good]])
        new_low, new_high = np.concatenate([low[chosen], centres + 1]), np.concatenate([centres, high[chosen]])
        some = new_low < new_high
        new_low, new_high = new_low[some], new_high[some]
        new_bound, new_centre = judged(new_low, new_high) if len(new_low) else (bound[:0], centre[:0])
        kept = np.ones(len(low), dtype=bool)
        kept[chosen] = False
        low, high = np.concatenate([low[kept], new_low]), np.concatenate([high[kept], new_high])
        bound, centre = np.concatenate([bound[kept], new_bound]), np.concatenate([centre[kept], new_centre])
    return scored


def impacts_of(counts: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """How much each count of a term adds for a weight of 1, in documents of ``length`` terms."""
    if int(length.max(initial=0)) * n_docs < 2 ** 58:
        m = 75 + (25 * length * n_docs) // n_terms
    else:
        m = np.array([75 + 25 * int(x) * n_docs // n_terms for x in length], dtype=np.int64)
    return (MANY * counts) // (1000 * counts + 12 * m)


def weight_of(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _asked(queries: DataFrame, item: str, text: str) -> DataFrame:
    """``item`` and ``words`` of every query with words; rows that repeat item and text count once."""
    rows = queries.select(F.col(item).alias("item"), F.col(text).alias("_text")).distinct()
    return rows.select("item", normal_words(F.col("_text")).alias("words")).filter(F.size("words") > 0)


def search(docs: DataFrame, queries: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of each query: item_id, rank (from 1), doc_id and score.

    Terms are normalised words of whole texts, A-Z lower-cased.  With N documents that
    have a term, L terms in all, df documents with a term and its count tf in a document of n terms,
    m = 75 + (25 n N) div L, a term of weight floor(1000 ln((2 N + 2) / (2 df + 1))) adds
    weight * ((10^9 tf) div (1000 tf + 12 m)) as often as the query has it.  Only scores above 0
    count; equal scores by smaller doc_id, null ids (held as 2^63 - 1) last.

    Null and empty texts have no terms.  Every row of ``docs`` is a document of its own, so
    repeated rows rank beside each other.  Query rows that repeat id and text count
    once; different texts under one id are one query of all their terms; a null id is
    an id like any other.  Without documents or queries with terms the result is empty.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    item_type = queries.select(F.col(item_id).alias("item_id")).schema["item_id"].dataType.simpleString()
    asked = written(_asked(queries, item_id, query_text), "queries")
    # Passes over the documents, each for queries of a bounded number of terms.
    total = asked.agg(F.sum(F.size("words"))).first()[0] or 0
    passes = max(1, math.ceil(total / QUERY_TERMS))
    out = None
    for turn in range(passes):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == turn)
        part = _searched(spark, docs, mine, k, doc_id, text, item_type)
        out = part if out is None else out.unionByName(part)
    return out


def _searched(spark: SparkSession, docs: DataFrame, asked: DataFrame, k: int, doc_id: str, text: str, item_type: str) -> DataFrame:
    """One pass: queries whose terms fit in every task."""
    schema = f"item_id {item_type}, rank int, doc_id long, score long"
    counts: dict[object, Counter[str]] = {}
    for r in asked.collect():  # about QUERY_TERMS terms
        counts.setdefault(r["item"], Counter()).update(r["words"])
    numbers = {term: i for i, term in enumerate(sorted({t for c in counts.values() for t in c}))}
    if not numbers:
        return spark.createDataFrame([], schema)
    known = {term.encode(): i for term, i in numbers.items()}

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, times = [], [], []
            for raw in batch.column(1):
                words = Counter((raw.as_py() or b"").translate(_NORMAL).split(b" "))
                words.pop(b"", None)
                lengths.append(sum(words.values()))
                mine = {known[w]: c for w, c in words.items() if w in known}
                terms.append(list(mine)), times.append(list(mine.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "times"])

    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("_text"))
    index = written(texts.mapInArrow(reduce, "doc_id long, n long, terms array<int>, times array<long>").filter("n > 0"), "index")
    size = index.agg(F.count("*"), F.sum("n")).first()
    n_docs, n_terms = size[0], size[1] or 1
    # At most one row per term of the queries.
    df = {r["term"]: r["df"] for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    items = list(counts)
    wanted = []
    for item in items:
        mine = sorted((numbers[t], c) for t, c in counts[item].items())
        wanted.append((np.array([t for t, _ in mine], dtype=np.int64),
                       np.array([c * weight_of(df.get(t, 0), n_docs) for t, c in mine], dtype=np.int64)))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best.none(k) for _ in wanted]
        for ids, block in _blocks(batches, n_docs, n_terms):
            for (terms, weights), mine in zip(wanted, best):
                search_block(block, ids, terms, weights, mine)
        rows = [np.full(len(b.ids), i, dtype=np.int32) for i, b in enumerate(best)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(np.concatenate([b.ids for b in best])),
                                          pa.array(np.concatenate([b.scores for b in best]))], names=["item", "doc_id", "score"])

    found = index.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "times").mapInArrow(ranked, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = spark.createDataFrame(list(enumerate(items)), f"item int, item_id {item_type}")
    return top.join(F.broadcast(named), "item").select("item_id", "rank", F.nullif("doc_id", F.lit(NO_DOC)).alias("doc_id"), "score")


def _blocks(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int) -> Iterator[tuple[np.ndarray, Postings]]:
    """Document ids and posting lists of so many documents at a time as have a bounded number of postings."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).fill_null(NO_DOC).to_numpy(zero_copy_only=False)
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        terms, times = batch.column(2).flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy()
        lengths = batch.column(1).to_numpy()
        held.append((ids, lengths, sizes, terms, impacts_of(times, np.repeat(lengths, sizes), n_docs, n_terms)))
        size += len(terms)
        if size >= BLOCK_POSTINGS:
            yield _block(held)
            held, size = [], 0
    if held:
        yield _block(held)


def _block(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, Postings]:
    ids, lengths, sizes, terms, impacts = (np.concatenate(column) for column in zip(*held))
    # Documents in the order of their length: those of an interval are alike in what a term can add.
    order = np.argsort(lengths, kind="stable")
    numbers = np.empty(len(ids), dtype=np.int64)
    numbers[order] = np.arange(len(ids))
    return ids[order], Postings(np.repeat(numbers, sizes), terms, impacts, len(ids))
