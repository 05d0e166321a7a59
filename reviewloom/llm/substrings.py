"""Repeated word sequences: suffix automata of reference shards, and matching statistics of the text against them.

Comparing every document with the automaton of every other shard would read the
corpus once per shard.  Instead text meets only the shard that can match it.  Of each
window of words the run of ``GRAM`` words with the least hash is its anchor; equal
windows have equal anchors.  The stretch of consecutive windows with one anchor is
sent to the shard of that anchor, if the anchor occurs again at all.  A shard holds
the automaton of the stretches seen so far, earliest first; a later stretch is
streamed through it, and every place whose matching statistic reaches the window is
the end of a repeated window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.text import fresh, in_small_batches, others
from reviewloom.llm.words import hashed_texts, mix64, series, shingles
from reviewloom.session import written

WINDOW = 20
GRAM = 6               # words of an anchor
SHARD = 20_000         # stretches, of at most 2 * WINDOW - GRAM words each, in one shard
MANY_STRETCHES = 2_000  # different stretches of one anchor; beyond, its windows are compared one by one
NO_ID = -(2 ** 63)


class SuffixAutomaton:
    """All substrings of the sequences added so far, as states with transitions."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0
        self.ends = 0

    def add(self, words: list[int]) -> None:
        for word in words:
            self._extend(word)
        self.ends -= 1
        self._extend(self.ends)  # a symbol of its own keeps matches inside one sequence

    def _extend(self, word: int) -> None:
        following, link, length = self.next, self.link, self.length
        new = len(length)
        length.append(length[self.last] + 1)
        following.append({})
        link.append(0)
        at = self.last
        while at >= 0 and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at >= 0:
            old = following[at][word]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                copy = len(length)
                length.append(length[at] + 1)
                following.append(dict(following[old]))
                link.append(link[old])
                while at >= 0 and following[at].get(word) == old:
                    following[at][word] = copy
                    at = link[at]
                link[old] = link[new] = copy
        self.last = new

    def matches(self, words: list[int]) -> list[int]:
        """Length of the longest suffix of each prefix of ``words`` that occurs in what was added."""
        following, link, lengths = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for word in words:
            while state and word not in following[state]:
                state = link[state]
                matched = lengths[state]
            target = following[state].get(word)
            if target is not None:
                state, matched = target, matched + 1
            out.append(matched)
        return out


def _anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Anchor hash, first window, number of windows and digest of each stretch of a document."""
    if len(words) < window:
        return None
    gram = min(GRAM, window)
    grams = shingles(words, gram)
    span = window - gram + 1
    # Place of the leftmost least gram in every window, by doubling.
    place, width = np.arange(len(grams)), 1
    while width < span:
        step = min(width, span - width)
        left, right = place[:-step], place[step:]
        place = np.where(grams[right] < grams[left], right, left)
        width += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.concatenate((first, [len(place)])))
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(np.full(len(words), base, dtype=np.uint64))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * powers, dtype=np.uint64)))
    inverse = np.multiply.accumulate(np.full(len(words), np.uint64(pow(int(base), -1, 2 ** 64)), dtype=np.uint64))
    digest = mix64((sums[first + count + window - 1] - sums[first]) * inverse[first] + count.astype(np.uint64))
    return grams[place[first]], first, count, digest


def _stretches(docs: DataFrame, window: int) -> DataFrame:
    schema = "key long, doc long, start int, windows int, digest long"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for doc, words in zip(batch.column(0).to_pylist(), hashed_texts(batch.column(1).to_pylist())):
                found = _anchors(words, window)
                if found is not None:
                    parts.append((np.full(len(found[0]), doc), *found))
            if parts:
                doc, key, start, windows, digest = (np.concatenate([p[i] for p in parts]) for i in range(5))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(doc), pa.array(start.astype(np.int32)),
                     pa.array(windows.astype(np.int32)), pa.array(digest.view(np.int64))],
                    names=["key", "doc", "start", "windows", "digest"])

    return docs.mapInArrow(find, schema)


def _read_out(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Words of stretches; those of an anchor with many stretches as single windows, keyed by their own hash."""
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "windows", "many")).alias("at"))
    schema = "key long, doc long, start int, words array<long>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, starts, words_out = [], [], [], []
            texts, lists = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for doc, words, places in zip(batch.column(0).to_pylist(), hashed_texts(texts), lists):
                signed = words.view(np.int64)
                single = None
                for at in places:
                    start, n = at["start"], at["windows"]
                    if start + n + window - 1 > len(words):
                        continue  # another row of the same id is shorter
                    if at["many"]:
                        if single is None:
                            single = shingles(words, window).view(np.int64)
                        keys += single[start:start + n].tolist()
                        ids += [doc] * n
                        starts += range(start, start + n)
                        words_out += [None] * n
                    else:
                        keys.append(at["key"]), ids.append(doc), starts.append(start)
                        words_out.append(signed[start:start + n + window - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(words_out, pa.list_(pa.int64()))],
                names=["key", "doc", "start", "words"])

    return docs.join(per_doc, "doc").select("doc", "text", "at").mapInArrow(read, schema)


def _matched(stretches: DataFrame, window: int) -> DataFrame:
    """Runs of windows (doc, first, last) that match an earlier stretch of their anchor."""
    shards = max(1, stretches.count() // SHARD)

    def match(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["key", "doc", "start"], kind="stable")
        found: list[tuple[int, int, int]] = []
        keys, ids, starts = (shard[c].tolist() for c in ("key", "doc", "start"))
        words = shard["words"].tolist()
        for i, key in enumerate(keys):
            sequence = words[i].tolist()
            if not i or keys[i - 1] != key:
                automaton = SuffixAutomaton()
            else:
                ends = [e for e, n in enumerate(automaton.matches(sequence)) if n >= window]
                run = None
                for e in ends:
                    start = starts[i] + e - window + 1
                    if run is not None and start == run + 1:
                        found[-1] = (ids[i], found[-1][1], start)
                    else:
                        found.append((ids[i], start, start))
                    run = start
            if i + 1 < len(keys) and keys[i + 1] == key:
                automaton.add(sequence)
        return pd.DataFrame(found, columns=["doc", "first", "last"]).astype({"doc": "int64", "first": "int32", "last": "int32"})

    spread = stretches.withColumn("_shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return spread.groupBy("_shard").applyInPandas(lambda shard: match(shard), "doc long, first int, last int")


def _id(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID))


def repeated_windows(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Runs of windows whose words also start earlier: ``doc`` (id), ``first`` and ``last`` start, from 0."""
    in_small_batches(docs.sparkSession)
    plain = docs.select(_id(doc_id).alias("doc"), F.col(text).cast("binary").alias("text")).filter(F.col("text").isNotNull())
    stretches = _stretches(plain, window)
    again = stretches.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select("key")
    # Written, so that the join deals out both sides anew and a hot anchor can be split.
    live = written(stretches.join(written(again, "anchors"), "key", "left_semi"), "stretches")
    kinds = written(live.groupBy("key", "digest").agg(F.min(F.struct("doc", "start")).alias("at"), F.max("windows").alias("windows"))
                        .select("key", "digest", F.col("at.doc").alias("doc"), F.col("at.start").alias("start"), "windows"), "kinds")
    # A stretch that occurred before as a whole needs no automaton.
    earliest = kinds.select("key", "digest", F.col("doc").alias("_doc"), F.col("start").alias("_start"))
    copied = (live.join(earliest, ["key", "digest"]).filter((F.col("doc") != F.col("_doc")) | (F.col("start") != F.col("_start")))
                  .select("doc", F.col("start").alias("first"), (F.col("start") + F.col("windows") - 1).alias("last")))
    several = written(kinds.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1"), "anchors")
    wanted = kinds.join(several, "key").select("key", "doc", "start", "windows", (F.col("_n") > MANY_STRETCHES).alias("many"))
    read = written(_read_out(plain, wanted, window), "words")
    matched = _matched(read.filter("words is not null"), window)
    single = read.filter("words is null")
    firsts = written(single.groupBy("key").agg(F.min(F.struct("doc", "start")).alias("at")), "firsts")
    later = (single.join(firsts, "key").filter((F.col("doc") != F.col("at.doc")) | (F.col("start") != F.col("at.start")))
                   .select("doc", F.col("start").alias("first"), F.col("start").alias("last")))
    return copied.unionByName(matched).unionByName(later)


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the kept words, joined by one space, as text, and ``n_words`` and ``n_removed``.

    A word goes when a window of ``window`` consecutive words of its document covers it
    whose word sequence also starts earlier: in a document with a smaller id, or earlier
    in the same one.  Windows are judged on the input.  A null text stays null and has no
    words.  A null id counts as smaller than all others; rows that share an id count as
    one document, so that a place repeated in one of them goes in all.  Texts of fewer
    words than a window lose nothing.  Columns of those two names are replaced.
    """
    in_small_batches(docs.sparkSession)
    flags = written(repeated_windows(docs, window, text, doc_id), "flags")
    # The flags of one document meet, at most one for each of its words.
    per_doc = flags.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("_flags"))
    kept = others(docs, text, "n_words", "n_removed")
    key, flagged_at = fresh(docs, "_doc"), fresh(docs, "_flags")
    joined = docs.withColumn(key, _id(doc_id)).join(per_doc.select(F.col("doc").alias(key), F.col("_flags").alias(flagged_at)), key, "left")
    source = joined.select(*kept, F.col(text).cast("binary").alias(fresh(docs, "_text")), flagged_at)
    schema = T.StructType([*[source.schema[c] for c in kept], T.StructField(text, T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = [*kept, text, "n_words", "n_removed"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes, removed = [], [], []
            for raw, flagged in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()):
                words = (raw or b"").split()  # splits bytes at space and tab to carriage return
                sizes.append(len(words))
                if flagged:
                    change = np.zeros(len(words) + window + 1, dtype=np.int64)
                    first = np.minimum([f["first"] for f in flagged], len(words))
                    last = np.minimum([f["last"] + window for f in flagged], len(words))
                    np.add.at(change, first, 1)
                    np.add.at(change, last, -1)
                    gone = np.cumsum(change)[:len(words)] > 0
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                removed.append(sizes[-1] - len(words))
                out.append(None if raw is None else b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(out, pa.string()), pa.array(sizes, pa.int64()),
                                              pa.array(removed, pa.int64())], names=names)

    return source.mapInArrow(cut, schema)
