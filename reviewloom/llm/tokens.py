"""Token counts of a byte-level pair vocabulary by rank-synchronous merging.

The pre-tokens of a batch lie in one ragged array of symbols.  In each round every
sequence applies its lowest-ranked pair, at all its places at once; sequences that
have no pair left are done.  Counting surviving symbols gives the tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.text import in_small_batches

# Fixed value: how this vocabulary splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_WORDS = 300_000   # pre-tokens whose count a worker remembers
BATCH_BYTES = 4 << 20   # bytes of new pre-tokens merged together
NO_RANK = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next unused one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairVocabulary:
    """Merge ranks of a vocabulary file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, merges = content["model"]["vocab"], content["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        codes = np.array([(ids[a] << 20) | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks = codes[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)  # by rank
        self.first = np.array([ids[s] for s in byte_symbols()], dtype=np.int64)
        specials = [t["content"] for t in content["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.split = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left << 20) | right
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, self.ranks[at], NO_RANK)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of every word (not empty)."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        left = lengths.copy()
        while len(symbols) > 1:
            inside = owner[1:] == owner[:-1]
            ranks = np.full(len(symbols), NO_RANK, dtype=np.int32)  # of the pair that begins at each symbol
            ranks[:-1][inside] = self.rank(symbols[:-1][inside], symbols[1:][inside])
            starts = np.flatnonzero(np.r_[True, ~inside])
            lowest = np.minimum.reduceat(ranks, starts)
            per_symbol = np.repeat(lowest, np.diff(np.r_[starts, len(symbols)]))
            active = per_symbol != NO_RANK
            hit = active & (ranks == per_symbol)
            # In a run of one symbol the pairs overlap; every second one is merged, from the left.
            at = np.flatnonzero(hit)
            begins = np.r_[True, np.diff(at) > 1]
            run_start = np.maximum.accumulate(np.where(begins, at, 0))
            at = at[(at - run_start) % 2 == 0]
            if not len(at):
                break
            symbols[at] = self.merged[ranks[at]]
            stays = active
            stays[at + 1] = False
            np.subtract.at(left, owner[at], 1)
            symbols, owner = symbols[stays], owner[stays]
        return left

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known.clear()
        batch, size = [], 0
        for word in words:
            batch.append(word)
            size += len(word)
            if size >= BATCH_BYTES:
                self._learn(batch)
                batch, size = [], 0
        if batch:
            self._learn(batch)

    def _learn(self, batch: list[str]) -> None:
        self.known.update(zip(batch, self.count([w.encode() for w in batch]).tolist()))

    def count_texts(self, texts: list[str | None]) -> list[int]:
        split, counts, pieces = self.split.findall, [0] * len(texts), []
        for i, text in enumerate(texts):
            if not text:
                pieces.append([])
                continue
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                counts[i] = len(parts) - 1
                pieces.append([w for part in parts for w in split(part)])
            else:
                pieces.append(split(text))
        wanted = set().union(*pieces)
        if wanted - self.known.keys():
            if len(self.known) + len(wanted) > KNOWN_WORDS:
                self.known.clear()
            self.learn(wanted - self.known.keys())
        look = self.known.__getitem__
        for i, words in enumerate(pieces):
            counts[i] += sum(map(look, words))
        return counts


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PairVocabulary:
    return PairVocabulary(path)


def count_tokens(docs: DataFrame, vocabulary_path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Special strings inside a text count as one token each.  Null and empty texts have 0
    bytes and 0 tokens.  Rows stay where they are: there is no shuffle.  The vocabulary
    file is read on each worker from ``vocabulary_path``; columns of those names are replaced.
    """
    in_small_batches(docs.sparkSession)
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in docs.columns if c not in (text, *made)]
    source = docs.select(*kept, F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), F.col(text).alias("_text"))
    schema = T.StructType([*[source.schema[c] for c in (*kept, "n_bytes")],
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        for batch in batches:
            numbers = words.count_texts(batch.column(batch.num_columns - 1).to_pylist())
            n = pa.array(numbers, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], n, pa.array([x > limit for x in numbers], pa.bool_())], names=[*kept, "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(counted, schema)
