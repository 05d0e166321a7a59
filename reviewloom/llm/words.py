"""Word and shingle hashes of whole texts as numpy arrays.

A word is a run of bytes other than space and tab to carriage return, so words of
UTF-8 texts are found without decoding.  A word's 64-bit hash multiplies each byte
with a pseudo-random number for its place and adds them up, then mixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# Gaps of normalised words: every ASCII byte that is no digit and no letter.
NORMAL_GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
HASH_BYTES = 1 << 20  # bytes hashed at a time; bounds the working arrays of very long texts


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def series(n: int, seed: int) -> np.ndarray:
    """``n`` repeatable odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix64(steps) | np.uint64(1)


_places = series(1 << 12, 11)


def _place_factors(n: int) -> np.ndarray:
    global _places
    if n > len(_places):
        _places = series(2 * n, 11)
    return _places


def bounds(data: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of every word in a byte array; ``gaps`` tells which bytes part words."""
    inside = np.concatenate(([False], ~gaps[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), dtype=np.uint64)
    lengths = ends - starts
    # Words are taken in runs of bounded bytes; a longer word is a run of its own.
    before = np.concatenate(([0], np.cumsum(lengths)))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(before, before[first] + HASH_BYTES, side="right")) - 1)
        n = lengths[first:last]
        offsets = before[first:last] - before[first]
        place = np.arange(int(before[last] - before[first])) - np.repeat(offsets, n)
        at = place + np.repeat(starts[first:last], n)
        values = (data[at].astype(np.uint64) + np.uint64(1)) * _place_factors(int(n.max()))[place]
        out[first:last] = mix64(np.add.reduceat(values, offsets))
        first = last
    return out


def hashed_texts(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text; a null or empty text has none."""
    joined = np.frombuffer(b"\n".join(t or b"" for t in texts), dtype=np.uint8)
    starts, ends = bounds(joined)
    hashes = hash_words(joined, starts, ends)
    sizes = np.array([len(t or b"") + 1 for t in texts])
    cuts = np.searchsorted(starts, np.cumsum(sizes))
    first = 0
    for last in cuts:
        yield hashes[first:last]
        first = last


def shingles(words: np.ndarray, length: int, short_as_one: bool = False) -> np.ndarray:
    """Hash of every run of ``length`` words; with fewer words none, or the whole sequence as one."""
    n = len(words)
    if n < length:
        if not (short_as_one and n):
            return np.empty(0, dtype=np.uint64)
        length = n
    total = np.full(n - length + 1, length, dtype=np.uint64)
    for j, factor in enumerate(series(length, 23)):
        total += words[j:n - length + 1 + j] * factor
    return mix64(total)
