"""Text to vectors with a pluggable encoder, loaded once per Python worker."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]

# Vector length and batch size of the text encoder.
EMBEDDING_DIM = 384
ENCODE_BATCH = 64


def hashing_encoder(dim: int = EMBEDDING_DIM, seed: int = 42) -> Callable[[], Encoder]:
    """Default encoder: signed feature hashing of lower-cased tokens, scaled to unit length."""
    def load() -> Encoder:
        def encode(texts: list[str]) -> np.ndarray:
            tokens = [t.lower().split() for t in texts]
            flat = [t for text in tokens for t in text]
            # Every distinct token of a batch is hashed once.
            distinct = {t: i for i, t in enumerate(dict.fromkeys(flat))}
            codes = np.fromiter((zlib.crc32(t.encode(), seed) for t in distinct), dtype=np.int64, count=len(distinct))
            codes = codes[np.fromiter(map(distinct.__getitem__, flat), dtype=np.int64, count=len(flat))]
            rows = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
            out = np.bincount(rows * dim + codes % dim, np.where((codes >> 16) & 1, 1.0, -1.0), len(texts) * dim)
            out = out.reshape(len(texts), dim).astype(np.float32)
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms > 0, norms, 1.0)
        return encode
    return load


def embed_column(df: DataFrame, text: str, out: str = "embedding", encoder: Callable[[], Encoder] | None = None,
                 batch_size: int = ENCODE_BATCH) -> DataFrame:
    """Add an ``array<float>`` column; a null text is encoded as the empty string."""
    load = encoder or hashing_encoder()

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            filled = texts.fillna("").tolist()
            parts = [model(filled[i:i + batch_size]) for i in range(0, len(filled), batch_size)]
            yield pd.Series([row for part in parts for row in np.asarray(part, dtype=np.float32)], dtype=object)

    return df.withColumn(out, encode(F.col(text)))
