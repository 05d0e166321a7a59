"""Keeping one row per key.

All three forms are grouped aggregates, not windows: each task folds its copies
before the shuffle, so a key or a copied text holding a large share of the rows
sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column], latest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    body = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    chosen = F.max_by(body, rank) if latest else F.min_by(body, rank)
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """First row per key in a stable order (all other columns when none is given)."""
    chosen = order or [c for c in df.columns if c not in keys]
    cols = [F.col(c) if isinstance(c, str) else c for c in chosen]
    return _pick(df, keys, cols, latest=False)


def distinct_reviews(df: DataFrame) -> DataFrame:
    """Exact duplicates by user and raw text reduced to one review.

    Texts are grouped by their digest, so that neither keys nor ranks hold whole texts.
    """
    rest = sorted(c for c in df.columns if c not in ("user_id", "text"))
    first = [c for c in ("timestamp", "parent_asin") if c in rest]
    keyed = df.withColumn("_text_digest", F.sha2("text", 256))
    return one_per_key(keyed, ["user_id", "_text_digest"], first + [c for c in rest if c not in first]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], time: str, created: str | None = None,
                   ties: Sequence[str] = ()) -> DataFrame:
    """Newest row per key; equal times fall back to the created time, then to the tie columns."""
    order = [F.col(time)] + ([F.col(created)] if created else []) + [F.col(c) for c in ties]
    return _pick(df, keys, order, latest=True)
