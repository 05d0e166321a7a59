"""Joining rows to a table with one row per key when some keys hold very many rows.

Adaptive execution splits skewed partitions only where both sides come straight from a
shuffle; a feature table that is aggregated or ranked in the same query is not such a
side.  Heavy keys are therefore counted first.  Their partner rows are few by
construction, so they are broadcast, and only the remaining keys are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.session import small_or_as_is

# A key above this many rows is heavy.  There are fewer heavy keys than rows over HOT_ROWS,
# 200,000 in a trillion rows, so all of them can be listed.
HOT_ROWS = 5_000_000


@dataclass(frozen=True)
class KeyLoad:
    """Heavy keys of a frame, and whether rows without a key are heavy as well."""

    keys: tuple = ()
    no_key: bool = False


def key_load(df: DataFrame, keys: str | Sequence[str], hot_rows: int | None = HOT_ROWS) -> KeyLoad:
    """Count rows per key, reading the key columns only; ``hot_rows=None`` skips the count."""
    if not hot_rows:
        return KeyLoad()
    names = [keys] if isinstance(keys, str) else list(keys)
    whole = df.select(*names).groupBy(*names).agg(F.count("*").alias("_n"))
    heavy = whole.filter(F.col("_n") > hot_rows).drop("_n").collect()
    complete = tuple(tuple(r) for r in heavy if all(v is not None for v in r))
    return KeyLoad(complete, len(complete) < len(heavy))


def key_loads(df: DataFrame, *keys: str, hot_rows: int | None = HOT_ROWS) -> list[KeyLoad]:
    """Loads of several single keys from one pass over ``df``."""
    if not hot_rows:
        return [KeyLoad() for _ in keys]
    sets = df.select(*keys).groupingSets([[k] for k in keys], *keys)
    counts = sets.agg(F.count("*").alias("_n"), *[F.grouping(k).alias(f"_not_{k}") for k in keys])
    heavy = counts.filter(F.col("_n") > hot_rows).collect()
    loads = []
    for key in keys:
        found = [row[key] for row in heavy if row[f"_not_{key}"] == 0]
        loads.append(KeyLoad(tuple((v,) for v in found if v is not None), None in found))
    return loads


def listed(df: DataFrame, keys: Sequence[str], values: Sequence[tuple]) -> DataFrame:
    """Counted key values as a broadcast frame with the key types of ``df``."""
    return F.broadcast(df.sparkSession.createDataFrame(list(values), df.select(*keys).schema))


def join_unique(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "left",
                load: KeyLoad | None = None) -> DataFrame:
    """Left or inner join to ``right``, which has one row per key.

    Without a ``load`` the keys of ``left`` are counted here; pass one when ``left`` is
    itself the result of work that should not run twice.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    load = key_load(left, names) if load is None else load
    parts = []
    rest = left
    if load.no_key:
        # Rows without a key never match and would all be shuffled to one task.
        present = F.lit(True)
        for name in names:
            present = present & F.col(name).isNotNull()
        rest = left.filter(present)
        if how == "left":
            blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name not in names]
            parts.append(left.filter(~present).select("*", *blank))
    if load.keys:
        heavy = listed(left, names, load.keys)
        partners = F.broadcast(right.join(heavy, names, "left_semi"))
        parts.append(rest.join(heavy, names, "left_semi").join(partners, names, how))
        rest = rest.join(heavy, names, "left_anti")
    joined = rest.join(right, names, how)
    for part in parts:
        joined = joined.unionByName(part)
    return joined


def join_counted(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join to a unique-key table that is usually tiny: broadcast when counted so, else heavy keys apart."""
    small = small_or_as_is(right)
    return join_unique(left, right, keys, how) if small is right else left.join(small, keys, how)
