"""Row caps, exact-size samples, repeatable splits and negative sampling.

Randomness comes from digests of a row key, so a rerun or a lost executor gives
the same rows.  ``randomSplit`` and surrogate row ids depend on the partitioning
and are offered only where the caller asks for them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.operators.skew import join_counted
from reviewloom.session import written

SPLIT_STEPS = 10_000


def digest(*keys: Column | str, seed: int | None = None) -> Column:
    """Hex digest of a row key; a seed gives an independent order."""
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    prefix = [] if seed is None else [F.lit(str(seed))]
    return F.md5(F.concat_ws("_", *prefix, *parts))


def digest_number(hexed: Column) -> Column:
    """First eight hex digits as a whole number."""
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("bigint")


def lowest_by_digest(df: DataFrame, hex_column: str, n: int, group: str | None = None,
                     tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the ``n`` rows with the lowest hex digest, overall or per group.

    Digests are uniform, so their first four digits cut the rows into 65,536 even
    slices.  Counting slices finds the one where the ``n``-th row lies; slices below
    are kept as they are and only that slice is ranked.  A hot group is therefore
    spread over all slices and never sorted as a whole.
    """
    scope = [] if group is None else [group]
    # Written once: counts, rows below the cut and rows at the cut all read it.
    sliced = written(df.withColumn("_slice", F.substring(hex_column, 1, 4)), "digests")
    counts = sliced.groupBy(*scope, "_slice").agg(F.count("*").alias("_rows"))
    running = Window.partitionBy(*scope).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (counts.withColumn("_upto", F.sum("_rows").over(running))
                  .withColumn("_before", F.col("_upto") - F.col("_rows"))
                  .filter((F.col("_before") < n) & (F.col("_upto") >= n))
                  .select(*scope, F.col("_slice").alias("_cut"), (F.lit(n) - F.col("_before")).alias("_left")))
    if group is None:
        edge = cuts.first()
        if edge is None:
            return sliced.drop("_slice") if n > 0 else df.limit(0)
        marked = sliced.withColumns({"_cut": F.lit(edge["_cut"]), "_left": F.lit(edge["_left"])})
    else:
        # One row per group; groups smaller than n have no cut and are kept whole.
        named = [F.col(group).isNull().alias("_no_group"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("_group")]
        names = ["_no_group", "_group"]
        marked = join_counted(sliced.select("*", *named), cuts.select(*named, "_cut", "_left"), names).drop(*names)
    below = marked.filter(F.col("_cut").isNull() | (F.col("_slice") < F.col("_cut"))).select(*df.columns)
    order = [F.col(hex_column), *[F.col(c) for c in tie_breakers]]
    # The constant bound lets each task drop ranks above n before the shuffle.
    ranked = Window.partitionBy(*scope, "_slice").orderBy(*order)
    at_cut = (marked.filter(F.col("_slice") == F.col("_cut"))
                    .withColumn("_rank", F.row_number().over(ranked))
                    .filter((F.col("_rank") <= n) & (F.col("_rank") <= F.col("_left"))).select(*df.columns))
    return below.unionByName(at_cut)


def sample_exact(df: DataFrame, n: int, keys: tuple[str, ...], seed: int = 42) -> DataFrame:
    """Uniform sample of exactly ``n`` rows (all rows when there are fewer)."""
    marked = df.withColumn("_digest", digest(*keys, seed=seed))
    return lowest_by_digest(marked, "_digest", n, tie_breakers=keys).drop("_digest")


def cap_rows(df: DataFrame, n: int | None, keys: tuple[str, ...]) -> DataFrame:
    """Repeatable row cap; without a cap the frame is returned unchanged."""
    if not n:
        return df
    marked = df.withColumn("_digest", digest(*keys))
    return lowest_by_digest(marked, "_digest", n, tie_breakers=keys).drop("_digest")


def cap_per_group(df: DataFrame, group: str, n: int, keys: tuple[str, ...]) -> DataFrame:
    """At most ``n`` rows of every group, chosen repeatably."""
    marked = df.withColumn("_digest", digest(*keys))
    return lowest_by_digest(marked, "_digest", n, group=group, tie_breakers=keys).drop("_digest")


def cap_and_spread(df: DataFrame, n: int | None, keys: tuple[str, ...], partitions: int = 200) -> DataFrame:
    """Row cap, then an even spread over partitions ahead of a costly encoder."""
    return cap_rows(df, n, keys).repartition(partitions, *keys)


# Subset sizes of a quick training run.
QUICK_SUBSET = {"train": 1_000, "val": 200, "eval": 50}


def quick_subset(df: DataFrame, split: str, keys: tuple[str, ...], sizes: Mapping[str, int] = QUICK_SUBSET) -> DataFrame:
    return cap_rows(df, sizes[split], keys)


def split_label(key: Column, shares: Mapping[str, float]) -> Column:
    """Split name by the digest of a stable key; equal keys always fall in the same split."""
    step = digest_number(F.md5(key.cast("string"))) % SPLIT_STEPS
    names = list(shares)
    chain, upto = None, 0.0
    for name in names[:-1]:
        upto += shares[name]
        test = step < round(upto * SPLIT_STEPS)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return F.lit(names[-1]) if chain is None else chain.otherwise(names[-1])


def example_shares(train: float = 0.9, val: float = 0.05) -> dict[str, float]:
    return {"train": train, "val": val, "test": 1.0 - train - val}


def random_splits(df: DataFrame, shares: Mapping[str, float], seed: int = 42) -> dict[str, DataFrame]:
    """Spark's own random split; its result depends on the partitioning of ``df``."""
    return dict(zip(shares, df.randomSplit(list(shares.values()), seed=seed)))


# Shares of the interaction split.
INTERACTION_SHARES = {"train": 0.9, "val": 0.1}


def _drawn(indexed: DataFrame, first: int, n_users: int, n_items: int, keys: tuple[str, ...], ratio: int, seed: int) -> DataFrame:
    """Index pairs named by the digest of the row key and the draw number, for draws from ``first``; draw 0 is the interaction itself.

    Rows unfold into draw numbers before the digests are taken: inside a higher-order function these would not be compiled.
    """
    draws = [F.lit(d) for d in range(first, ratio + 1)]
    rows = indexed.select("user_idx", "item_idx", "label", *[F.col(k).cast("string").alias(f"_key{i}") for i, k in enumerate(keys)],
                          F.explode(F.array(*draws) if draws else F.array().cast("array<int>")).alias("_draw"))
    texts = [F.col("_draw"), *[F.col(f"_key{i}") for i in range(len(keys))]]

    def index(side: str, size: int) -> Column:
        return digest_number(digest(*texts, F.lit(side), seed=seed)) % size

    def chosen(own: str, kind: str, drawn: Column) -> Column:
        return (drawn if first else F.when(F.col("_draw") == 0, F.col(own).cast(kind)).otherwise(drawn)).alias(own)

    return rows.select(chosen("user_idx", "bigint", index("user", n_users)), chosen("item_idx", "bigint", index("item", n_items)),
                       chosen("label", "double", F.lit(0.0)))


def negative_pairs(indexed: DataFrame, n_users: int, n_items: int, keys: tuple[str, ...], ratio: int = 3,
                   seed: int = 42, exclude_seen: bool = False) -> DataFrame:
    """``ratio`` random (user, item) index pairs per interaction, label 0.

    Indexes are dense, so a digest modulo the counts names the pair directly and no
    id table is joined.  Identical interactions draw the same pairs.  Seen pairs are left
    in unless ``exclude_seen`` is set.
    """
    pairs = _drawn(indexed, 1, n_users, n_items, keys, ratio, seed)
    if not exclude_seen:
        return pairs
    # Distinct first: a pair drawn or seen often is one row on the other side of the join.
    seen = indexed.select("user_idx", "item_idx").distinct()
    return pairs.join(seen, ["user_idx", "item_idx"], "left_anti")


def training_samples(indexed: DataFrame, n_users: int, n_items: int, keys: tuple[str, ...], ratio: int = 3,
                     seed: int = 42, exclude_seen: bool = False) -> DataFrame:
    """Observed interactions together with their negative pairs."""
    if exclude_seen:
        observed = indexed.select("user_idx", "item_idx", "label")
        return observed.unionByName(negative_pairs(indexed, n_users, n_items, keys, ratio, seed, exclude_seen))
    # One pass: each interaction unfolds into itself and its draws.
    return _drawn(indexed, 0, n_users, n_items, keys, ratio, seed)
