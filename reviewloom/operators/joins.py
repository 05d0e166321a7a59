"""Equi-joins of feature tables, item vectors and online lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.dedup import latest_per_key, one_per_key
from reviewloom.operators.features import ITEM_FEATURES, USER_FEATURES, fill_features
from reviewloom.operators.skew import HOT_ROWS, join_unique, key_loads


def _one_row(features: DataFrame, key: str, wanted: Sequence[str], unique: bool) -> DataFrame:
    columns = [c for c in wanted if c in features.columns]
    if unique:
        return features.select(key, *columns)
    if "event_timestamp" in features.columns:
        newest = latest_per_key(features.select(key, *columns, "event_timestamp"), [key], "event_timestamp", ties=columns)
        return newest.drop("event_timestamp")
    return one_per_key(features.select(key, *columns), [key])


def join_features(interactions: DataFrame, users: DataFrame, items: DataFrame, unique: bool = False) -> DataFrame:
    """Interactions with the current user and item features, missing values as 0.0.

    Of several rows of a key the newest counts; ``unique`` says that there are none, as in
    the tables that ``user_features`` and ``item_features`` make, and saves that step.
    Heavy users and items are counted on the interactions as given.
    """
    if "item_id" not in items.columns:
        items = items.withColumnRenamed("parent_asin", "item_id")
    by_user, by_item = key_loads(interactions, "user_id", "item_id")
    joined = join_unique(interactions, _one_row(users, "user_id", USER_FEATURES, unique), "user_id", "left", by_user)
    return fill_features(join_unique(joined, _one_row(items, "item_id", ITEM_FEATURES, unique), "item_id", "left", by_item))


def join_item_vectors(rows: DataFrame, vectors: DataFrame, key: str = "item_id",
                      vector: str = "item_embedding_avg") -> DataFrame:
    """Training rows with the mean item vector where one exists."""
    return join_unique(rows, vectors.select(key, vector), key)


def match_report(rows: DataFrame, column: str = "item_embedding_avg") -> DataFrame:
    """How many rows found a partner."""
    return rows.agg(F.count(column).alias("matched"), F.count("*").alias("rows"))


def index_interactions(interactions: DataFrame, users: DataFrame, items: DataFrame, unknown: str = "drop") -> DataFrame:
    """Replace string ids by dense indexes; unknown ids are dropped, or mapped to 0 with ``unknown="first"``."""
    how = "left" if unknown == "first" else "inner"
    by_user, by_item = key_loads(interactions, "user_id", "item_id")
    joined = join_unique(join_unique(interactions, users, "user_id", how, by_user), items, "item_id", how, by_item)
    return joined.fillna(0, subset=["user_idx", "item_idx"]) if unknown == "first" else joined


def restore_ids(indexed: DataFrame, users: DataFrame, items: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Back from dense indexes to the original ids; indexes that no id has get null."""
    by_user, by_item = key_loads(indexed, "user_idx", "item_idx", hot_rows=hot_rows)
    return join_unique(join_unique(indexed, users, "user_idx", "left", by_user), items, "item_idx", "left", by_item)
