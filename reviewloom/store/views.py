"""The declared views: user features, item features and review embeddings."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import text as tx
from reviewloom.functions.reviews import ensure_category, normalize_reviews, unify_item_column
from reviewloom.operators import features as ft
from reviewloom.operators.encode import Encoder, embed_column
from reviewloom.store.registry import Entity, FeatureView, Partial, Source, batch_feature_view

USER = Entity("user_id", description="reviewer id")
ITEM = Entity("item_id", description="product id")
REVIEW = Entity("review_id", description="review id")

# Time-to-live and declared types of the views.
FEATURE_TTL = timedelta(days=3650)
EMBEDDING_TTL = timedelta(days=90)
USER_SCHEMA = (
    ("user_avg_rating", T.DoubleType()),
    ("user_review_count", T.LongType()),
    ("user_unique_items", T.LongType()),
    ("user_avg_review_length", T.DoubleType()),
    ("user_category_count", T.LongType()),
    ("user_tenure_days", T.LongType()),
)
ITEM_SCHEMA = (
    ("item_avg_rating", T.DoubleType()),
    ("item_rating_stddev", T.DoubleType()),
    ("item_review_count", T.LongType()),
    ("item_total_helpful_votes", T.LongType()),
    ("item_avg_review_length", T.DoubleType()),
    ("item_price", T.FloatType()),
)
EMBEDDING_SCHEMA = (
    ("item_id", T.StringType()),
    ("user_id", T.StringType()),
    ("rating", T.DoubleType()),
    ("review_title", T.StringType()),
    ("embed_text", T.StringType()),
    ("embedding", T.ArrayType(T.FloatType())),
)
TRAINING_FEATURES = [f"user_features:{c}" for c in ft.USER_FEATURES] + [f"item_features:{c}" for c in ft.ITEM_FEATURES]


def stored_views(base: str) -> list[FeatureView]:
    """Views over the tables written by the feature job."""
    root = base.rstrip("/")
    return [
        FeatureView("user_features", (USER,), USER_SCHEMA, Source("user_features_source", path=f"{root}/user_features"), FEATURE_TTL),
        FeatureView("item_features", (ITEM,), ITEM_SCHEMA, Source("item_features_source", path=f"{root}/item_features"), FEATURE_TTL),
    ]


def raw_reviews_source(path: str) -> Source:
    """All category folders of the raw reviews (a glob), event time from the millisecond column."""
    return Source("raw_reviews", loader=lambda spark: ensure_category(spark.read.parquet(path)), millis_field="timestamp")


def review_pairs(df: DataFrame) -> DataFrame:
    """Raw reviews folded to one row per user and item, which both feature views are sums over."""
    return ft.pair_totals(normalize_reviews(df))


def raw_views(source: Source) -> list[FeatureView]:
    """The same features computed from raw reviews at materialisation, without stored tables; both come from one fold."""
    return [
        FeatureView("user_features", (USER,), USER_SCHEMA, source, FEATURE_TTL, ft.user_features_of, offline=False, fold=review_pairs),
        FeatureView("item_features", (ITEM,), ITEM_SCHEMA, source, FEATURE_TTL, ft.item_features_of, offline=False, fold=review_pairs),
    ]


def embedding_staging(df: DataFrame) -> DataFrame:
    """Review rows ready for the encoder: stable id, joined text of at least twenty characters."""
    df = unify_item_column(df).withColumn("embed_text", tx.embed_text())
    return df.filter(F.length("embed_text") >= tx.MIN_EMBED_CHARS).select(
        tx.review_id().alias("review_id"),
        F.col("parent_asin").alias("item_id"),
        "user_id",
        F.col("rating").cast("double").alias("rating"),
        F.col("title").alias("review_title"),
        tx.truncate_chars("embed_text", tx.VIEW_TEXT_CHARS).alias("embed_text"),
        F.timestamp_millis(F.col("timestamp")).alias("event_timestamp"),
    )


def review_embeddings_view(source: Source, encoder: Callable[[], Encoder] | None = None) -> FeatureView:
    @batch_feature_view("review_embeddings", [REVIEW], EMBEDDING_SCHEMA, source, EMBEDDING_TTL)
    def embeddings(df: DataFrame) -> DataFrame:
        return embed_column(embedding_staging(df), "embed_text", encoder=encoder)

    return embeddings


def partial_views(source: Source) -> list[FeatureView]:
    """User and item features kept up to date from stored totals per user, item and category, without reading history."""
    def fold_items(raw: DataFrame) -> DataFrame:
        return fold(raw).withColumnRenamed("parent_asin", "item_id")

    def fold(raw: DataFrame) -> DataFrame:
        return ft.category_totals(normalize_reviews(raw))

    def combine(item: str) -> Callable[[DataFrame], DataFrame]:
        return lambda totals: ft.added_totals(totals, ["user_id", item, "category"])

    def finish_items(totals: DataFrame) -> DataFrame:
        return ft.item_features_of(totals.withColumnRenamed("item_id", "parent_asin"))

    return [
        FeatureView("user_features", (USER,), USER_SCHEMA, source, FEATURE_TTL,
                    partial=Partial(fold, combine("parent_asin"), ft.user_features_by_category)),
        FeatureView("item_features", (ITEM,), ITEM_SCHEMA, source, FEATURE_TTL,
                    partial=Partial(fold_items, combine("item_id"), finish_items)),
    ]
