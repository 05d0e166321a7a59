"""Normalising raw review columns to one fixed shape."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults for columns a source may lack.
DEFAULT_HELPFUL_VOTE = 0
DEFAULT_TEXT = ""
DEFAULT_RATING = 3
DEFAULT_TITLE = "Unknown Product"

# Fixed value: a rating at or above this is a positive interaction.
POSITIVE_RATING = 4


def unify_item_column(df: DataFrame) -> DataFrame:
    """Rename ``asin`` to ``parent_asin`` only when the latter is missing."""
    if "asin" in df.columns and "parent_asin" not in df.columns:
        return df.withColumnRenamed("asin", "parent_asin")
    return df


def ensure_timestamp(df: DataFrame) -> DataFrame:
    """Guarantee a BIGINT epoch-millisecond ``timestamp``, from ``unixReviewTime`` seconds if needed."""
    if "timestamp" not in df.columns:
        if "unixReviewTime" not in df.columns:
            return df
        seconds = F.col("unixReviewTime").cast("bigint")
        return df.withColumn("timestamp", F.unix_millis(F.timestamp_seconds(seconds)))
    kind = df.schema["timestamp"].dataType.typeName()
    if kind.startswith("timestamp"):
        return df.withColumn("timestamp", F.unix_millis(F.col("timestamp").cast("timestamp")))
    return df


def ensure_category(df: DataFrame) -> DataFrame:
    """Take the input file path as category when the source has none.

    The file's metadata column is used where ``df`` still offers it; add the category
    before joining, while the rows come from one source.
    """
    if "category" in df.columns:
        return df
    try:
        return df.select("*", F.col("_metadata.file_path").alias("category"))
    except AnalysisException:
        return df.withColumn("category", F.input_file_name())


def ensure_text_columns(df: DataFrame) -> DataFrame:
    """Add ``text``, ``rating`` and ``title`` with their defaults when the source lacks them."""
    for name, value in (("text", DEFAULT_TEXT), ("rating", DEFAULT_RATING), ("title", DEFAULT_TITLE)):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def ensure_helpful_vote(df: DataFrame) -> DataFrame:
    return df if "helpful_vote" in df.columns else df.withColumn("helpful_vote", F.lit(DEFAULT_HELPFUL_VOTE))


def normalize_reviews(df: DataFrame) -> DataFrame:
    """Item key, millisecond time, category and votes in the shape the feature jobs expect."""
    for step in (unify_item_column, ensure_timestamp, ensure_category, ensure_helpful_vote):
        df = df.transform(step)
    return df


def event_time_seconds(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp with whole-second precision."""
    millis = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_seconds((millis / F.lit(1000)).cast("bigint"))


def event_time_millis(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp that keeps the milliseconds."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def processed_reviews(df: DataFrame) -> DataFrame:
    """Event time at second precision, ``item_id`` key, rows without time, item or user dropped."""
    df = df.withColumn("event_timestamp", event_time_seconds("timestamp"))
    if "item_id" not in df.columns:
        df = df.withColumnRenamed("asin" if "asin" in df.columns else "parent_asin", "item_id")
    return df.dropna(subset=["event_timestamp", "item_id", "user_id"])


def positive_label(rating: Column | str = "rating") -> Column:
    """1.0 for a rating of four or more, else 0.0 (a missing rating counts as 0.0)."""
    value = F.col(rating) if isinstance(rating, str) else rating
    return F.when(value >= POSITIVE_RATING, 1.0).otherwise(0.0)


def price_as_float(price: Column | str = "price") -> Column:
    """Price as float; unparsable text such as ``from 14.99`` gives null."""
    return (F.col(price) if isinstance(price, str) else price).try_cast("float")
