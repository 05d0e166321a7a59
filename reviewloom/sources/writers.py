"""Sinks: Parquet datasets, text splits, vector tables and key-value writers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import text as tx
from reviewloom.functions.vectors import or_zero_vector
from reviewloom.operators.sampling import lowest_by_digest
from reviewloom.session import scratch_path

# Fixed value: rows per part file of the full ingest.
ROWS_PER_PART = 500_000

# Column order of a vector table.
VECTOR_COLUMNS = ("review_id_pk", "event_ts", "created_ts", "embedding", "rating", "embed_text",
                  "user_id", "item_id", "review_title", "review_id")

USER_FEATURE_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("user_avg_rating", T.DoubleType()),
    T.StructField("user_review_count", T.LongType()),
    T.StructField("user_unique_items", T.LongType()),
    T.StructField("user_avg_review_length", T.DoubleType()),
    T.StructField("user_category_count", T.LongType()),
    T.StructField("user_tenure_days", T.LongType()),
])
ITEM_FEATURE_SCHEMA = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("item_avg_rating", T.DoubleType()),
    T.StructField("item_rating_stddev", T.DoubleType()),
    T.StructField("item_review_count", T.LongType()),
    T.StructField("item_total_helpful_votes", T.LongType()),
    T.StructField("item_avg_review_length", T.DoubleType()),
    T.StructField("item_price", T.FloatType()),
])
REVIEW_EMBEDDING_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("review_title", T.StringType()),
    T.StructField("embed_text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])
PLACEHOLDERS = {
    "user_features": USER_FEATURE_SCHEMA,
    "item_features": ITEM_FEATURE_SCHEMA,
    "review_embeddings": REVIEW_EMBEDDING_SCHEMA,
}


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite", rows_per_part: int | None = None,
                  partition_by: Iterable[str] = ()) -> int:
    """Write Parquet and return the row count, observed on the write itself (no second pass)."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "snappy")
    if rows_per_part:
        writer = writer.option("maxRecordsPerFile", rows_per_part)
    keys = list(partition_by)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
    return seen.get["rows"]


def write_by_category(df: DataFrame, path: str, category: str = "category",
                      rows_per_part: int = ROWS_PER_PART) -> int:
    """One dataset for all categories; a rerun replaces only the categories it carries."""
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
       .option("maxRecordsPerFile", rows_per_part).partitionBy(category).parquet(path))
    return seen.get["rows"]


def write_text_splits(df: DataFrame, path: str, line: str, split: str,
                      names: Iterable[str] = ("train", "val", "test")) -> dict[str, int]:
    """One line per row into ``train/ val/ test/``.

    The rows are staged once, partitioned by split, so each text write reads its own
    part only and the plan behind ``df`` runs a single time.
    """
    staged_rows = df.select(line, split)
    spark = df.sparkSession
    stage = scratch_path(spark, "splits")
    staged_rows.write.partitionBy(split).parquet(stage)
    staged = spark.read.schema(staged_rows.schema).parquet(stage)
    counts = {}
    for name in names:
        seen = Observation()
        part = staged.filter(F.col(split) == name).select(line)
        part.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").text(f"{path.rstrip('/')}/{name}")
        counts[name] = seen.get["rows"]
    return counts


def vector_rows(df: DataFrame, dim: int, now: Column | None = None) -> DataFrame:
    """Rows of a vector table: hashed key, null defaults and truncation as column expressions.

    Expects ``review_id, item_id, user_id, rating, review_title, embed_text, embedding``.
    """
    seconds = F.unix_timestamp(F.current_timestamp() if now is None else now)
    rating = F.col("rating").cast("double")

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return df.select(
        tx.vector_key("review_id").alias("review_id_pk"),
        seconds.alias("event_ts"),
        seconds.alias("created_ts"),
        or_zero_vector("embedding", dim).alias("embedding"),
        F.when(rating != 0, rating.cast("string")).otherwise("0").alias("rating"),
        tx.truncate_bytes(text("embed_text")).alias("embed_text"),
        tx.truncate_chars(text("user_id"), tx.VECTOR_ID_CHARS).alias("user_id"),
        tx.truncate_chars(text("item_id"), tx.VECTOR_ID_CHARS).alias("item_id"),
        tx.truncate_chars(text("review_title"), tx.VECTOR_ID_CHARS).alias("review_title"),
        tx.truncate_chars(F.col("review_id").cast("string"), tx.VECTOR_ID_CHARS).alias("review_id"),
    )


def compact_vector_rows(df: DataFrame) -> DataFrame:
    """The five-column vector row: float rating with zero default and text cut at 511 characters."""
    return df.select(
        F.col("review_id").cast("string").alias("review_id"),
        F.col("item_id").cast("string").alias("item_id"),
        F.coalesce(F.col("rating").cast("float"), F.lit(0.0).cast("float")).alias("rating"),
        tx.truncate_chars(F.coalesce("embed_text", F.lit("")), tx.VIEW_TEXT_CHARS).alias("embed_text"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    )


def precomputed_vector_rows(df: DataFrame) -> DataFrame:
    """Already embedded rows prepared for the online table: string id, text columns cut at 511."""
    cut = {name: tx.truncate_chars(name, tx.VIEW_TEXT_CHARS) for name in ("embed_text", "review_title")
           if name in df.columns}
    return df.withColumns({"review_id": F.col("review_id").cast("string"), **cut})


def ensure_vector_table(spark: SparkSession, name: str, path: str) -> bool:
    """Create the vector table when it is missing; returns whether it was created."""
    if spark.catalog.tableExists(name):
        return False
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (review_id_pk STRING, event_ts BIGINT, created_ts BIGINT, "
        "embedding ARRAY<FLOAT>, rating STRING, embed_text STRING, user_id STRING, item_id STRING, "
        f"review_title STRING, review_id STRING) USING parquet LOCATION '{path}'"
    )
    return True


def insert_vectors(df: DataFrame, table: str) -> int:
    """Append vector rows from the executors; nothing passes through the driver."""
    seen = Observation()
    rows = df.select(*VECTOR_COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("append").insertInto(table)
    return seen.get["rows"]


def write_placeholders(spark: SparkSession, base: str, schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """Empty tables that carry a schema, for declaring views before the first job has run."""
    paths = []
    for name, schema in (schemas or PLACEHOLDERS).items():
        path = f"{base.rstrip('/')}/{name}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        paths.append(path)
    return paths


def rekeyed_vectors(old: DataFrame, now: Column | None = None, max_rows: int | None = None) -> DataFrame:
    """Rows of an older vector table in the store's key form with a fresh event time."""
    if max_rows is not None:
        old = lowest_by_digest(old, "review_id_pk", max_rows)
    return old.select(
        "review_id", "item_id", "user_id", F.col("rating").try_cast("double").alias("rating"),
        "review_title", "embed_text", "embedding",
        (F.current_timestamp() if now is None else now).alias("event_timestamp"),
    )


def _key_text(keys: list[str]) -> list[Column]:
    return [F.col(k).cast("string") for k in keys]


def key_bucket(keys: list[str], partitions: int) -> Column:
    """Bucket of a key: Spark's own hash partition number, so one task writes one whole bucket."""
    return F.pmod(F.hash(*_key_text(keys)), F.lit(partitions))


def write_keyed(df: DataFrame, keys: list[str], path: str, partitions: int = 10) -> int:
    """Latest rows to a Parquet table hashed by key into ``bucket=`` folders, for pruned lookups."""
    bucketed = df.repartition(partitions, *_key_text(keys)).withColumn("bucket", key_bucket(keys, partitions))
    return write_dataset(bucketed, path, partition_by=["bucket"])


def send_partitions(df: DataFrame, keys: list[str], open_writer: Callable[[], Callable[[Iterable[Row]], None]],
                    partitions: int = 10) -> None:
    """Feed an external store with bounded concurrency: one writer per key partition."""
    def feed(rows: Iterable[Row]) -> None:
        open_writer()(rows)

    df.repartition(partitions, *keys).foreachPartition(feed)

