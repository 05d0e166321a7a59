"""Scans: Parquet lists and globs, review JSONL, capped ingest, training splits."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.text import EXAMPLE_SCHEMA
from reviewloom.session import small_or_as_is

REVIEW_SCHEMA = T.StructType([
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("parent_asin", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("helpful_vote", T.LongType()),
    T.StructField("verified_purchase", T.BooleanType()),
])

# Row caps of the sample mode and the required embedding columns.
SAMPLE_PER_CATEGORY = 333_334
METADATA_SAMPLE = 50_000
EMBEDDING_COLUMNS = ("review_id", "item_id", "user_id", "rating", "embed_text", "embedding", "event_timestamp")


def split_paths(paths: str | Sequence[str]) -> list[str]:
    """Comma list to paths: parts are trimmed, blank parts dropped."""
    parts = paths.split(",") if isinstance(paths, str) else list(paths)
    found = [part.strip() for part in parts if part.strip()]
    if not found:
        raise ValueError("no input path given")
    return found


def read_parquet_list(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*split_paths(paths))


def read_reviews_glob(spark: SparkSession, pattern: str, ms_column: str = "timestamp") -> DataFrame:
    """All category folders matching a glob, with the event time added; the raw column stays for pushdown."""
    return spark.read.parquet(pattern).withColumn("event_timestamp", F.timestamp_millis(F.col(ms_column)))


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = REVIEW_SCHEMA,
               category: str | None = None) -> DataFrame:
    """Line-delimited JSON with a declared schema, so no inference pass over the files."""
    df = spark.read.schema(schema).json(path if isinstance(path, str) else list(path))
    return df if category is None else df.withColumn("category", F.lit(category))


def first_rows_by_file(spark: SparkSession, paths: str | Sequence[str], cap: int) -> DataFrame:
    """The first ``cap`` rows in file-name order, the last file trimmed at its head.

    Only per-file counts are compared; rows are picked by their position inside
    the file, so nothing is gathered in one task.
    """
    source = spark.read.parquet(*split_paths(paths))
    placed = source.select("*", F.col("_metadata.file_path").alias("_file"),
                           F.col("_metadata.row_index").alias("_row"))
    per_file = placed.groupBy("_file").agg(F.count("*").alias("_n"))
    # One row per file: the running total runs over the file list, not over the data.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    wanted = small_or_as_is(starts.filter(F.col("_start") < cap).select("_file", "_start"))
    kept = placed.join(wanted, "_file").filter(F.col("_row") < F.lit(cap) - F.col("_start"))
    return kept.select(*source.columns)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Sorted data files below one folder, from Spark's own file listing."""
    listing = spark.read.format("binaryFile").load(folder)
    return sorted(listing.inputFiles())


def category_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root`` that hold Parquet files, from Spark's own file listing."""
    base = root.rstrip("/")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(base)
    tail = base.rsplit("/", 1)[-1]
    return sorted({unquote(f.rsplit(f"/{tail}/", 1)[1].split("/", 1)[0]) for f in found.inputFiles() if f"/{tail}/" in f})


def read_training_split(spark: SparkSession, folder: str, split: str, max_files: int | None = None,
                        schema: T.StructType = EXAMPLE_SCHEMA) -> DataFrame:
    """Examples of one split: all part files, or the first ``max_files``, or a single ``<split>.jsonl``."""
    base = folder.rstrip("/")
    try:
        files = list_files(spark, f"{base}/{split}")
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        files = [f"{base}/{split}.jsonl"]
    parts = [f for f in files if f.rsplit("/", 1)[-1].startswith("part-") or f.endswith((".txt", ".jsonl"))]
    if max_files and max_files > 0:
        parts = parts[:max_files]
    return read_jsonl(spark, parts, schema)


def read_feature_tables(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Interactions, user features and item features written by the feature job."""
    root = base.rstrip("/")
    return tuple(spark.read.parquet(f"{root}/{name}") for name in ("interactions", "user_features", "item_features"))


def embedding_report(df: DataFrame, dim: int) -> DataFrame:
    """Rows, wrong-length vectors and missing vectors of an embedding table, over all rows."""
    missing = sorted(set(EMBEDDING_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"missing embedding columns: {missing}")
    return vector_length_report(df, "embedding", dim)


def vector_length_report(df: DataFrame, column: str, dim: int) -> DataFrame:
    size = F.size(F.col(column))
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(column).isNull()).alias("missing_vectors"),
        F.count_if(F.col(column).isNotNull() & (size != dim)).alias("wrong_length"),
    )


def validate_embeddings(df: DataFrame, dim: int) -> DataFrame:
    """Return ``df`` when every vector has length ``dim``; raise otherwise."""
    report = embedding_report(df, dim).first()
    if report["missing_vectors"] or report["wrong_length"]:
        raise ValueError(f"bad vectors: {report.asDict()}")
    return df
