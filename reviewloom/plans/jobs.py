"""The jobs: features, text sets, embeddings, vector table, preprocessing, training set.

Every output is written once and its row count is observed on that write.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import text as tx
from reviewloom.functions.reviews import ensure_text_columns, normalize_reviews, processed_reviews, unify_item_column
from reviewloom.operators import features as ft
from reviewloom.operators.aggregates import mean_vectors
from reviewloom.operators.dedup import distinct_reviews
from reviewloom.operators.encode import EMBEDDING_DIM, Encoder, embed_column, hashing_encoder
from reviewloom.operators.joins import join_item_vectors
from reviewloom.operators.sampling import cap_and_spread, cap_rows, example_shares, split_label
from reviewloom.plans.graph import JobGraph, Stage
from reviewloom.plans.report import JobReport
from reviewloom.session import spread, written
from reviewloom.sources.ingest import ReviewIngest
from reviewloom.sources.readers import SAMPLE_PER_CATEGORY, category_folders, read_parquet_list, split_paths
from reviewloom.sources.writers import (ensure_vector_table, insert_vectors, vector_rows, write_by_category, write_dataset,
                                        write_text_splits)
from reviewloom.store.feature_store import FeatureStore
from reviewloom.store.vector_index import N_LIST, VectorIndex
from reviewloom.store.views import TRAINING_FEATURES, stored_views

EncoderFactory = Callable[[], Encoder]


def feature_job(spark: SparkSession, input_paths: str, output: str, metadata_input: str | None = None,
                as_of: datetime | None = None, report_table: str | None = None) -> dict:
    """User features, item features and interactions from raw reviews."""
    report = JobReport(spark, "feature_engineering")
    reviews = normalize_reviews(read_parquet_list(spark, input_paths))
    metadata = spark.read.parquet(metadata_input) if metadata_input else None
    moment = None if as_of is None else F.lit(as_of)
    # The text is read for this table only; both feature tables are sums over it.
    pairs = written(ft.pair_totals(reviews), "pairs")
    outputs = (
        ("interactions", "total_interactions", ft.interactions(reviews)),
        ("user_features", "unique_users", ft.user_features_of(pairs, moment)),
        ("item_features", "unique_items", ft.item_features_of(pairs, metadata, moment)),
    )
    for name, metric, frame in outputs:
        began = time.time()
        report.metric(metric, write_dataset(frame, f"{output.rstrip('/')}/{name}"))
        report.timed(name, began)
    # Interactions hold one row per review, so their count is the input count.
    reviews_read = report.metrics["total_interactions"]
    report.metric("total_reviews", reviews_read)
    return report.finish(reviews_read, report_table)


def clean_reviews(df: DataFrame) -> DataFrame:
    """Reviews of at least fifty raw characters, one per (user, raw text), with cleaned text and a title."""
    long_enough = df.filter(F.length("text") >= tx.MIN_REVIEW_CHARS)
    return distinct_reviews(long_enough).withColumns({
        "text": tx.clean_text("text"), "title": F.coalesce(F.col("title"), F.lit("Unknown Product"))})


def instruction_examples(cleaned: DataFrame) -> DataFrame:
    """Both example kinds as JSON lines in one pass over the cleaned reviews."""
    is_text = cleaned.schema["rating"].dataType.typeName() == "string"
    star = tx.star_rating("rating", is_text)
    both = F.array_compact(F.array(tx.summary_example("title", "text", star), tx.qa_example("title", "text", star)))
    return cleaned.select(F.explode(both).alias("jsonl"))


def text_job(spark: SparkSession, input_paths: str, output: str, max_examples: int | None = None,
             train_ratio: float = 0.9, val_ratio: float = 0.05, report_table: str | None = None) -> dict:
    """Instruction examples split into train, validation and test JSONL."""
    report = JobReport(spark, "text_preprocessing")
    source = ensure_text_columns(unify_item_column(read_parquet_list(spark, input_paths)))
    read, kept = Observation(), Observation()
    cleaned = clean_reviews(source.observe(read, F.count(F.lit(1)).alias("rows")))
    keys = tuple(c for c in ("user_id", "text") if c in cleaned.columns)
    if max_examples:
        # The cap counts before it picks, so the counted input is not the observed one.
        cleaned = cap_rows(cleaned, max_examples, keys)
    cleaned = cleaned.observe(kept, F.count(F.lit(1)).alias("rows"))
    examples = instruction_examples(cleaned)
    labelled = examples.withColumn("split", split_label(F.col("jsonl"), example_shares(train_ratio, val_ratio)))
    began = time.time()
    counts = write_text_splits(labelled, output, "jsonl", "split")
    report.timed("write", began)
    report.metric("total_input_reviews", read.get["rows"])
    report.metric("clean_reviews", kept.get["rows"])
    for name, rows in counts.items():
        report.metric(f"{name}_examples", rows)
    report.metric("total_examples", sum(counts.values()))
    return report.finish(read.get["rows"], report_table)


def review_vectors(reviews: DataFrame, max_reviews: int | None = None, encoder: EncoderFactory | None = None,
                   as_of: datetime | None = None, stable_ids: bool = True) -> DataFrame:
    """Review embeddings with their attributes; ids are stable between runs unless surrogates are asked for."""
    df = unify_item_column(reviews).withColumn("embed_text", tx.embed_text())
    df = df.filter(F.length("embed_text") >= tx.MIN_EMBED_CHARS).withColumn("review_id", tx.review_id())
    df = cap_rows(df, max_reviews, ("review_id",))
    identifier = F.col("review_id") if stable_ids else tx.surrogate_id()
    staged = df.select(identifier.alias("review_id"), F.col("parent_asin").alias("item_id"), "user_id", "rating",
                       F.col("title").alias("review_title"), "embed_text")
    encoded = embed_column(staged, "embed_text", encoder=encoder)
    moment = F.current_timestamp() if as_of is None else F.lit(as_of)
    return encoded.withColumn("event_timestamp", moment)


def embedding_job(spark: SparkSession, input_paths: str, output: str, max_reviews: int | None = None,
                  encoder: EncoderFactory | None = None, report_table: str | None = None) -> dict:
    """Review embeddings to Parquet."""
    report = JobReport(spark, "embedding_generation")
    vectors = review_vectors(spread(read_parquet_list(spark, input_paths)), max_reviews, encoder)
    began = time.time()
    rows = write_dataset(vectors, output)
    report.timed("write", began)
    report.metric("total_embeddings", rows)
    return report.finish(rows, report_table)


def vector_table_job(spark: SparkSession, input_paths: str, table: str, table_path: str, max_reviews: int | None = None,
                     parquet_output: str | None = None, encoder: EncoderFactory | None = None, dim: int = EMBEDDING_DIM,
                     partitions: int = 200, report_table: str | None = None) -> dict:
    """Review embeddings to a vector table, with an optional Parquet copy.

    The encoder runs once: with a copy, the table is filled from the copy.
    """
    report = JobReport(spark, "vector_table")
    df = unify_item_column(spread(read_parquet_list(spark, input_paths))).withColumn("embed_text", tx.embed_text())
    df = df.filter(F.length("embed_text") >= tx.MIN_EMBED_CHARS).withColumn("review_id", tx.review_id())
    df = cap_and_spread(df, max_reviews, ("review_id",), partitions) if max_reviews else df
    staged = df.select(
        "review_id",
        F.col("parent_asin").alias("item_id"),
        F.coalesce(F.col("user_id"), F.lit("")).alias("user_id"),
        F.col("rating").try_cast("float").alias("rating"),
        F.coalesce(F.col("title"), F.lit("")).alias("review_title"),
        tx.truncate_chars("embed_text", tx.EMBED_INPUT_CHARS).alias("embed_text"),
    )
    encoded = embed_column(staged, "embed_text", encoder=encoder or hashing_encoder(dim))
    if parquet_output:
        began = time.time()
        report.metric("parquet_rows", write_dataset(encoded, parquet_output))
        report.timed("parquet_write", began)
        encoded = spark.read.schema(encoded.schema).parquet(parquet_output)
    ensure_vector_table(spark, table, table_path)
    began = time.time()
    rows = insert_vectors(vector_rows(encoded, dim), table)
    report.timed("insert", began)
    report.metric("total_embeddings", rows)
    return report.finish(rows, report_table)


def preprocess_job(spark: SparkSession, raw: str, output: str, categories: Sequence[str] | None = None,
                   report_table: str | None = None) -> dict:
    """All category folders below ``raw``, or those named, to one dataset with an event time, partitioned by category."""
    report = JobReport(spark, "preprocess_reviews")
    named = category_folders(spark, raw) if categories is None else list(categories)
    frames = [spark.read.parquet(f"{raw.rstrip('/')}/{c}").withColumn("category", F.lit(c)) for c in named]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)
    read = Observation()
    rows = write_by_category(processed_reviews(union.observe(read, F.count(F.lit(1)).alias("rows"))), output)
    report.metric("raw_rows", read.get["rows"])
    report.metric("written_rows", rows)
    return report.finish(read.get["rows"], report_table)


def training_set(store: FeatureStore, interactions: DataFrame, embeddings: DataFrame | None = None,
                 max_interactions: int | None = None) -> DataFrame:
    """Labelled interactions with point-in-time features, missing values as 0.0, optional item vectors."""
    labelled = ft.labelled_interactions(interactions)
    labelled = cap_rows(labelled, max_interactions, ("user_id", "item_id", "event_timestamp"))
    entities = labelled.select("user_id", "item_id", "event_timestamp", "label")
    filled = ft.fill_features(store.get_historical_features(entities, TRAINING_FEATURES))
    return filled if embeddings is None else join_item_vectors(filled, mean_vectors(embeddings))


def training_set_job(spark: SparkSession, features_base: str, output: str, interactions: str | None = None,
                     embeddings: str | None = None, max_interactions: int | None = None, dry_run: bool = False,
                     report_table: str | None = None) -> dict:
    """Training dataset to Parquet; a dry run plans and summarises without writing."""
    report = JobReport(spark, "training_set")
    base = features_base.rstrip("/")
    store = FeatureStore(spark, f"{base}/store")
    store.apply(stored_views(base))
    rows = training_set(store, spark.read.parquet(interactions or f"{base}/interactions"),
                        spark.read.parquet(embeddings) if embeddings else None, max_interactions)
    if dry_run:
        rows.printSchema()
        summary = ft.dataset_summary(rows).collect()
        total = summary[0]["rows"]
    else:
        total = write_dataset(rows, output)
        summary = ft.dataset_summary(spark.read.parquet(output)).collect()
    for line in summary:
        report.metric(f"null_rate_{line['feature']}", line["null_rate"])
    for name in ("users", "items", "positive_rate"):
        report.metric(name, summary[0][name] or 0.0)
    report.metric("training_rows", total)
    return report.finish(total, report_table)


def run_all(spark: SparkSession, raw: str, base: str, metadata_input: str | None = None, start: datetime | None = None,
            end: datetime | None = None, encoder: EncoderFactory | None = None) -> dict[str, dict]:
    """All data stages in dependency order: features, text, embeddings; store; training set.

    A run that was interrupted is taken up again: stages whose inputs and outputs are as a
    run before left them are skipped, and their results come from its log below ``base``.
    """
    root = base.rstrip("/")
    inputs = tuple(split_paths(raw))
    for path in inputs:
        spark.read.parquet(path).schema  # a missing input fails here, before any output is touched
    began = start or datetime(2010, 1, 1)

    def materialize() -> dict:
        store = FeatureStore(spark, f"{root}/store")
        store.apply(stored_views(root))
        return store.materialize_incremental(end or datetime.now(timezone.utc), start=began)

    features = tuple(f"{root}/{name}" for name in ("interactions", "user_features", "item_features"))
    metadata = (metadata_input,) if metadata_input else ()
    # The first three stages do not depend on each other and share the cluster.
    done = JobGraph(spark, f"{root}/jobs", [
        Stage("features", lambda: feature_job(spark, raw, root, metadata_input), inputs=inputs + metadata, outputs=features),
        Stage("text", lambda: text_job(spark, raw, f"{root}/text"), inputs=inputs, outputs=(f"{root}/text",)),
        Stage("embeddings", lambda: embedding_job(spark, raw, f"{root}/review_embeddings", encoder=encoder), inputs=inputs,
              outputs=(f"{root}/review_embeddings",)),
        Stage("materialize", materialize, needs=("features",), parameters={"start": began.isoformat(), "end": end.isoformat() if end else None}),
        Stage("training_set", lambda: training_set_job(spark, root, f"{root}/training_dataset"), needs=("materialize",),
              outputs=(f"{root}/training_dataset",)),
    ]).run()
    return {name: stage["result"] for name, stage in done.items()}


def ingest_job(spark: SparkSession, folder: str, output: str, category: str | None = None, sample: bool = False) -> dict:
    """New review files of ``folder`` to Parquet by category, bad lines to the reject table."""
    report = JobReport(spark, "ingest")
    ingest = ReviewIngest(spark, output)
    counts = ingest.run(folder, category, SAMPLE_PER_CATEGORY if sample else None)
    total = 0
    for r in counts.groupBy("reason").agg(F.sum("lines").alias("lines")).collect():  # one row per reason
        report.metric("good_rows" if r["reason"] is None else f"rejected: {r['reason']}", r["lines"])
        total += r["lines"]
    return report.finish(total)


def index_job(spark: SparkSession, vectors: str, output: str, vector_id: str = "review_id", append: bool = False, n_list: int = N_LIST) -> dict:
    """A stored vector index of an embedding table, or more rows for it."""
    report = JobReport(spark, "vector_index")
    index = VectorIndex(spark, output, vector_id=vector_id)
    rows = read_parquet_list(spark, vectors)
    state = index.append(rows) if append else index.build(rows, n_list)
    report.metric("indexed_rows", state.rows)
    report.metric("nprobe", state.nprobe)
    report.metric("sample_recall", state.recall)
    return report.finish(state.rows)
