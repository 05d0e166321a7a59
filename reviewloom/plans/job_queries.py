"""Queries that run whole jobs over the test tables and read back what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import text as tx
from reviewloom.operators import features as ft
from reviewloom.operators.encode import hashing_encoder
from reviewloom.operators.topk import top_k
from reviewloom.plans import jobs
from reviewloom.plans.catalogue import REVIEWS_SQL, query
from reviewloom.plans.review_queries import TRUNCATED
from reviewloom.session import scratch_path
from reviewloom.sources import driver_tables as dt
from reviewloom.sources import writers

DIM = 16


def _stored(spark: SparkSession, frame: DataFrame, label: str) -> str:
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return path


EMBEDDED_SQL = """
SELECT source AS user_id, count(*) AS rows, count(DISTINCT doc_id) AS reviews, 16::bigint * count(*) AS vector_values,
       cast(sum(length(substr(coalesce(lang, '') || ' ' || coalesce(text, ''), 1, {most}))) AS bigint) AS characters
FROM documents WHERE length(coalesce(lang, '') || ' ' || coalesce(text, '')) >= 20 GROUP BY source"""


@query("embedding_dataset", EMBEDDED_SQL.format(most=1_000_000_000))
def embedding_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The embedding job over every document."""
    raw, out = _stored(spark, dt.document_reviews(spark, sf), "raw"), scratch_path(spark, "embeddings")
    jobs.embedding_job(spark, raw, out, encoder=hashing_encoder(DIM))
    return spark.read.parquet(out).groupBy("user_id").agg(
        F.count("*").alias("rows"), F.count_distinct("review_id").alias("reviews"),
        F.sum(F.size("embedding")).alias("vector_values"), F.sum(F.length("embed_text")).alias("characters"))


@query("vector_table_from_reviews", f"""
SELECT user_id, count(*) AS rows, count(DISTINCT doc_id) AS reviews, {DIM}::bigint * count(*) AS vector_values,
       cast(sum(CASE WHEN strlen(text) <= 508 THEN length(text) ELSE {TRUNCATED} END) AS bigint) AS characters
FROM (SELECT doc_id, source AS user_id, substr(coalesce(lang, '') || ' ' || coalesce(text, ''), 1, {tx.EMBED_INPUT_CHARS}) AS text FROM documents)
WHERE length(text) >= 20 GROUP BY user_id""")
def vector_table_from_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """The vector table job over every document, without a cap."""
    raw, path = _stored(spark, dt.document_reviews(spark, sf), "raw"), scratch_path(spark, "vectors")
    name = "vectors_" + path[-32:]
    jobs.vector_table_job(spark, raw, name, path, encoder=hashing_encoder(DIM), dim=DIM, partitions=8)
    return spark.table(name).groupBy("user_id").agg(
        F.count("*").alias("rows"), F.count_distinct("review_id").alias("reviews"),
        F.sum(F.size("embedding")).alias("vector_values"), F.sum(F.length("embed_text")).alias("characters"))


@query("preprocessed_folders", f"""
WITH {REVIEWS_SQL}
SELECT 'stars=' || cast(rating AS integer) AS category, count(*) AS reviews, count(DISTINCT user_id) AS users,
       cast(max(timestamp) // 1000 AS bigint) AS last_s FROM reviews GROUP BY ALL""")
def preprocessed_folders(spark: SparkSession, sf: str) -> DataFrame:
    """The preprocessing job over all category folders that it finds."""
    raw, out = scratch_path(spark, "folders"), scratch_path(spark, "processed")
    rows = dt.reviews(spark, sf).drop("category").withColumn("stars", F.col("rating").cast("int"))
    rows.write.partitionBy("stars").parquet(raw)
    jobs.preprocess_job(spark, raw, out)
    return spark.read.parquet(out).groupBy("category").agg(
        F.count("*").alias("reviews"), F.count_distinct("user_id").alias("users"),
        F.unix_seconds(F.max("event_timestamp")).alias("last_s"))


@query("surrogate_ids", "SELECT lang, count(*) AS rows, count(*) AS ids FROM documents GROUP BY lang")
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = dt.table(spark, sf, "documents").withColumn("id", tx.surrogate_id())
    return docs.groupBy("lang").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids"))


@query("stripped_embed_texts", """
SELECT doc_id, length(t)::integer AS chars FROM (SELECT doc_id, trim(coalesce(lang, '') || ' ' || coalesce(text, ''), ' ') AS t FROM documents)
WHERE length(t) >= 20""")
def stripped_embed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that are long enough after they were stripped."""
    docs = dt.document_reviews(spark, sf).withColumn("t", tx.embed_text(strip=True))
    return docs.filter(F.length("t") >= tx.MIN_EMBED_CHARS).select("doc_id", F.length("t").alias("chars"))


@query("placeholder_tables", f"""
WITH {REVIEWS_SQL}
SELECT 'item_features' AS name, 0::bigint AS rows, 0::bigint AS reviews
UNION ALL SELECT 'user_features', count(DISTINCT user_id), count(*) FROM reviews""")
def placeholder_tables(spark: SparkSession, sf: str) -> DataFrame:
    """An empty table stands in for item features; user features, written before, are not replaced."""
    base = scratch_path(spark, "base")
    writers.write_dataset(ft.user_features(dt.reviews(spark, sf)), f"{base}/user_features")
    made = {path.rsplit("/", 1)[-1]: path for path in writers.write_placeholders(spark, base)}
    items, users = (spark.read.parquet(made[name]).agg(
        F.lit(name).alias("name"), F.count("*").alias("rows"), F.coalesce(F.sum(counted), F.lit(0)).cast("bigint").alias("reviews"))
        for name, counted in (("item_features", "item_review_count"), ("user_features", "user_review_count")))
    return items.unionByName(users)


@query("similar_vectors_odd_values", """
WITH v AS (SELECT vec_id, embedding::double[] AS e FROM embeddings WHERE vec_id % 10 > 2),
q AS (SELECT vec_id AS query_id, e AS query FROM v WHERE vec_id % 20 = 5),
p AS (SELECT query_id, vec_id, round(list_dot_product(query, e), 9) AS score FROM q, v)
SELECT query_id, vec_id AS vector_id, round(score, 6) AS score, rank::integer AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5""")
def similar_vectors_odd_values(spark: SparkSession, sf: str) -> DataFrame:
    """Three vectors in ten hold a null, NaN or infinite element; the others are found as if those were not there."""
    kind = F.col("vec_id") % 10
    first = F.when(kind == 1, F.lit("NaN").cast("float")).when(kind == 2, F.lit("Infinity").cast("float")).when(kind > 2, F.col("embedding")[0])
    rows = dt.table(spark, sf, "embeddings").select(
        "vec_id", F.concat(F.array(first), F.slice("embedding", 2, F.size("embedding") - 1)).alias("embedding"))
    asked = rows.filter(F.col("vec_id") % 20 == 5).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    found = top_k(asked, rows, 5, vector_id="vec_id", metric="dot")
    blocks = top_k(asked, rows, 5, vector_id="vec_id", metric="dot", few_queries=1, block_queries=64, block_vectors=128)
    both = found.join(blocks, ["query_id", "vector_id", "score", "rank"])
    return both.select("query_id", "vector_id", F.round("score", 6).alias("score"), "rank")


@query("job_report_rows", """
SELECT 'embedding_generation' AS job, 'FINISHED' AS status, cast(count(*) AS double) AS total_embeddings FROM documents
WHERE length(coalesce(lang, '') || ' ' || coalesce(text, '')) >= 20""")
def job_report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The row that a job appends to its report table."""
    raw, out, report = _stored(spark, dt.document_reviews(spark, sf), "raw"), scratch_path(spark, "embeddings"), scratch_path(spark, "report")
    jobs.embedding_job(spark, raw, out, encoder=hashing_encoder(DIM), report_table=report)
    return spark.read.parquet(report).select("job", "status", F.col("metrics")["total_embeddings"].alias("total_embeddings"))
