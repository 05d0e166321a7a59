"""Queries: sources, sinks, normalisation, features, joins and splits over the review view."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import reviews as rv
from reviewloom.functions import text as tx
from reviewloom.functions.catalog import category_of
from reviewloom.operators import dedup, joins, sampling
from reviewloom.operators import features as ft
from reviewloom.operators.asof import asof_join
from reviewloom.operators.ordered import dense_index
from reviewloom.plans import jobs
from reviewloom.plans.catalogue import (CLEAN_SQL, DOC_REVIEWS_SQL, ITEMS_SQL, REVIEWS_SQL, USERS_SQL, hex_number, query)
from reviewloom.session import discard, scratch_path, written
from reviewloom.sources import driver_tables as dt
from reviewloom.sources import readers, writers
from reviewloom.store import Entity, FeatureStore, FeatureView, Source
from reviewloom.store.feature_store import alive, within
from reviewloom.store.views import TRAINING_FEATURES, raw_views
from reviewloom.streaming.incremental import materialize_new_files


def r6(*names: str) -> dict:
    return {n: F.round(n, 6) for n in names}


# Sources and sinks


@query("scan_path_list", """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders) GROUP BY o_orderstatus""")
def scan_path_list(spark: SparkSession, sf: str) -> DataFrame:
    both = readers.read_parquet_list(spark, f"{sf}/orders.parquet , ,{sf}/orders.parquet")
    return both.groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("scan_category_folders", f"""
WITH {REVIEWS_SQL}
SELECT category, count(*) AS reviews, min(timestamp) AS first_ms, max(timestamp) AS last_ms
FROM reviews GROUP BY category""")
def scan_category_folders(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "categories")
    dt.reviews(spark, sf).write.partitionBy("category").parquet(path)
    found = rv.normalize_reviews(readers.read_reviews_glob(spark, f"{path}/*/"))
    named = found.withColumn("category", F.url_decode(F.regexp_extract("category", "category=([^/]+)", 1)))
    return named.groupBy("category").agg(
        F.count("*").alias("reviews"), F.unix_millis(F.min("event_timestamp")).alias("first_ms"),
        F.unix_millis(F.max("event_timestamp")).alias("last_ms"))


@query("ingest_jsonl_by_category", f"""
WITH {REVIEWS_SQL}
SELECT category, count(*) AS reviews, sum(rating) AS rating_sum, cast(sum(length(text)) AS bigint) AS chars
FROM reviews GROUP BY category""")
def ingest_jsonl_by_category(spark: SparkSession, sf: str) -> DataFrame:
    lines, table = scratch_path(spark, "jsonl"), scratch_path(spark, "ingested")
    dt.reviews(spark, sf).write.json(lines)
    schema = T.StructType([*readers.REVIEW_SCHEMA.fields, T.StructField("category", T.StringType())])
    writers.write_by_category(readers.read_jsonl(spark, lines, schema), table, rows_per_part=20_000)
    return spark.read.parquet(table).groupBy("category").agg(
        F.count("*").alias("reviews"), F.sum("rating").alias("rating_sum"), F.sum(F.length("text")).alias("chars"))


@query("ingest_capped_per_category", """
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(cast(doc_id AS varchar)), doc_id) AS rn
  FROM documents) WHERE rn <= 10""")
def ingest_capped_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.cap_per_group(dt.table(spark, sf, "documents"), "source", 10, ("doc_id",)).select("doc_id", "source")


@query("metadata_head_by_file", """
SELECT p_partkey, p_retailprice FROM (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS rn FROM part) WHERE rn <= 1500)""")
def metadata_head_by_file(spark: SparkSession, sf: str) -> DataFrame:
    return readers.first_rows_by_file(spark, f"{sf}/part.parquet", 1500).select("p_partkey", "p_retailprice")


@query("feature_tables_from_disk", f"""
WITH {REVIEWS_SQL}, {USERS_SQL}, {ITEMS_SQL}
SELECT r.label, count(*) AS rows, round(avg(u.user_avg_rating), 6) AS user_avg_rating,
       round(avg(i.item_avg_rating), 6) AS item_avg_rating, cast(sum(u.user_review_count) AS bigint) AS user_reviews
FROM (SELECT *, CASE WHEN rating >= 4 THEN 1.0::double ELSE 0.0::double END AS label FROM reviews) r
LEFT JOIN user_features u USING (user_id) LEFT JOIN item_features i ON i.item_id = r.parent_asin GROUP BY r.label""")
def feature_tables_from_disk(spark: SparkSession, sf: str) -> DataFrame:
    base, raw, meta = (scratch_path(spark, n) for n in ("features", "raw", "meta"))
    dt.reviews(spark, sf).write.parquet(raw)
    dt.metadata(spark, sf).write.parquet(meta)
    jobs.feature_job(spark, raw, base, meta)
    pairs, users, items = readers.read_feature_tables(spark, base)
    joined = joins.join_features(pairs, users, items)
    return joined.groupBy("label").agg(
        F.count("*").alias("rows"), F.round(F.avg("user_avg_rating"), 6).alias("user_avg_rating"),
        F.round(F.avg("item_avg_rating"), 6).alias("item_avg_rating"),
        F.sum("user_review_count").cast("bigint").alias("user_reviews"))


@query("embedding_validation", """
SELECT count(*) AS rows, count(*) FILTER (embedding IS NULL) AS missing_vectors,
       count(*) FILTER (embedding IS NOT NULL AND len(embedding) <> 64) AS wrong_length FROM embeddings""")
def embedding_validation(spark: SparkSession, sf: str) -> DataFrame:
    return readers.vector_length_report(dt.table(spark, sf, "embeddings"), "embedding", 64)


TRUNCATED = """list_max(list_transform(list_filter(range(0, 509), lambda n: strlen(substr(text, 1, n)) <= 508),
  lambda n: length(substr(text, 1, n))))"""


def document_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the vector of equal number where there is one."""
    docs, vectors = dt.table(spark, sf, "documents"), dt.table(spark, sf, "embeddings")
    return docs.join(vectors, docs.doc_id == vectors.vec_id, "left").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("review_id"), F.col("source").alias("item_id"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("user_id"), F.pmod("n_chars", F.lit(5)).alias("rating"),
        F.col("text").alias("review_title"), F.col("text").alias("embed_text"), "embedding")


@query("vector_rows", f"""
SELECT sha256('doc-' || doc_id) AS review_id_pk, 1700000000::bigint AS event_ts, 'doc-' || doc_id AS review_id,
       source AS item_id, CASE WHEN lang <> 'de' THEN lang ELSE '' END AS user_id,
       CASE WHEN n_chars % 5 <> 0 THEN cast(n_chars % 5 AS varchar) || '.0' ELSE '0' END AS rating,
       md5(CASE WHEN strlen(text) <= 508 THEN text ELSE substr(text, 1, {TRUNCATED}) END) AS text_md5,
       md5(substr(text, 1, 500)) AS title_md5, round(coalesce(list_sum(embedding::double[]), 0.0), 6) AS vector_sum
FROM documents LEFT JOIN embeddings ON doc_id = vec_id""")
def vector_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = writers.vector_rows(document_vectors(spark, sf), 64, F.timestamp_seconds(F.lit(1_700_000_000)))
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return rows.select("review_id_pk", "event_ts", "review_id", "item_id", "user_id", "rating",
                       F.md5("embed_text").alias("text_md5"), F.md5("review_title").alias("title_md5"),
                       F.round(total, 6).alias("vector_sum"))


@query("vector_table_insert", """
SELECT source AS item_id, count(*) AS rows, 64::bigint * count(*) AS vector_values FROM documents GROUP BY source""")
def vector_table_insert(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "vectors")
    name = "vectors_" + path[-32:]
    writers.ensure_vector_table(spark, name, path)
    writers.insert_vectors(writers.vector_rows(document_vectors(spark, sf), 64), name)
    return spark.table(name).groupBy("item_id").agg(
        F.count("*").alias("rows"), F.sum(F.size("embedding")).alias("vector_values"))


@query("vector_rekey", """
SELECT 'doc-' || doc_id AS review_id, source AS item_id, cast(n_chars % 5 AS double) AS rating,
       1700000500::bigint AS event_s FROM documents""")
def vector_rekey(spark: SparkSession, sf: str) -> DataFrame:
    old = writers.vector_rows(document_vectors(spark, sf), 64)
    moved = writers.rekeyed_vectors(old, F.timestamp_seconds(F.lit(1_700_000_500)))
    return moved.select("review_id", "item_id", "rating", F.unix_seconds("event_timestamp").alias("event_s"))


# Normalisation and text


@query("processed_reviews", f"""
WITH {REVIEWS_SQL}
SELECT parent_asin AS item_id, user_id, count(*) AS reviews,
       cast(sum(timestamp // 1000) AS bigint) AS event_seconds FROM reviews
WHERE timestamp IS NOT NULL AND parent_asin IS NOT NULL AND user_id IS NOT NULL GROUP BY ALL""")
def processed_reviews(spark: SparkSession, sf: str) -> DataFrame:
    done = rv.processed_reviews(dt.reviews(spark, sf))
    return done.groupBy("item_id", "user_id").agg(
        F.count("*").alias("reviews"), F.sum(F.unix_seconds("event_timestamp")).alias("event_seconds"))


@query("event_time_kept_millis", """
SELECT event_id, (epoch_us(ts) // 1000) AS ms, strftime(make_timestamp_ms((epoch_us(ts) // 1000)), '%Y-%m-%d %H:%M:%S.%g') AS at FROM events""")
def event_time_kept_millis(spark: SparkSession, sf: str) -> DataFrame:
    at = dt.events(spark, sf).withColumn("at", rv.event_time_millis("ms"))
    return at.select("event_id", F.unix_millis("at").alias("ms"), F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSS").alias("at"))


@query("normalized_columns", """
SELECT cast(doc_id AS varchar) AS parent_asin, doc_id * 1000 AS timestamp, 0 AS helpful_vote,
       3 AS rating, 'Unknown Product' AS title, 'documents' AS category FROM documents""")
def normalized_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = dt.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("asin"), F.col("doc_id").alias("unixReviewTime"), "text")
    done = rv.ensure_text_columns(rv.normalize_reviews(raw))
    return done.select("parent_asin", "timestamp", "helpful_vote", "rating", "title",
                       F.regexp_extract("category", r"([a-z]+)\.parquet", 1).alias("category"))


@query("parsed_prices", """
SELECT event_id, try_cast(CASE WHEN event_type = 'view' THEN 'from ' || value ELSE cast(value AS varchar) END AS float) AS price
FROM events""")
def parsed_prices(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "view", F.concat(F.lit("from "), F.col("value"))).otherwise(F.col("value").cast("string"))
    return dt.table(spark, sf, "events").select("event_id", rv.price_as_float(text).alias("price"))


@query("cleaned_pages", """
SELECT page_id, length(c)::integer AS chars, md5(c) AS digest FROM (
  SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') AS c FROM pages)""")
def cleaned_pages(spark: SparkSession, sf: str) -> DataFrame:
    done = dt.table(spark, sf, "pages").withColumn("c", tx.clean_text("html"))
    return done.select("page_id", F.length("c").alias("chars"), F.md5("c").alias("digest"))


@query("embed_texts", """
SELECT doc_id, length(t)::integer AS chars, length(trim(t, ' '))::integer AS stripped_chars, md5(substr(t, 1, 500)) AS input_md5, md5(substr(t, 1, 511)) AS view_md5
FROM (SELECT doc_id, coalesce(lang, '') || ' ' || coalesce(text, '') AS t FROM documents) WHERE length(t) >= 20""")
def embed_texts(spark: SparkSession, sf: str) -> DataFrame:
    docs = dt.document_reviews(spark, sf).withColumns({"t": tx.embed_text(), "s": tx.embed_text(strip=True)})
    return docs.filter(F.length("t") >= tx.MIN_EMBED_CHARS).select(
        "doc_id", F.length("t").alias("chars"), F.length("s").alias("stripped_chars"),
        F.md5(tx.truncate_chars("t", tx.EMBED_INPUT_CHARS)).alias("input_md5"),
        F.md5(tx.truncate_chars("t", tx.VIEW_TEXT_CHARS)).alias("view_md5"))


@query("review_keys", f"""
WITH {REVIEWS_SQL}
SELECT id AS review_id, sha256(id) AS review_id_pk, count(*) AS reviews FROM (
  SELECT sha256(concat_ws('_', user_id, parent_asin, cast(timestamp AS varchar))) AS id FROM reviews) GROUP BY id""")
def review_keys(spark: SparkSession, sf: str) -> DataFrame:
    ids = dt.reviews(spark, sf).select(tx.review_id().alias("review_id"))
    return ids.groupBy("review_id").agg(F.count("*").alias("reviews")).withColumn("review_id_pk", tx.vector_key("review_id"))


@query("stars_and_labels", """
SELECT event_id, cast(trunc(value) AS integer) AS star, coalesce(try_cast(trunc(try_cast(t AS double)) AS integer), 3) AS text_star,
       CASE WHEN trunc(value) >= 4 THEN 'positive' WHEN trunc(value) <= 2 THEN 'negative' ELSE 'neutral' END AS sentiment,
       CASE WHEN value >= 4 THEN 1.0::double ELSE 0.0::double END AS label
FROM (SELECT *, CASE WHEN event_type = 'error' THEN event_type ELSE cast(value AS varchar) END AS t FROM events)""")
def stars_and_labels(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    star = tx.star_rating("value")
    return dt.table(spark, sf, "events").select(
        "event_id", star.alias("star"), tx.star_rating(text, is_text=True).alias("text_star"),
        tx.star_sentiment(star).alias("sentiment"), rv.positive_label("value").alias("label"))


@query("generated_text_sentiment", """
SELECT event_id, CASE WHEN lower(t) LIKE '%positive%' THEN 'positive' WHEN lower(t) LIKE '%negative%' THEN 'negative' ELSE 'neutral' END AS sentiment,
       CASE WHEN lower(t) LIKE '%positive%' THEN 'POSITIVE' WHEN lower(t) LIKE '%negative%' THEN 'NEGATIVE' ELSE 'MIXED' END AS shown
FROM (SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Very Positive.' WHEN 'error' THEN 'NEGATIVE tone' ELSE event_type END AS t FROM events)""")
def generated_text_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.when(kind == "purchase", "Very Positive.").when(kind == "error", "NEGATIVE tone").otherwise(kind)
    return dt.table(spark, sf, "events").select(
        "event_id", tx.text_sentiment(text).alias("sentiment"), tx.text_sentiment(text, "mixed", upper=True).alias("shown"))


EXAMPLES_SQL = f"""examples AS (
  SELECT doc_id, 'summary' AS kind, 'Product: ' || CASE WHEN length(title) > 0 THEN title ELSE 'Unknown' END || chr(10) || 'Review: ' || text AS input,
         cast(rating AS integer) AS star, CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS sentiment
  FROM cleaned WHERE length(text) >= 50
  UNION ALL
  SELECT doc_id, 'qa', 'Product: ' || CASE WHEN length(title) > 0 THEN title ELSE 'Unknown' END || chr(10) || 'Review (' || cast(rating AS integer) || '/5 stars): ' || text,
         cast(rating AS integer), NULL FROM cleaned WHERE length(text) >= 100)"""


@query("instruction_examples", f"""
WITH {DOC_REVIEWS_SQL}, {CLEAN_SQL}, {EXAMPLES_SQL}
SELECT kind, md5(input) AS input_md5, star, sentiment, '' AS output, count(*) AS rows FROM examples GROUP BY ALL""")
def instruction_examples(spark: SparkSession, sf: str) -> DataFrame:
    lines = jobs.instruction_examples(jobs.clean_reviews(dt.document_reviews(spark, sf)))
    parsed = lines.select(F.from_json("jsonl", tx.EXAMPLE_SCHEMA).alias("e"))
    kind = F.when(F.col("e.instruction") == tx.SUMMARY_INSTRUCTION, "summary").otherwise("qa")
    return parsed.groupBy(kind.alias("kind"), F.md5("e.input").alias("input_md5"), F.col("e.metadata.rating").alias("star"),
                          F.col("e.metadata.sentiment").alias("sentiment"), F.col("e.output").alias("output")).agg(F.count("*").alias("rows"))


@query("text_job_read_back", f"""
WITH {DOC_REVIEWS_SQL}, {CLEAN_SQL}, {EXAMPLES_SQL}
SELECT md5('[INST] ' || CASE kind WHEN 'summary' THEN '{tx.SUMMARY_INSTRUCTION}' ELSE '{tx.QA_INSTRUCTION}' END
       || chr(10) || chr(10) || input || ' [/INST]') AS prompt_md5, count(*) AS rows FROM examples GROUP BY ALL""")
def text_job_read_back(spark: SparkSession, sf: str) -> DataFrame:
    raw, out = scratch_path(spark, "docs"), scratch_path(spark, "text")
    dt.document_reviews(spark, sf).write.parquet(raw)
    jobs.text_job(spark, raw, out)
    parts = [readers.read_training_split(spark, out, name, max_files=None) for name in ("train", "val", "test")]
    lines = parts[0].unionByName(parts[1]).unionByName(parts[2])
    prompt = tx.chat_prompt(F.struct("instruction", "input", "output"))
    return lines.groupBy(F.md5(prompt).alias("prompt_md5")).agg(F.count("*").alias("rows"))


@query("chat_and_summary_prompts", f"""
SELECT conv_id, turn, md5('[INST] ' || role || CASE WHEN length(text) > 0 THEN chr(10) || chr(10) || text ELSE '' END || ' [/INST]'
       || CASE WHEN turn % 2 = 1 THEN ' ' || role ELSE '' END) AS chat_md5,
       md5('[INST] {tx.SUMMARY_INSTRUCTION}' || chr(10) || chr(10) || 'Product: ' || role || chr(10) || 'Review: ' || text || ' [/INST]') AS summary_md5
FROM conversations""")
def chat_and_summary_prompts(spark: SparkSession, sf: str) -> DataFrame:
    turns = dt.table(spark, sf, "conversations")
    example = F.struct(F.col("role").alias("instruction"), F.col("text").alias("input"),
                       F.when(F.col("turn") % 2 == 1, F.col("role")).otherwise("").alias("output"))
    return turns.select("conv_id", "turn", F.md5(tx.chat_prompt(example)).alias("chat_md5"),
                        F.md5(tx.summary_prompt("role", "text")).alias("summary_md5"))


@query("guessed_categories", """
SELECT category, count(*) AS items FROM (
  SELECT CASE WHEN i LIKE 'B09%' OR i LIKE 'B08%' OR i LIKE 'B07%' THEN 'Electronics' WHEN i LIKE 'B01%' THEN 'Gadgets & Accessories'
    WHEN i LIKE 'B00%' THEN 'Home & Kitchen' WHEN i LIKE 'B0%' THEN 'Electronics' WHEN i LIKE '19%' THEN 'Books — Non-Fiction'
    WHEN i LIKE '05%' THEN 'Books — Reference' WHEN i LIKE '03%' THEN 'Books — Fiction' WHEN i LIKE '0%' THEN 'Books'
    WHEN i LIKE '1%' THEN 'Books' ELSE 'General' END AS category
  FROM (SELECT unnest([lpad(cast(p_partkey AS varchar), 4, '0'), 'B0' || lpad(cast(p_partkey AS varchar), 4, '0'), cast(p_partkey AS varchar)]) AS i FROM part)) GROUP BY category""")
def guessed_categories(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("p_partkey").cast("string")
    padded = F.lpad(number, 4, "0")
    ids = dt.table(spark, sf, "part").select(F.explode(F.array(padded, F.concat(F.lit("B0"), padded), number)).alias("item_id"))
    return ids.groupBy(category_of("item_id").alias("category")).agg(F.count("*").alias("items"))


@query("token_counts", """
SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'),
       lambda x: x <> ''))::integer AS tokens FROM documents""")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return dt.table(spark, sf, "documents").select("doc_id", tx.token_count("text").alias("tokens"))


# Features


@query("user_features", f"""
WITH {REVIEWS_SQL}, {USERS_SQL}
SELECT user_id, round(user_avg_rating, 6) AS user_avg_rating, user_review_count, user_unique_items,
       round(user_avg_review_length, 6) AS user_avg_review_length, user_category_count, user_tenure_days, last_ms FROM user_features""")
def user_features(spark: SparkSession, sf: str) -> DataFrame:
    made = ft.user_features(dt.reviews(spark, sf)).withColumns(r6("user_avg_rating", "user_avg_review_length"))
    return made.select("user_id", *ft.USER_FEATURES, F.unix_millis("event_timestamp").alias("last_ms"))


@query("item_features", f"""
WITH {REVIEWS_SQL}, {ITEMS_SQL}
SELECT item_id, round(item_avg_rating, 6) AS item_avg_rating, round(item_rating_stddev, 6) AS item_rating_stddev, item_review_count,
       item_total_helpful_votes, round(item_avg_review_length, 6) AS item_avg_review_length, item_price, last_ms FROM item_features""")
def item_features(spark: SparkSession, sf: str) -> DataFrame:
    made = ft.item_features(dt.reviews(spark, sf), dt.metadata(spark, sf))
    made = made.withColumns(r6("item_avg_rating", "item_rating_stddev", "item_avg_review_length"))
    return made.select("item_id", *ft.ITEM_FEATURES, F.unix_millis("event_timestamp").alias("last_ms"))


@query("interactions", f"""
WITH {REVIEWS_SQL}
SELECT user_id, parent_asin AS item_id, rating, timestamp AS event_timestamp, CASE WHEN rating >= 4 THEN 1.0::double ELSE 0.0::double END AS label FROM reviews""")
def interactions(spark: SparkSession, sf: str) -> DataFrame:
    return ft.interactions(dt.reviews(spark, sf))


@query("class_balance", f"""
WITH {REVIEWS_SQL}
SELECT count(*) AS rows, sum(l) AS positives, round(avg(l), 6) AS positive_rate
FROM (SELECT CASE WHEN rating >= 4 THEN 1.0::double ELSE 0.0::double END AS l FROM reviews)""")
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return ft.class_balance(ft.interactions(dt.reviews(spark, sf))).withColumns(r6("positive_rate"))


# Joins


@query("current_feature_join", f"""
WITH {REVIEWS_SQL}, {USERS_SQL}, {ITEMS_SQL}
SELECT r.user_id, r.parent_asin AS item_id, r.timestamp AS event_timestamp, r.rating,
       round(coalesce(user_avg_rating, 0), 6) AS user_avg_rating, coalesce(user_unique_items, 0) AS user_unique_items,
       round(coalesce(item_rating_stddev, 0), 6) AS item_rating_stddev, coalesce(item_total_helpful_votes, 0) AS item_total_helpful_votes
FROM reviews r LEFT JOIN user_features u USING (user_id) LEFT JOIN item_features i ON i.item_id = r.parent_asin""")
def current_feature_join(spark: SparkSession, sf: str) -> DataFrame:
    reviews = written(ft.narrow_reviews(dt.reviews(spark, sf)), "reviews")
    joined = joins.join_features(ft.interactions(reviews), ft.user_features(reviews), ft.item_features(reviews, dt.metadata(spark, sf)),
                                 unique=True)
    return joined.withColumns(r6("user_avg_rating", "item_rating_stddev")).select(
        "user_id", "item_id", "event_timestamp", "rating", "user_avg_rating", "user_unique_items", "item_rating_stddev",
        "item_total_helpful_votes")


ASOF_SQL = """
SELECT e.event_id, e.user_id, CASE WHEN f.ts > e.ts - INTERVAL {ttl} THEN f.value END AS last_value,
       CASE WHEN f.ts > e.ts - INTERVAL {ttl} THEN (epoch_us(f.ts) // 1000) END AS feature_ms
FROM (SELECT * FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL) f
ON e.user_id = f.user_id AND e.ts >= f.ts"""


def last_view(spark: SparkSession, sf: str, ttl: timedelta, **options) -> DataFrame:
    rows = dt.events(spark, sf)
    bought = rows.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    seen = rows.filter(F.col("event_type") == "view").select("user_id", "ts", F.col("value").alias("last_value"))
    found = asof_join(bought, seen, "user_id", ["last_value"], entity_time="ts", feature_time="ts", ttl=ttl,
                      matched_time="feature_ts", **options)
    return found.select("event_id", "user_id", "last_value", F.unix_millis("feature_ts").alias("feature_ms"))


@query("point_in_time_join", ASOF_SQL.format(ttl="3 DAY"))
def point_in_time_join(spark: SparkSession, sf: str) -> DataFrame:
    return last_view(spark, sf, timedelta(days=3))


@query("point_in_time_join_hot_keys", ASOF_SQL.format(ttl="2 DAY"))
def point_in_time_join_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    return last_view(spark, sf, timedelta(days=2), hot_rows=25, chunks=8)


@query("user_index", f"WITH {REVIEWS_SQL} SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM reviews)")
def user_index(spark: SparkSession, sf: str) -> DataFrame:
    return dense_index(dt.reviews(spark, sf), "user_id", "user_idx")


@query("indexed_interactions", f"""
WITH {REVIEWS_SQL}, u AS (SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM reviews)),
i AS (SELECT parent_asin, dense_rank() OVER (ORDER BY parent_asin) - 1 AS item_idx FROM (SELECT DISTINCT parent_asin FROM reviews))
SELECT user_idx, item_idx, user_id, parent_asin AS item_id, count(*) AS reviews FROM reviews JOIN u USING (user_id) JOIN i USING (parent_asin) GROUP BY ALL""")
def indexed_interactions(spark: SparkSession, sf: str) -> DataFrame:
    indexed, users, items = index_tables(spark, sf)
    pairs = indexed.groupBy("user_idx", "item_idx").agg(F.count("*").alias("reviews"))
    return joins.restore_ids(pairs, users, items)


def index_tables(spark: SparkSession, sf: str, columns: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Indexed interactions, users and items; with ``columns`` the interactions are written with these only, and what they come from goes."""
    pairs = written(ft.interactions(dt.reviews(spark, sf)), "interactions")
    users, items = dense_index(pairs, "user_id", "user_idx"), dense_index(pairs, "item_id", "item_idx")
    indexed = joins.index_interactions(pairs, users, items)
    if columns:
        indexed = written(indexed.select(*columns), "indexed")
        discard(pairs)
    return indexed, users, items


# Dedup


@query("distinct_reviews", f"""
WITH {REVIEWS_SQL}
SELECT user_id, text, parent_asin, timestamp, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, text ORDER BY timestamp, parent_asin, category, helpful_vote, rating, title) AS rn FROM reviews) WHERE rn = 1""")
def distinct_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.distinct_reviews(dt.reviews(spark, sf)).select("user_id", "text", "parent_asin", "timestamp", "rating")


@query("first_event_per_user", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.one_per_key(dt.events(spark, sf), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("latest_event_per_user", """
SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_per_key(dt.events(spark, sf), ["user_id"], "ts", ties=["event_id"]).select("user_id", "event_id", "value")


# Caps, samples, splits


@query("capped_documents", "SELECT doc_id, lang FROM documents ORDER BY md5(cast(doc_id AS varchar)), doc_id LIMIT 120")
def capped_documents(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.cap_and_spread(dt.table(spark, sf, "documents"), 120, ("doc_id",), partitions=8).select("doc_id", "lang")


@query("sampled_documents", "SELECT doc_id, source FROM documents ORDER BY md5('42_' || doc_id), doc_id LIMIT 150")
def sampled_documents(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_exact(dt.table(spark, sf, "documents"), 150, ("doc_id",)).select("doc_id", "source")


@query("quick_training_subset", "SELECT doc_id FROM documents ORDER BY md5(cast(doc_id AS varchar)), doc_id LIMIT 200")
def quick_training_subset(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.quick_subset(dt.table(spark, sf, "documents"), "val", ("doc_id",)).select("doc_id")


@query("document_splits", f"""
SELECT doc_id, CASE WHEN h < 9000 THEN 'train' WHEN h < 9500 THEN 'val' ELSE 'test' END AS split
FROM (SELECT doc_id, {hex_number('cast(doc_id AS varchar)')} % 10000 AS h FROM documents)""")
def document_splits(spark: SparkSession, sf: str) -> DataFrame:
    return dt.table(spark, sf, "documents").select("doc_id", sampling.split_label(F.col("doc_id"), sampling.example_shares()).alias("split"))


@query("interaction_splits", f"""
WITH {REVIEWS_SQL}
SELECT split, count(*) AS rows, sum(rating) AS rating_sum FROM (
  SELECT rating, CASE WHEN {hex_number("concat_ws('_', user_id, parent_asin, cast(timestamp AS varchar))")} % 10000 < 9000 THEN 'train' ELSE 'val' END AS split
  FROM reviews) GROUP BY split""")
def interaction_splits(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat_ws("_", "user_id", "item_id", F.col("event_timestamp").cast("string"))
    pairs = ft.interactions(dt.reviews(spark, sf)).withColumn("split", sampling.split_label(key, sampling.INTERACTION_SHARES))
    return pairs.groupBy("split").agg(F.count("*").alias("rows"), F.sum("rating").alias("rating_sum"))


def _samples_sql(where: str) -> str:
    key = "user_id, item_id, cast(event_timestamp AS varchar)"
    return f"""
WITH {REVIEWS_SQL}, n AS (SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT parent_asin) AS n_items FROM reviews),
pairs AS (SELECT user_id, parent_asin AS item_id, timestamp AS event_timestamp, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx,
  dense_rank() OVER (ORDER BY parent_asin) - 1 AS item_idx, CASE WHEN rating >= 4 THEN 1.0::double ELSE 0.0::double END AS label FROM reviews),
drawn AS (SELECT {hex_number(f"concat_ws('_', '42', cast(d AS varchar), {key}, 'user')")} % n_users AS user_idx,
  {hex_number(f"concat_ws('_', '42', cast(d AS varchar), {key}, 'item')")} % n_items AS item_idx, 0.0::double AS label
  FROM (SELECT *, unnest([1, 2, 3]) AS d FROM pairs), n)
SELECT user_idx, item_idx, label, count(*) AS rows FROM (
  SELECT user_idx, item_idx, label FROM pairs UNION ALL SELECT * FROM drawn {where}) GROUP BY ALL"""


def _samples(spark: SparkSession, sf: str, exclude_seen: bool) -> DataFrame:
    indexed, users, items = index_tables(spark, sf)
    made = sampling.training_samples(indexed, users.count(), items.count(), ("user_id", "item_id", "event_timestamp"),
                                     exclude_seen=exclude_seen)
    return made.groupBy("user_idx", "item_idx", "label").agg(F.count("*").alias("rows"))


@query("training_samples", _samples_sql(""))
def training_samples(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf, exclude_seen=False)


@query("training_samples_unseen", _samples_sql("WHERE (user_idx, item_idx) NOT IN (SELECT (user_idx, item_idx) FROM pairs)"))
def training_samples_unseen(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf, exclude_seen=True)


# Feature store

MIDDLE, END = datetime(2024, 1, 15), datetime(2024, 1, 31)
START = datetime(2024, 1, 1)


def event_view(spark: SparkSession, sf: str, ttl: timedelta | None = timedelta(days=3650), by_count: bool = False) -> FeatureView:
    """Latest event value per user, or running totals per user computed from raw events."""
    def load(session: SparkSession) -> DataFrame:
        return dt.events(session, sf).withColumn("event_timestamp", F.col("ts"))

    user = Entity("user_id", dtype=T.LongType())
    source = Source("events", loader=load, created_field="event_id", millis_field="ms")
    if not by_count:
        return FeatureView("last_event", (user,), (("event_type", T.StringType()), ("value", T.DoubleType())), source, ttl)

    def totals(df: DataFrame) -> DataFrame:
        return df.groupBy("user_id").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"),
                                         F.max("event_timestamp").alias("event_timestamp"))

    return FeatureView("event_totals", (user,), (("events", T.LongType()), ("total", T.DoubleType())), source, ttl, totals)


def event_store(spark: SparkSession, view: FeatureView) -> FeatureStore:
    store = FeatureStore(spark, scratch_path(spark, "store"), buckets=4)
    store.apply([view])
    return store


@query("interval_and_ttl_filter", """
SELECT event_id, event_type FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND ts >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY""")
def interval_and_ttl_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = within(dt.events(spark, sf), "ts", datetime(2024, 1, 5), datetime(2024, 1, 20))
    return alive(rows, "ts", timedelta(days=20), END).select("event_id", "event_type")


LATEST_SQL = """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, (epoch_us(max(ts)) // 1000) AS ms
FROM events WHERE {where} GROUP BY user_id"""


def online_rows(store: FeatureStore, view: FeatureView) -> DataFrame:
    return store.online_table(view.name).select("user_id", *view.features, F.unix_millis("event_timestamp").alias("ms"))


@query("materialized_view", LATEST_SQL.format(where="ts <= TIMESTAMP '2024-01-15' AND ts >= TIMESTAMP '2024-01-14'"))
def materialized_view(spark: SparkSession, sf: str) -> DataFrame:
    view = event_view(spark, sf, ttl=timedelta(days=1))
    store = event_store(spark, view)
    store.materialize(START, MIDDLE, as_of=MIDDLE)
    return online_rows(store, view)


TOTALS_SQL = "SELECT user_id, count(*) AS events, round(sum(value), 4) AS total, (epoch_us(max(ts)) // 1000) AS ms FROM events GROUP BY user_id"


@query("incremental_recompute", TOTALS_SQL)
def incremental_recompute(spark: SparkSession, sf: str) -> DataFrame:
    view = event_view(spark, sf, by_count=True)
    store = event_store(spark, view)
    store.materialize(START, MIDDLE)
    store.materialize_incremental(END)
    return online_rows(store, view)


@query("incremental_interval", """
SELECT user_id, count(*) AS events, round(sum(value), 4) AS total, (epoch_us(max(ts)) // 1000) AS ms FROM (
  SELECT *, max(ts) OVER (PARTITION BY user_id) > TIMESTAMP '2024-01-15' AS fresh FROM events)
WHERE NOT fresh OR ts >= TIMESTAMP '2024-01-15' GROUP BY user_id""")
def incremental_interval(spark: SparkSession, sf: str) -> DataFrame:
    view = event_view(spark, sf, by_count=True)
    store = event_store(spark, view)
    store.materialize(START, MIDDLE)
    store.materialize_incremental(END, mode="interval")
    return online_rows(store, view)


@query("incremental_stream", LATEST_SQL.format(where="true"))
def incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    view = event_view(spark, sf)
    files = Source("files", path=f"{sf}/events.parquet", timestamp_field="ts", created_field="event_id")
    store = event_store(spark, FeatureView(view.name, view.entities, view.schema, files, view.ttl))
    schema = dt.table(spark, sf, "events").schema
    materialize_new_files(store, view.name, sf, schema, scratch_path(spark, "stream"), "events.parquet", as_of=END)
    return store.online_table(view.name).select("user_id", *view.features, F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))


@query("online_lookup", """
SELECT c_custkey AS user_id, e.event_type, e.value FROM customer LEFT JOIN (
  SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id) e
ON e.user_id = c_custkey""")
def online_lookup(spark: SparkSession, sf: str) -> DataFrame:
    view = event_view(spark, sf)
    store = event_store(spark, view)
    store.materialize(START, END)
    asked = dt.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return store.get_online_features(["last_event:event_type", "last_event:value"], asked)


def review_store(spark: SparkSession, reviews: DataFrame) -> FeatureStore:
    """Both feature views computed from raw reviews."""
    store = FeatureStore(spark, scratch_path(spark, "store"))
    source = Source("raw_reviews", loader=lambda session: reviews, millis_field="timestamp")
    store.apply(raw_views(source))
    return store


TRAINING_SQL = f"""
WITH {REVIEWS_SQL}, {USERS_SQL}, {ITEMS_SQL}, training AS (
SELECT r.user_id, r.parent_asin AS item_id, r.timestamp AS ms, CASE WHEN r.rating >= 4 THEN 1.0::double ELSE 0.0::double END AS label,
  CASE WHEN u.last_ms <= r.timestamp THEN u.user_avg_rating END AS user_avg_rating,
  CASE WHEN u.last_ms <= r.timestamp THEN u.user_review_count END AS user_review_count,
  CASE WHEN i.last_ms <= r.timestamp THEN i.item_rating_stddev END AS item_rating_stddev,
  CASE WHEN i.last_ms <= r.timestamp THEN i.item_review_count END AS item_review_count
FROM reviews r LEFT JOIN user_features u USING (user_id) LEFT JOIN item_features i ON i.item_id = r.parent_asin)"""


@query("training_set", TRAINING_SQL + """
SELECT user_id, item_id, ms, label, round(coalesce(user_avg_rating, 0), 6) AS user_avg_rating, coalesce(user_review_count, 0) AS user_review_count,
       round(coalesce(item_rating_stddev, 0), 6) AS item_rating_stddev, coalesce(item_review_count, 0) AS item_review_count FROM training""")
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    reviews = written(ft.narrow_reviews(dt.reviews(spark, sf)), "reviews")
    rows = jobs.training_set(review_store(spark, reviews), ft.interactions(reviews))
    return rows.withColumns(r6("user_avg_rating", "item_rating_stddev")).select(
        "user_id", "item_id", F.unix_millis("event_timestamp").alias("ms"), "label", "user_avg_rating", "user_review_count",
        "item_rating_stddev", "item_review_count")


def _null_rates_sql() -> str:
    """Point-in-time features of every review, left as they are, and the null rate of each of the twelve."""
    users = ", ".join(f"u.{c}" for c in ft.USER_FEATURES)
    items = ", ".join(f"i.{c}" for c in ft.ITEM_FEATURES if c != "item_price")
    rates = " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg(({c} IS NULL)::integer), 6) AS null_rate FROM joined"
                               for c in ft.USER_FEATURES + ft.ITEM_FEATURES)
    return f"""
WITH {REVIEWS_SQL}, {USERS_SQL}, {ITEMS_SQL}, joined AS (
  SELECT r.user_id, r.parent_asin AS item_id, CASE WHEN r.rating >= 4 THEN 1.0::double ELSE 0.0::double END AS label,
         {users}, {items}, NULL::float AS item_price
  FROM reviews r LEFT JOIN user_features u ON u.user_id = r.user_id AND u.last_ms <= r.timestamp
  LEFT JOIN item_features i ON i.item_id = r.parent_asin AND i.last_ms <= r.timestamp)
SELECT s.*, feature, null_rate, null_rate > 0.05 AS flagged FROM (
  SELECT count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, round(avg(label), 6) AS positive_rate FROM joined) s,
 ({rates}) f"""


@query("training_summary", _null_rates_sql())
def training_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All twelve features as they were at each review; prices are null, for the views are computed without metadata."""
    reviews = written(ft.narrow_reviews(dt.reviews(spark, sf)), "reviews")
    entities = ft.labelled_interactions(ft.interactions(reviews)).select("user_id", "item_id", "event_timestamp", "label")
    joined = review_store(spark, reviews).get_historical_features(entities, TRAINING_FEATURES)
    return ft.dataset_summary(joined).withColumns(r6("positive_rate", "null_rate"))
