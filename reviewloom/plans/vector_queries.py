"""Queries: vectors, retrieval, recommendation, evaluation and service metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.functions import vectors as vec
from reviewloom.operators import evaluation, ivf, joins, recommend, retrieval, sampling
from reviewloom.operators import features as ft
from reviewloom.operators import timeseries as ts
from reviewloom.operators.aggregates import mean_vectors, request_stats
from reviewloom.operators.encode import embed_column, hashing_encoder
from reviewloom.operators.pruned import pruned_top_k
from reviewloom.operators.topk import top_k
from reviewloom.plans.catalogue import REVIEWS_SQL, query
from reviewloom.plans.review_queries import index_tables
from reviewloom.session import scratch_path, spread, written
from reviewloom.sources import driver_tables as dt
from reviewloom.store.vector_index import VectorIndex

MEANS_SQL = """means AS (
  SELECT label, list(m ORDER BY pos) AS mean FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, unnest(embedding::double[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL) GROUP BY label)"""

HITS_SQL = """hits AS (
  SELECT * FROM (SELECT m.label AS query_id, e.vec_id, e.label, round(list_cosine_similarity(m.mean, e.embedding::double[]), 9) AS score,
    row_number() OVER (PARTITION BY m.label ORDER BY round(list_cosine_similarity(m.mean, e.embedding::double[]), 9) DESC, e.vec_id) AS rank
  FROM means m, embeddings e) WHERE rank <= {k})"""


def label_questions(spark: SparkSession, sf: str) -> DataFrame:
    """One question per label: the mean vector of the label."""
    means = mean_vectors(dt.table(spark, sf, "embeddings"), "label", out="query_vec")
    return means.select(F.col("label").cast("bigint").alias("query_id"), "query_vec")


def vector_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Embedding rows with the attributes of the document of equal number."""
    vectors, docs = dt.table(spark, sf, "embeddings"), dt.table(spark, sf, "documents")
    return vectors.join(docs, vectors.vec_id == docs.doc_id, "left").select(
        F.col("vec_id").alias("review_id"), F.col("label").cast("string").alias("item_id"), F.pmod("n_chars", F.lit(5)).alias("rating"),
        F.col("source").alias("review_title"), F.col("text").alias("embed_text"), "embedding")


@query("mean_item_vectors", f"""
WITH {MEANS_SQL} SELECT label, unnest(range(0, 64))::integer AS pos, unnest(list_transform(mean, lambda x: round(x, 6))) AS value FROM means""")
def mean_item_vectors(spark: SparkSession, sf: str) -> DataFrame:
    means = mean_vectors(dt.table(spark, sf, "embeddings"), "label", out="mean")
    return means.select("label", F.posexplode("mean").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query("item_vector_join", f"""
WITH {MEANS_SQL} SELECT l.doc_id, l.quality, round(m.mean[1], 6) AS first_value, len(m.mean)::integer AS dim, count(m.mean) OVER () AS matched, count(*) OVER () AS rows
FROM labels l LEFT JOIN means m ON m.label = l.doc_id""")
def item_vector_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = dt.table(spark, sf, "labels").withColumn("item_id", F.col("doc_id"))
    vectors = mean_vectors(dt.table(spark, sf, "embeddings").withColumn("item_id", F.col("label").cast("bigint")))
    joined = joins.join_item_vectors(rows, vectors)
    report = joins.match_report(joined).first()
    return joined.select("doc_id", "quality", F.round(F.get("item_embedding_avg", F.lit(0)), 6).alias("first_value"),
                         F.when(F.col("item_embedding_avg").isNotNull(), F.size("item_embedding_avg")).alias("dim"),
                         F.lit(report["matched"]).cast("bigint").alias("matched"), F.lit(report["rows"]).cast("bigint").alias("rows"))


@query("unit_vectors", """
SELECT vec_id, unnest(range(0, 64))::integer AS pos, unnest(list_transform(v, lambda x: round(x / sqrt(list_sum(list_transform(v, lambda y: y * y))), 6))) AS value
FROM (SELECT vec_id, embedding::double[] AS v FROM embeddings)""")
def unit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    unit = dt.table(spark, sf, "embeddings").select("vec_id", vec.l2_normalize("embedding").alias("u"))
    return unit.select("vec_id", F.posexplode("u").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query("zero_vector_defaults", """
SELECT doc_id, len(coalesce(embedding, list_transform(range(0, 64), lambda x: 0.0::float)))::integer AS dim,
       round(list_sum(coalesce(embedding::double[], list_transform(range(0, 64), lambda x: 0.0::double))), 6) AS total
FROM documents LEFT JOIN embeddings ON doc_id = vec_id""")
def zero_vector_defaults(spark: SparkSession, sf: str) -> DataFrame:
    docs, vectors = dt.table(spark, sf, "documents"), dt.table(spark, sf, "embeddings")
    filled = docs.join(vectors, docs.doc_id == vectors.vec_id, "left").withColumn("v", vec.or_zero_vector("embedding", 64))
    total = F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return filled.select("doc_id", F.size("v").alias("dim"), F.round(total, 6).alias("total"))


@query("label_cosine", f"""
WITH {MEANS_SQL} SELECT vec_id, round(list_cosine_similarity(m.mean, e.embedding::double[]), 6) AS cosine FROM embeddings e JOIN means m USING (label)""")
def label_cosine(spark: SparkSession, sf: str) -> DataFrame:
    rows = dt.table(spark, sf, "embeddings")
    return rows.join(mean_vectors(rows, "label", out="mean"), "label").select("vec_id", F.round(vec.cosine("mean", "embedding"), 6).alias("cosine"))


@query("similar_vectors", f"""
WITH {MEANS_SQL}, {HITS_SQL.format(k=5)} SELECT query_id::bigint AS query_id, vec_id AS vector_id, round(score, 6) AS score, rank::integer AS rank FROM hits""")
def similar_vectors(spark: SparkSession, sf: str) -> DataFrame:
    found = top_k(label_questions(spark, sf), dt.table(spark, sf, "embeddings"), 5, vector_id="vec_id")
    return found.select("query_id", "vector_id", F.round("score", 6).alias("score"), "rank")


@query("similar_vectors_in_blocks", """
SELECT query_id, vector_id, round(score, 6) AS score, rank::integer AS rank FROM (
  SELECT q.vec_id AS query_id, e.vec_id AS vector_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 9) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 9) DESC, e.vec_id) AS rank
  FROM embeddings q, embeddings e) WHERE rank <= 3""")
def similar_vectors_in_blocks(spark: SparkSession, sf: str) -> DataFrame:
    rows = dt.table(spark, sf, "embeddings")
    asked = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    found = top_k(asked, rows, 3, vector_id="vec_id", few_queries=64, block_queries=256, block_vectors=512)
    return found.select("query_id", "vector_id", F.round("score", 6).alias("score"), "rank")


@query("clustered_similar_vectors", f"""
WITH {MEANS_SQL}, {HITS_SQL.format(k=5)} SELECT query_id::bigint AS query_id, vec_id AS vector_id, round(score, 6) AS score, rank::integer AS rank FROM hits""")
def clustered_similar_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """With every cluster probed the clustered search is exact."""
    rows = dt.table(spark, sf, "embeddings")
    model = ivf.fit_clusters(rows, n_list=8)
    found = ivf.approximate_top_k(label_questions(spark, sf), ivf.assign_clusters(model, rows), model, 5, nprobe=8, vector_id="vec_id")
    return found.select("query_id", "vector_id", F.round("score", 6).alias("score"), "rank")


def twentieth(rows: DataFrame) -> DataFrame:
    """Every vector whose id is divisible by twenty, as a query."""
    return rows.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))


# A stored vector finds itself first; the other columns state checks of what was found.
@query("approximate_similar_vectors", """
SELECT vec_id AS query_id, vec_id AS first_id, least(5, (SELECT count(*) FROM embeddings)) AS hits, true AS scores_agree, true AS in_order, true AS recall_reached
FROM embeddings WHERE vec_id % 20 = 0""")
def approximate_similar_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every twentieth vector asks the stored index; recall is measured on a bounded number of the queries by brute force."""
    rows = dt.table(spark, sf, "embeddings")
    index = VectorIndex(spark, scratch_path(spark, "index"), vector_id="vec_id")
    index.build(rows, n_list=16, k=5)
    asked = twentieth(rows)
    found = index.search(asked, 5)
    both = (found.join(asked, "query_id").join(rows.select(F.col("vec_id").alias("vector_id"), "embedding"), "vector_id")
                 .withColumn("_true", vec.cosine("query_vec", "embedding")))
    listed = F.array_sort(F.collect_list(F.struct("rank", "score", "vector_id")))
    per_query = both.groupBy("query_id").agg(listed.alias("_hits"), F.max(F.abs(F.col("_true") - F.col("score"))).alias("_off"))
    return per_query.select(
        "query_id", F.col("_hits")[0]["vector_id"].alias("first_id"), F.size("_hits").cast("bigint").alias("hits"), (F.col("_off") < 1e-8).alias("scores_agree"),
        (F.sort_array("_hits.score", asc=False) == F.col("_hits.score")).alias("in_order"),
        F.lit(index.measured(asked, 5) >= 0.9).alias("recall_reached"))


@query("vector_index_appended", """
SELECT query_id, vector_id, round(score, 6) AS score, rank::integer AS rank FROM (
  SELECT q.vec_id AS query_id, e.vec_id AS vector_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 9) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 9) DESC, e.vec_id) AS rank
  FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0) WHERE rank <= 5""")
def vector_index_appended(spark: SparkSession, sf: str) -> DataFrame:
    """An index of two thirds of the vectors, the rest added in two batches; with all clusters probed the search is exact."""
    rows = dt.table(spark, sf, "embeddings")
    index = VectorIndex(spark, scratch_path(spark, "index"), vector_id="vec_id")
    third = F.pmod(F.col("vec_id"), F.lit(6))
    index.build(rows.filter(third < 4), n_list=12)
    for part in (4, 5):
        index.append(rows.filter(third == part))
    found = index.search(twentieth(rows), 5, nprobe=12)
    return found.select("query_id", "vector_id", F.round("score", 6).alias("score"), "rank")


def product_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Label questions; in turn they ask for no product, their own label and the next label."""
    asked, turn = label_questions(spark, sf), F.col("query_id") % 3
    product = F.when(turn == 0, "").otherwise((F.col("query_id") + turn - 1).cast("string"))
    return asked.withColumn("product_id", product)


WANTED_SQL = f"""
WITH {MEANS_SQL}, {HITS_SQL.format(k=5)}, marked AS (
  SELECT *, query_id % 3 <> 0 AND label = query_id + query_id % 3 - 1 AS match FROM hits),
kept AS (SELECT * FROM (SELECT *, count(*) FILTER (match) OVER (PARTITION BY query_id) AS n FROM marked) WHERE match OR n = 0)"""


@query("product_hits", WANTED_SQL + "SELECT query_id::bigint AS query_id, vec_id AS review_id, label::varchar AS item_id, rank::integer AS rank FROM kept")
def product_hits(spark: SparkSession, sf: str) -> DataFrame:
    found = retrieval.search_reviews(product_questions(spark, sf), vector_reviews(spark, sf), 5)
    return found.select("query_id", "review_id", "item_id", "rank")


@query("product_hits_prefiltered", f"""
WITH {MEANS_SQL} SELECT query_id, review_id, item_id, rank::integer AS rank FROM (
  SELECT m.label::bigint AS query_id, e.vec_id AS review_id, e.label::varchar AS item_id,
    row_number() OVER (PARTITION BY m.label ORDER BY round(list_cosine_similarity(m.mean, e.embedding::double[]), 9) DESC, e.vec_id) AS rank
  FROM means m JOIN embeddings e USING (label)) WHERE rank <= 5""")
def product_hits_prefiltered(spark: SparkSession, sf: str) -> DataFrame:
    asked = label_questions(spark, sf).withColumn("product_id", F.col("query_id").cast("string"))
    found = retrieval.search_reviews(asked, vector_reviews(spark, sf), 5, prefilter=True)
    return found.select("query_id", "review_id", "item_id", "rank")


@query("answer_prompts", WANTED_SQL + f""", lines AS (
  SELECT query_id, pos, 'Review ' || pos || ' (' || coalesce(cast(n_chars % 5 AS varchar), '?') || '/5 stars)'
    || CASE WHEN length(source) > 0 THEN ' — ' || substr(source, 1, 60) ELSE '' END || ': ' || substr(coalesce(text, ''), 1, 500) AS line
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS pos FROM kept) LEFT JOIN documents ON doc_id = vec_id),
blocks AS (SELECT query_id, string_agg(line, chr(10) || chr(10) ORDER BY pos) AS context FROM lines GROUP BY query_id)
SELECT query_id::bigint AS query_id, md5(context) AS context_md5, md5('[INST] {retrieval.ANSWER_INSTRUCTION.replace("'", "''")}' || chr(10) || chr(10) || 'Reviews:' || chr(10) || context
  || chr(10) || chr(10) || 'Question: What about ' || query_id || '? [/INST]') AS prompt_md5 FROM blocks""")
def answer_prompts(spark: SparkSession, sf: str) -> DataFrame:
    asked = product_questions(spark, sf)
    question = F.concat(F.lit("What about "), F.col("query_id").cast("string"), F.lit("?"))
    blocks = retrieval.context_blocks(asked.withColumn("question", question), retrieval.search_reviews(asked, vector_reviews(spark, sf), 5))
    return blocks.select("query_id", F.md5("context").alias("context_md5"),
                         F.md5(retrieval.answer_prompt("question", "context")).alias("prompt_md5"))


TOKENS = r"""len(list_filter(regexp_split_to_array(text, '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda x: x <> ''))"""


# The built-in encoder gives unit vectors, or zeros where there is no token.
@query("document_embeddings", f"SELECT doc_id, 64 AS dim, CASE WHEN {TOKENS} > 0 THEN 1.0::double ELSE 0.0::double END AS norm FROM documents")
def document_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(dt.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    made = embed_column(docs, "text", encoder=hashing_encoder(64))
    return made.select("doc_id", F.size("embedding").alias("dim"), F.round(vec.l2_norm("embedding"), 3).alias("norm"))


# Recommendation

HISTOGRAMS_SQL = """users AS (SELECT user_id, list_transform([1, 2, 3, 4, 5], lambda s: len(list_filter(r, lambda x: x = s))::double / 4) AS uv
  FROM (SELECT user_id, list(rating) AS r FROM reviews GROUP BY user_id)),
items AS (SELECT parent_asin AS item_id, list_transform([1, 2, 3, 4, 5], lambda s: (len(list_filter(r, lambda x: x = s)) - 6)::double / 16) AS iv
  FROM (SELECT parent_asin, list(rating) AS r FROM reviews GROUP BY parent_asin))"""


def star_histograms(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Small exact vectors for scoring: counts per star, scaled by powers of two.

    Written once each: a search reads them several times, and the reviews behind them are joined once for both.
    """
    reviews = written(dt.reviews(spark, sf).select("user_id", "parent_asin", "rating"), "stars")

    def counts(key: str, shift: int, scale: float, out: str) -> DataFrame:
        stars = F.array(*[(F.count_if(F.col("rating") == s) - shift) / F.lit(scale) for s in range(1, 6)])
        return written(reviews.groupBy(key).agg(stars.alias(out)), out)

    items = counts("parent_asin", 6, 16.0, "item_vec").withColumnRenamed("parent_asin", "item_id")
    return counts("user_id", 0, 4.0, "user_vec"), items


@query("catalogue_scores", f"""
WITH {REVIEWS_SQL}, {HISTOGRAMS_SQL}
SELECT user_id, item_id, round(1.0 / (1.0 + exp(-logit)), 4) AS score, rank::integer AS rank FROM (
  SELECT user_id, item_id, list_inner_product(uv, iv) AS logit, row_number() OVER (PARTITION BY user_id ORDER BY list_inner_product(uv, iv) DESC, item_id) AS rank
  FROM users, items) WHERE rank <= 10""")
def catalogue_scores(spark: SparkSession, sf: str) -> DataFrame:
    users, items = star_histograms(spark, sf)
    return recommend.score_catalogue(users, items, 10)


@query("pruned_scores", f"""
WITH {REVIEWS_SQL}, {HISTOGRAMS_SQL}
SELECT user_id, item_id, round(logit, 6) AS logit, rank::integer AS rank FROM (
  SELECT user_id, item_id, list_inner_product(uv, iv) AS logit, row_number() OVER (PARTITION BY user_id ORDER BY list_inner_product(uv, iv) DESC, item_id) AS rank
  FROM users, items) WHERE rank <= 7""")
def pruned_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every user against the whole catalogue in rounds of a few thousand items."""
    users, items = star_histograms(spark, sf)
    found, _ = pruned_top_k(users, items, 7, query_id="user_id", query_vec="user_vec", vector_id="item_id", vector_vec="item_vec", metric="dot",
                            round_bytes=40_000)
    return found.select(F.col("query_id").alias("user_id"), F.col("vector_id").alias("item_id"), F.round("score", 6).alias("logit"), "rank")


@query("answered_requests", f"""
WITH {REVIEWS_SQL}, {HISTOGRAMS_SQL},
asked AS (SELECT c_custkey AS request_id, cast(c_custkey AS varchar) AS user_id, 2 + c_custkey % 2 AS top_k, CASE WHEN c_custkey % 20 = 0 THEN [] ELSE
  [cast(c_custkey % 300 + 1 AS varchar), 'new ' || c_custkey % 7, cast(c_custkey % 70 + 1 AS varchar), cast(c_custkey % 300 + 1 AS varchar)] END AS list FROM customer),
known AS (SELECT a.*, coalesce(u.uv, (SELECT uv FROM users ORDER BY user_id LIMIT 1)) AS v FROM asked a LEFT JOIN users u USING (user_id)),
listed AS (SELECT request_id, user_id, top_k, v, unnest(list) AS item_id, generate_subscripts(list, 1) AS pos FROM known),
scored AS (SELECT request_id, user_id, top_k, item_id, cast(pos AS varchar) AS tie, list_inner_product(v, coalesce(iv, (SELECT iv FROM items ORDER BY item_id LIMIT 1))) AS logit
  FROM listed LEFT JOIN items USING (item_id)
  UNION ALL SELECT request_id, user_id, top_k, item_id, item_id, list_inner_product(v, iv) FROM known, items WHERE len(list) = 0)
SELECT request_id, user_id, item_id, round(1.0 / (1.0 + exp(-logit)), 4) AS score, rank::integer AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY logit DESC, tie) AS rank FROM scored) WHERE rank <= top_k""")
def answered_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per customer, many of them without reviews; candidates of which one is new, or none for the whole catalogue."""
    users, items = star_histograms(spark, sf)
    key = F.col("c_custkey")
    names = F.array((key % 300 + 1).cast("string"), F.concat(F.lit("new "), (key % 7).cast("string")), (key % 70 + 1).cast("string"),
                    (key % 300 + 1).cast("string"))
    asked = dt.table(spark, sf, "customer").select(
        key.cast("bigint").alias("request_id"), key.cast("string").alias("user_id"), (F.lit(2) + key % 2).cast("int").alias("top_k"),
        F.when(key % 20 == 0, F.array().cast("array<string>")).otherwise(names).alias("candidate_items"))
    first_user, first_item = users.agg(F.min("user_id")).first()[0], items.agg(F.min("item_id")).first()[0]
    return recommend.answer_requests(asked, users, items, first_user, first_item)


@query("candidate_scores", f"""
WITH {REVIEWS_SQL}, {HISTOGRAMS_SQL}
SELECT user_id, item_id, rank::integer AS rank, score, cast(trunc(score / max(score) OVER (PARTITION BY user_id) * 100) AS integer) AS match_pct, '#' || rank AS rank_label FROM (
  SELECT user_id, item_id, rank, round(1.0 / (1.0 + exp(-logit)), 4) AS score FROM (
    SELECT user_id, item_id, list_inner_product(uv, iv) AS logit, row_number() OVER (PARTITION BY user_id ORDER BY list_inner_product(uv, iv) DESC, item_id) AS rank
    FROM (SELECT DISTINCT user_id, parent_asin AS item_id FROM reviews) JOIN users USING (user_id) JOIN items USING (item_id)) WHERE rank <= 10)""")
def candidate_scores(spark: SparkSession, sf: str) -> DataFrame:
    users, items = star_histograms(spark, sf)
    listed = ft.interactions(dt.reviews(spark, sf)).select("user_id", "item_id").distinct()
    return recommend.match_labels(recommend.score_candidates(listed, users, items, 10))


@query("top_items_per_user", f"""
WITH {REVIEWS_SQL}
SELECT user_id, item_id, score, rank::integer AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT user_id, parent_asin AS item_id, sum(rating) AS score FROM reviews GROUP BY ALL)) WHERE rank <= 5""")
def top_items_per_user(spark: SparkSession, sf: str) -> DataFrame:
    scores = dt.reviews(spark, sf).groupBy("user_id", F.col("parent_asin").alias("item_id")).agg(F.sum("rating").alias("score"))
    return recommend.top_k_items(scores, 5)


# Factor values depend on the solver; their number and length do not.
@query("factor_model", f"""
WITH {REVIEWS_SQL} SELECT 'user' AS side, 8 AS dim, count(DISTINCT user_id) AS rows FROM reviews UNION ALL SELECT 'item', 8, count(DISTINCT parent_asin) FROM reviews""")
def factor_model(spark: SparkSession, sf: str) -> DataFrame:
    # Written once: the samples and their number read it.
    indexed, users, items = index_tables(spark, sf, ("user_idx", "item_idx", "label", "user_id", "item_id", "event_timestamp"))
    samples = sampling.training_samples(indexed, users.count(), items.count(), ("user_id", "item_id", "event_timestamp"))
    # Each interaction gives itself and three drawn pairs.
    model = recommend.fit_factors(samples, rank=8, iterations=3, rows=4 * indexed.count())
    user_factors, item_factors = recommend.factor_tables(model)
    sides = (user_factors.select(F.lit("user").alias("side"), F.size("user_vec").alias("dim"))
             .unionByName(item_factors.select(F.lit("item").alias("side"), F.size("item_vec").alias("dim"))))
    return sides.groupBy("side", "dim").agg(F.count("*").alias("rows"))


# Evaluation

SCORED_SQL = "scored AS (SELECT l.quality AS label, least(1.0, d.n_chars / 4000.0)::double AS score FROM labels l JOIN documents d USING (doc_id))"


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = dt.table(spark, sf, "labels").join(dt.table(spark, sf, "documents"), "doc_id")
    return rows.select(F.col("quality").alias("label"), F.least(F.lit(1.0), F.col("n_chars") / F.lit(4000.0)).alias("score"))


@query("classifier_metrics", f"""
WITH {SCORED_SQL}, ranked AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored),
c AS (SELECT count(*) AS rows, count(*) FILTER (score > 0.5 AND label = 1) AS tp, count(*) FILTER (score > 0.5 AND label <> 1) AS fp,
  count(*) FILTER (score <= 0.5 AND label = 1) AS fn, avg(((score >= 0.5) = (label = 1))::integer) AS accuracy,
  avg(-(label * (CASE WHEN score > 0 THEN greatest(ln(score), -100) ELSE -100 END) + (1 - label) * (CASE WHEN score < 1 THEN greatest(ln(1 - score), -100) ELSE -100 END))) AS loss,
  (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / (count(*) FILTER (label = 1) * count(*) FILTER (label <> 1)) AS auc FROM ranked)
SELECT rows, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(auc, 6) AS auc FROM c""")
def classifier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    made = evaluation.binary_metrics(scored_labels(spark, sf))
    return made.select("rows", *[F.round(c, 6).alias(c) for c in ("loss", "accuracy", "precision", "recall", "f1", "auc")])


@query("perplexity", "SELECT round(exp(least(avg(value / 50.0), 20)), 6) AS perplexity FROM events")
def perplexity(spark: SparkSession, sf: str) -> DataFrame:
    losses = dt.table(spark, sf, "events").select((F.col("value") / 50.0).alias("loss"))
    return evaluation.perplexity(losses).select(F.round("perplexity", 6).alias("perplexity"))


# Service metrics; event types are the series, values the samples

HOUR = 3600


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return dt.events(spark, sf).select("event_id", "ts", F.col("event_type").alias("series"), "value", "user_id")


@query("counter_rates", """
SELECT series, window_start, round(sum(d) / 3600, 6) AS rate, count(*) AS samples FROM (
  SELECT event_type AS series, (epoch_us(ts) // 1000) // 3600000 * 3600 AS window_start,
    CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END AS d
  FROM (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, value) AS prev FROM events)) GROUP BY ALL""")
def counter_rates(spark: SparkSession, sf: str) -> DataFrame:
    return ts.counter_rate(samples(spark, sf), HOUR).select("series", "window_start", F.round("rate", 6).alias("rate"), "samples")


@query("hit_ratios", """
SELECT window_start, hits, misses, round(hits / (hits + misses), 6) AS hit_ratio, hits / (hits + misses) > 0.95 AS on_target FROM (
  SELECT (epoch_us(ts) // 1000) // 3600000 * 3600 AS window_start, sum(CASE WHEN event_type = 'view' THEN 1.0::double ELSE 0 END) AS hits,
    sum(CASE WHEN event_type = 'error' THEN 1.0::double ELSE 0 END) AS misses FROM events GROUP BY ALL) WHERE hits + misses > 0""")
def hit_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return ts.hit_ratio(samples(spark, sf), HOUR, "view", "error").withColumn("hit_ratio", F.round("hit_ratio", 6))


# Counters made from events: per type the running sum of values, which falls back now and then as at a restart.
COUNTERS_SQL = """counters AS (
  SELECT event_type AS series, ts, sum(value) OVER (PARTITION BY event_type, user_id % 7 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events),
grown AS (SELECT series, window_start, sum(CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END) AS increase FROM (
  SELECT series, (epoch_us(ts) // 1000) // 3600000 * 3600 AS window_start, value, lag(value) OVER (PARTITION BY series ORDER BY ts, value) AS prev FROM counters)
  GROUP BY ALL),
pair AS (SELECT window_start, coalesce(sum(increase) FILTER (series = 'view'), 0) AS a, coalesce(sum(increase) FILTER (series = 'click'), 0) AS b
  FROM grown WHERE series IN ('view', 'click') GROUP BY ALL)"""


def counters(spark: SparkSession, sf: str) -> DataFrame:
    running = Window.partitionBy("event_type", F.col("user_id") % 7).orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return dt.events(spark, sf).select(F.col("event_type").alias("series"), "ts", F.sum("value").over(running).alias("value"))


@query("counter_hit_ratios", f"""
WITH {COUNTERS_SQL} SELECT window_start, round(a, 4) AS hits, round(b, 4) AS misses, round(a / (a + b), 6) AS hit_ratio, a / (a + b) > 0.95 AS on_target FROM pair WHERE a + b <> 0""")
def counter_hit_ratios(spark: SparkSession, sf: str) -> DataFrame:
    made = ts.counter_hit_ratio(counters(spark, sf), HOUR, "view", "click", chunk_rows=2)
    return made.withColumns({"hits": F.round("hits", 4), "misses": F.round("misses", 4), "hit_ratio": F.round("hit_ratio", 6)})


@query("counter_averages", f"""
WITH {COUNTERS_SQL} SELECT window_start, round(a, 4) AS total, round(b, 4) AS requests, round(a / nullif(b, 0), 6) AS average FROM pair""")
def counter_averages(spark: SparkSession, sf: str) -> DataFrame:
    made = ts.counter_average(counters(spark, sf), HOUR, "view", "click")
    return made.withColumns({"total": F.round("total", 4), "requests": F.round("requests", 4), "average": F.round("average", 6)})


EDGES = ts.BUCKETS["rec_candidates"]
BUCKETS_SQL = """buckets AS (
  SELECT series, window_start, le, count(*) FILTER (value <= le) AS bucket, count(*) AS count, round(sum(value), 4) AS sum FROM (
    SELECT event_type AS series, (epoch_us(ts) // 1000) // 86400000 * 86400 AS window_start, value,
      unnest([10.0, 25.0, 50.0, 100.0, 200.0, 500.0, 'inf'::double]) AS le FROM events) GROUP BY ALL)"""


def day_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return ts.histogram(samples(spark, sf), EDGES, ["series", ts.window_start("ts", 86_400).alias("window_start")])


@query("latency_histogram", f"WITH {BUCKETS_SQL} SELECT series, window_start, CASE WHEN le = 'inf'::double THEN '+Inf' ELSE cast(le AS varchar) END AS le, bucket, count, sum FROM buckets")
def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    edge = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    return day_histogram(spark, sf).withColumns({"le": edge, "sum": F.round("sum", 4)}).select("series", "window_start", "le", "bucket", "count", "sum")


@query("latency_quantiles", f"""
WITH {BUCKETS_SQL}, steps AS (
  SELECT *, coalesce(lag(le) OVER w, 0.0) AS low, coalesce(lag(bucket) OVER w, 0) AS below FROM buckets WINDOW w AS (PARTITION BY series, window_start ORDER BY le)),
hit AS (SELECT *, q * count AS want, row_number() OVER (PARTITION BY series, window_start, q ORDER BY le) AS n
  FROM (SELECT *, unnest([0.5, 0.95, 0.99]) AS q FROM steps) WHERE bucket >= q * count)
SELECT series, window_start, q::double AS q, round(CASE WHEN le = 'inf'::double THEN low ELSE low + (le - low) * (want - below) / (bucket - below) END, 6) AS quantile
FROM hit WHERE n = 1""")
def latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    buckets, keys = day_histogram(spark, sf), ["series", "window_start"]
    found = [ts.histogram_quantile(buckets, q, keys).withColumn("q", F.lit(q)) for q in (0.5, 0.95, 0.99)]
    both = found[0].unionByName(found[1]).unionByName(found[2])
    return both.select(*keys, "q", F.round("quantile", 6).alias("quantile"))


@query("status_counts", "SELECT user_id, event_type AS status, count(*) AS requests FROM events GROUP BY ALL")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ts.status_counts(samples(spark, sf), ["user_id"], "series").withColumnRenamed("series", "status")


@query("gauge_stats", """
SELECT event_type AS series, (epoch_us(ts) // 1000) // 3600000 * 3600 AS window_start, round(avg(value / 1048576.0), 9) AS mean, round(sum(value / 1048576.0), 9) AS total,
       round(max(value / 1048576.0), 9) AS peak FROM events GROUP BY ALL""")
def gauge_stats(spark: SparkSession, sf: str) -> DataFrame:
    made = ts.gauge_stats(samples(spark, sf), HOUR, ["series"], scale=1_048_576.0)
    return made.withColumns({c: F.round(c, 9) for c in ("mean", "total", "peak")})


@query("average_per_request", """
SELECT window_start, round(total, 4) AS total, requests, round(total / requests, 6) AS average FROM (
  SELECT (epoch_us(ts) // 1000) // 3600000 * 3600 AS window_start, sum(CASE WHEN event_type = 'purchase' THEN value END) AS total,
    count(*) FILTER (event_type = 'purchase') AS requests FROM events GROUP BY ALL) WHERE requests > 0""")
def average_per_request(spark: SparkSession, sf: str) -> DataFrame:
    bought = F.col("series") == "purchase"
    made = ts.average_per_request(samples(spark, sf), HOUR, F.when(bought, F.col("value")), F.when(bought, 1).otherwise(0))
    return made.filter(F.col("requests") > 0).withColumns({"total": F.round("total", 4), "average": F.round("average", 6)})


@query("service_request_stats", """
SELECT coalesce(event_type, 'all') AS service, count(*) AS total, round(avg(value), 6) AS avg, min(value) AS best, max(value) AS worst FROM events GROUP BY ROLLUP (event_type)""")
def service_request_stats(spark: SparkSession, sf: str) -> DataFrame:
    log = dt.table(spark, sf, "events").select(F.col("event_type").alias("service"), F.col("value").alias("latency_ms"))
    return request_stats(log).withColumn("avg", F.round("avg", 6))


@query("run_comparison", """
WITH latest AS (SELECT * FROM (SELECT o_orderpriority AS mode, o_orderkey::varchar AS run_name, o_totalprice AS total_elapsed_s, o_custkey::double AS throughput,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey::varchar DESC) AS n FROM orders WHERE o_orderstatus = 'F') WHERE n = 1)
SELECT l.mode, l.run_name, l.total_elapsed_s, l.throughput, round(b.total_elapsed_s / l.total_elapsed_s, 6) AS speedup,
       round(l.throughput / b.throughput, 6) AS throughput_gain, round(b.throughput / l.throughput, 6) AS stage_speedup
FROM latest l LEFT JOIN latest b ON b.mode = '1-URGENT'""")
def run_comparison(spark: SparkSession, sf: str) -> DataFrame:
    runs = dt.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("mode"), F.col("o_orderkey").cast("string").alias("run_name"), F.col("o_orderdate").alias("start_time"),
        F.col("o_totalprice").alias("total_elapsed_s"), F.col("o_custkey").cast("double").alias("throughput"),
        F.col("o_custkey").cast("double").alias("stage"), F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING").alias("status"))
    made = ts.compare_runs(runs, baseline="1-URGENT", stages=["stage"])
    return made.withColumns({c: F.round(c, 6) for c in ("speedup", "throughput_gain", "stage_speedup")})
