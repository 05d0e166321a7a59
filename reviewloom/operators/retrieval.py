"""From search hits to sources, context blocks and question prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.operators.ordered import dense_index
from reviewloom.operators.skew import join_counted
from reviewloom.operators.topk import FEW_QUERIES, cluster_top_k, top_k

# Prompt wording and text limits of the answer prompt.
NO_CONTEXT = "No relevant reviews found."
CONTEXT_TITLE_CHARS = 60
CONTEXT_TEXT_CHARS = 500
ANSWER_INSTRUCTION = (
    "Based on the following product reviews, answer the user's question. "
    "Be helpful, accurate, and concise. If the reviews don't contain enough "
    "information, say so."
)


def prefer_product(hits: DataFrame, wanted: str = "product_id", item: str = "item_id",
                   query: str = "query_id") -> DataFrame:
    """Keep the hits of the asked product; a question without a match keeps all its hits.

    The filter follows the top-k search, so each question has at most k rows here.
    """
    match = F.coalesce((F.length(wanted) > 0) & (F.col(item) == F.col(wanted)), F.lit(False))
    marked = hits.withColumn("_match", match)
    matches = F.sum(F.col("_match").cast("int")).over(Window.partitionBy(query))
    kept = marked.withColumn("_matches", matches).filter(F.col("_match") | (F.col("_matches") == 0))
    return kept.drop("_match", "_matches")


def search_reviews(questions: DataFrame, reviews: DataFrame, k: int = 5, prefilter: bool = False, *,
                   query_id: str = "query_id", query_vec: str = "query_vec", review_id: str = "review_id",
                   vector: str = "embedding") -> DataFrame:
    """Top reviews per question with their attributes.

    ``questions`` may carry ``product_id``; by default it narrows the found hits, with
    ``prefilter`` only the reviews of the asked product are searched.
    """
    names = {"query_id": query_id, "query_vec": query_vec, "vector_id": review_id, "vector_vec": vector}
    asks_product = "product_id" in questions.columns
    if prefilter and asks_product:
        open_ended = F.coalesce(F.length("product_id") == 0, F.lit(True))
        found = top_k(questions.filter(open_ended), reviews, k, **names).unionByName(
            _search_products(questions.filter(~open_ended), reviews, k, names))
    else:
        found = top_k(questions, reviews, k, **names)
    found = found.withColumnRenamed("query_id", query_id).withColumnRenamed("vector_id", review_id)
    if questions.limit(FEW_QUERIES + 1).count() <= FEW_QUERIES:
        # At most k hits for each of the counted questions: the reviews need no shuffle.
        found = F.broadcast(found)
    hits = reviews.drop(vector).join(found, review_id)
    if prefilter or not asks_product:
        return hits
    return prefer_product(hits.join(questions.select(query_id, "product_id"), query_id), query=query_id)


def _search_products(questions: DataFrame, reviews: DataFrame, k: int, names: dict) -> DataFrame:
    """Each asked product is one search group; a product with many reviews is cut into blocks."""
    groups = dense_index(questions, "product_id", "cluster")
    probes = join_counted(questions, groups, "product_id", "inner")
    grouped = join_counted(reviews, groups.withColumnRenamed("product_id", "item_id"), "item_id", "inner")
    return cluster_top_k(probes, grouped, k, **names)


def review_line(position: Column, rating: Column, title: Column, text: Column) -> Column:
    """One numbered review of the context block."""
    heading = F.when(F.length(title) > 0, F.concat(F.lit(" — "), F.substring(title, 1, CONTEXT_TITLE_CHARS))).otherwise("")
    return F.concat(F.lit("Review "), position.cast("string"), F.lit(" ("), F.coalesce(rating.cast("string"), F.lit("?")),
                    F.lit("/5 stars)"), heading, F.lit(": "), F.substring(F.coalesce(text, F.lit("")), 1, CONTEXT_TEXT_CHARS))


def context_blocks(questions: DataFrame, hits: DataFrame, query: str = "query_id") -> DataFrame:
    """``context`` per question: its ranked reviews as text, or a fixed sentence when there are none."""
    position = F.row_number().over(Window.partitionBy(query).orderBy("rank"))
    lines = hits.withColumn("_pos", position).select(
        query, "_pos", review_line(F.col("_pos"), F.col("rating"), F.col("review_title"), F.col("embed_text")).alias("_line"))
    # At most k lines per question.
    blocks = lines.groupBy(query).agg(F.sort_array(F.collect_list(F.struct("_pos", "_line"))).alias("_lines"))
    joined = F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n\n")
    return (questions.join(blocks, query, "left")
                     .withColumn("context", F.coalesce(joined, F.lit(NO_CONTEXT))).drop("_lines"))


def answer_prompt(question: Column | str, context: Column | str) -> Column:
    """Prompt asking the model to answer from the context."""
    ask = F.col(question) if isinstance(question, str) else question
    block = F.col(context) if isinstance(context, str) else context
    return F.concat(F.lit(f"[INST] {ANSWER_INSTRUCTION}\n\nReviews:\n"), block,
                    F.lit("\n\nQuestion: "), ask, F.lit(" [/INST]"))
