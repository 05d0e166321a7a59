"""Scoring users against items and presenting the ranked lists."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.vectors import dot, sigmoid
from reviewloom.operators.factors import alternate
from reviewloom.operators.pruned import pruned_top_k
from reviewloom.operators.skew import join_unique, key_loads
from reviewloom.operators.topk import FEW_QUERIES, top_k
from reviewloom.session import written

SCORE_DIGITS = 4
FACTOR_BLOCKS = 10              # tasks that put the samples of a factor model in order, at least
SAMPLES_PER_BLOCK = 4_000_000   # that such a task sorts, some 40 bytes each


def score_catalogue(users: DataFrame, items: DataFrame, k: int = 10, *, user_id: str = "user_id",
                    user_vec: str = "user_vec", item_id: str = "item_id", item_vec: str = "item_vec", **search) -> DataFrame:
    """Top ``k`` of the whole catalogue for each user by dot product, scores as probabilities.

    Users absent from ``users`` have no vector and therefore no rows; ``answer_requests``
    gives them the default user's.  Few users travel to the items; many meet them in
    rounds of bounded blocks.
    """
    names = {"query_id": user_id, "query_vec": user_vec, "vector_id": item_id, "vector_vec": item_vec}
    many = not search and len(users.select(user_id).limit(FEW_QUERIES + 1).collect()) > FEW_QUERIES
    found = pruned_top_k(users, items, k, metric="dot", **names)[0] if many else top_k(users, items, k, metric="dot", **names, **search)
    return found.select(F.col("query_id").alias(user_id), F.col("vector_id").alias(item_id),
                        F.round(sigmoid("score"), SCORE_DIGITS).alias("score"), "rank")


def score_candidates(candidates: DataFrame, users: DataFrame, items: DataFrame, k: int | None = 10, *,
                     user_id: str = "user_id", user_vec: str = "user_vec", item_id: str = "item_id",
                     item_vec: str = "item_vec") -> DataFrame:
    """Scores of listed (user, item) candidates; with ``k`` the best of each user only."""
    logit = F.round(dot(user_vec, item_vec), 9)
    pairs = candidates.select(user_id, item_id)
    by_user, by_item = key_loads(pairs, user_id, item_id)
    scored = join_unique(join_unique(pairs, users, user_id, "inner", by_user), items, item_id, "inner", by_item)
    scored = scored.select(user_id, item_id, logit.alias("_logit"))
    if k is not None:
        order = Window.partitionBy(user_id).orderBy(F.desc("_logit"), item_id)
        scored = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return scored.withColumn("score", F.round(sigmoid("_logit"), SCORE_DIGITS)).drop("_logit")


def answer_requests(requests: DataFrame, users: DataFrame, items: DataFrame, default_user: str, default_item: str, *,
                    user_id: str = "user_id", user_vec: str = "user_vec", item_id: str = "item_id", item_vec: str = "item_vec") -> DataFrame:
    """``request_id, user_id, item_id, score, rank`` of the best ``top_k`` items of every request.

    ``requests``: request_id, user_id, candidate_items (array, empty or null for the whole
    catalogue) and top_k.  An unknown user is scored as ``default_user`` and an unknown
    candidate as ``default_item``, under its own name; a candidate that is listed twice is
    answered twice.  Equal scores go by place in the list, in the catalogue by item id.
    """
    def default_of(table: DataFrame, name: str, vector: str, wanted: str) -> list[float]:
        row = table.filter(F.col(name) == wanted).select(F.col(vector).cast("array<double>")).first()
        if row is None:
            raise KeyError(f"default {name} {wanted} has no vector")
        return row[0]

    fallback = F.lit(default_of(users, user_id, user_vec, default_user)).cast("array<double>")
    other = F.lit(default_of(items, item_id, item_vec, default_item)).cast("array<double>")
    asked = requests.select("request_id", user_id, "candidate_items", "top_k")
    known = join_unique(asked, users.select(user_id, F.col(user_vec).cast("array<double>").alias("_user")), user_id, "left")
    known = written(known.withColumn("_user", F.coalesce("_user", fallback)), "requests")
    listed = known.filter(F.size("candidate_items") > 0).select(
        "request_id", user_id, "top_k", "_user", F.posexplode("candidate_items").alias("_at", item_id))
    paired = join_unique(listed, items.select(item_id, F.col(item_vec).cast("array<double>").alias("_item")), item_id, "left")
    scored = paired.withColumn("_logit", F.round(dot("_user", F.coalesce("_item", other)), 9))
    order = Window.partitionBy("request_id").orderBy(F.desc("_logit"), "_at")
    answered = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.col("top_k")).select(
        "request_id", user_id, item_id, "_logit", "rank")
    whole = known.filter(F.coalesce(F.size("candidate_items"), F.lit(0)) <= 0)
    most = whole.agg(F.max("top_k")).first()[0]
    if most:
        found = pruned_top_k(whole, items, int(most), query_id="request_id", query_vec="_user", vector_id=item_id, vector_vec=item_vec, metric="dot")[0]
        found = found.join(whole.select(F.col("request_id").alias("query_id"), user_id, "top_k"), "query_id").filter(F.col("rank") <= F.col("top_k"))
        answered = answered.unionByName(found.select(F.col("query_id").alias("request_id"), user_id, F.col("vector_id").alias(item_id),
                                                     F.col("score").alias("_logit"), "rank"))
    return answered.withColumn("score", F.round(sigmoid("_logit"), SCORE_DIGITS)).select("request_id", user_id, item_id, "score", "rank")


def top_k_items(scores: DataFrame, k: int = 10, user_id: str = "user_id", item_id: str = "item_id",
                score: str = "score") -> DataFrame:
    """Best ``k`` items of each user; ties go to the smaller id."""
    order = Window.partitionBy(user_id).orderBy(F.desc(score), item_id)
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def match_labels(ranked: DataFrame, user_id: str = "user_id", score: str = "score") -> DataFrame:
    """Percent of the list's top score (whole percent, truncated) and a rank label."""
    top = F.max(score).over(Window.partitionBy(user_id))
    pct = F.when(top != 0, (F.col(score) / top * 100).cast("int")).otherwise(0)
    return ranked.withColumns({"match_pct": pct, "rank_label": F.concat(F.lit("#"), F.col("rank").cast("string"))})


def factor_blocks(rows: int) -> int:
    """Tasks that put so many samples in order: each sorts those of one block, so their number grows with the samples."""
    return max(FACTOR_BLOCKS, -(-rows // SAMPLES_PER_BLOCK))


def fit_factors(samples: DataFrame, rank: int = 64, iterations: int = 10, reg: float = 0.1, seed: int = 42, rows: int = 0) -> ALSModel:
    """Factor model over (user_idx, item_idx, label) samples; ``rows`` is about their number, where it is large."""
    return alternate(samples, rank, iterations, reg, seed, factor_blocks(rows))


def factor_tables(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """User and item factors as (index, vector) tables, ready for scoring."""
    users = model.userFactors.select(F.col("id").cast("bigint").alias("user_idx"), F.col("features").alias("user_vec"))
    items = model.itemFactors.select(F.col("id").cast("bigint").alias("item_idx"), F.col("features").alias("item_vec"))
    return users, items
