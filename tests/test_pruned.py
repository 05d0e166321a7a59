"""The search by bounded blocks against the plain search."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from reviewloom.operators import pruned
from reviewloom.operators.pruned import pruned_top_k
from reviewloom.operators.topk import top_k


def frames(spark, vectors, queries):
    v = spark.createDataFrame([(i, [float(x) if x is not None else None for x in r]) for i, r in enumerate(vectors)], "vid bigint, embedding array<double>")
    q = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(queries)], "query_id bigint, query_vec array<double>")
    return v, q


def rows(df):
    return {(r["query_id"], r["rank"], r["vector_id"], round(r["score"], 7)) for r in df.collect()}


@pytest.mark.parametrize("metric", ["dot", "cosine"])
@pytest.mark.parametrize("round_bytes", [1 << 20, 20_000])
def test_same_rows_as_the_plain_search(spark, monkeypatch, metric, round_bytes):
    monkeypatch.setattr(pruned, "BLOCK_VECTORS", 64)
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(12, 10)) * 3
    vectors = middle[np.arange(900) % 12] + rng.normal(size=(900, 10))
    vectors *= np.exp(rng.normal(size=(900, 1)))
    vectors[100:140] = vectors[7]  # ties, by smaller id
    queries = middle[np.arange(80) % 12] + rng.normal(size=(80, 10))
    v, q = frames(spark, vectors, queries)
    found, report = pruned_top_k(q, v, 6, vector_id="vid", metric=metric, round_bytes=round_bytes)
    assert rows(found) == rows(top_k(q, v, 6, vector_id="vid", metric=metric))
    lines = report.orderBy("round").collect()
    assert lines[0]["queries"] == 80 and sum(r["skipped"] for r in lines) > sum(r["compared"] for r in lines) / 2
    # Every vector is sent at most once, and all of them unless every query was done before.
    assert sum(r["vectors"] for r in lines) <= 900
    if round_bytes == 20_000:
        assert len(lines) > 1 or metric == "dot"
    if metric == "cosine":
        assert sum(r["vectors"] for r in lines) == 900


def test_large_norms_end_the_search_early(spark, monkeypatch):
    monkeypatch.setattr(pruned, "BLOCK_VECTORS", 50)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(2_000, 6)) * np.where(np.arange(2_000) < 60, 50.0, 0.01)[:, None]
    v, q = frames(spark, vectors, rng.normal(size=(40, 6)))
    found, report = pruned_top_k(q, v, 3, vector_id="vid", metric="dot", round_bytes=6_000)
    assert rows(found) == rows(top_k(q, v, 3, vector_id="vid", metric="dot"))
    assert report.agg({"vectors": "sum"}).first()[0] < 600


def test_odd_rows_few_rows_and_text_ids(spark):
    nan, inf = float("nan"), float("inf")
    v, q = frames(spark, [[1.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [0.0, 0.0], [0.5, 0.5]], [[1.0, 1.0], [nan, 1.0], [0.0, 0.0]])
    for metric in ("dot", "cosine"):
        found, _ = pruned_top_k(q, v, 4, vector_id="vid", metric=metric)
        assert rows(found) == rows(top_k(q, v, 4, vector_id="vid", metric=metric))
    assert pruned_top_k(q.limit(0), v, 2, vector_id="vid")[0].count() == 0 == pruned_top_k(q, v.limit(0), 2, vector_id="vid")[0].count()
    named = spark.createDataFrame([("b", [1.0]), ("a", [1.0])], "vid string, embedding array<float>")
    asked = spark.createDataFrame([("q", [2.0])], "query_id string, query_vec array<float>")
    assert [(r.vector_id, r.rank) for r in pruned_top_k(asked, named, 2, vector_id="vid", metric="dot")[0].orderBy("rank").collect()] == [("a", 1), ("b", 2)]


def test_a_round_and_a_stripe_have_bounds(spark, monkeypatch):
    """Short vectors do not make a round of millions of ids, and queries meet the blocks a few at a time, with the same result."""
    from reviewloom.operators import pruned
    from reviewloom.operators.topk import top_k
    rng = np.random.default_rng(8)
    items = spark.createDataFrame([(f"i{n}", [float(x) for x in rng.integers(-3, 4, 3)]) for n in range(700)], "vector_id string, embedding array<double>")
    asked = spark.createDataFrame([(f"q{n}", [float(x) for x in rng.integers(-3, 4, 3)]) for n in range(90)], "query_id string, query_vec array<double>")
    monkeypatch.setattr(pruned, "ROUND_VECTORS", 200)
    monkeypatch.setattr(pruned, "STRIPE", 7)
    monkeypatch.setattr(pruned, "BLOCK_VECTORS", 50)
    found, report = pruned.pruned_top_k(asked, items, 4, metric="dot")
    assert max(r["vectors"] for r in report.collect()) <= 200
    exact = top_k(asked, items, 4, metric="dot")
    assert {tuple(r) for r in found.select(*exact.columns).collect()} == {tuple(r) for r in exact.collect()}
    packed = pruned._packed(items.select(F.lit("b").alias("block"), F.col("vector_id").alias("id"), F.col("embedding").alias("vec")))
    assert len(packed) == 1 and not isinstance(packed[0][0], np.ndarray) and packed[0][0].to_pylist() == sorted(f"i{n}" for n in range(700))
