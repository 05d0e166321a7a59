import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import vectors as vec
from reviewloom.operators import evaluation, ivf, recommend, retrieval
from reviewloom.operators.aggregates import mean_vectors
from reviewloom.operators.encode import embed_column, hashing_encoder
from reviewloom.operators.topk import top_k


def frame(spark, matrix, names=("vec_id", "embedding")):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], f"{names[0]} bigint, {names[1]} array<float>")


def brute(queries, vectors, k):
    out = {}
    for q, a in enumerate(queries):
        scored = []
        for i, b in enumerate(vectors):
            size = np.linalg.norm(a) * np.linalg.norm(b)
            if size > 0:
                scored.append((-round(float(np.dot(a, b) / size), 9), i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("options", [{}, {"few_queries": 0, "block_queries": 5, "block_vectors": 40}])
def test_top_k_with_ties_zeros_and_nulls(spark, options):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-2, 3, size=(150, 4)).astype(float)   # many exact ties
    vectors[7] = 0.0
    queries = rng.integers(-2, 3, size=(17, 4)).astype(float)
    queries[3] = [1, 0, 0, 0]
    rows = frame(spark, vectors).unionByName(spark.createDataFrame([(999, None)], "vec_id bigint, embedding array<float>"))
    found = top_k(frame(spark, queries, ("query_id", "query_vec")), rows, 6, vector_id="vec_id", **options)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vector_id)
    assert got == {q: ids for q, ids in brute(queries, vectors, 6).items() if ids}


def test_top_k_with_string_ids_and_few_vectors(spark):
    rows = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0])], "id string, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0, 1.0])], "query_id string, query_vec array<double>")
    found = top_k(asked, rows, 5, vector_id="id").orderBy("rank").collect()
    assert [(r.vector_id, r.rank) for r in found] == [("a", 1), ("b", 2)]
    assert top_k(asked.limit(0), rows, 5, vector_id="id").count() == 0
    assert top_k(asked, rows.limit(0), 5, vector_id="id").count() == 0


def test_all_clusters_probed_equals_exact(spark):
    rng = np.random.default_rng(5)
    vectors, queries = rng.normal(size=(200, 8)), rng.normal(size=(9, 8))
    rows = frame(spark, vectors)
    model = ivf.fit_clusters(rows, n_list=6)
    clustered = ivf.assign_clusters(model, rows)
    asked = frame(spark, queries, ("query_id", "query_vec"))
    exact = {(r.query_id, r.vector_id) for r in top_k(asked, rows, 4, vector_id="vec_id").collect()}
    full = ivf.approximate_top_k(asked, clustered, model, 4, nprobe=6, vector_id="vec_id")
    assert {(r.query_id, r.vector_id) for r in full.collect()} == exact
    some = ivf.approximate_top_k(asked, clustered, model, 4, nprobe=3, vector_id="vec_id")
    assert len({(r.query_id, r.vector_id) for r in some.collect()} & exact) >= len(exact) // 2


def test_vector_columns(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [])], "i int, v array<float>")
    unit = {r.i: r.u for r in df.select("i", vec.l2_normalize("v").alias("u")).collect()}
    assert unit[1] == [0.6, 0.8] and unit[2] is None and unit[3] is None
    filled = {r.i: r.z for r in df.select("i", vec.or_zero_vector("v", 2).alias("z")).collect()}
    assert filled[3] == [0.0, 0.0] and filled[4] == [0.0, 0.0] and filled[1] == [3.0, 4.0]
    cos = {r.i: r.c for r in df.filter("i < 4").select("i", vec.cosine("v", F.array(F.lit(1.0), F.lit(0.0))).alias("c")).collect()}
    assert cos[1] == pytest.approx(0.6) and cos[2] is None and cos[3] is None


def test_mean_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("a", None), ("b", [5.0, 5.0])], "item_id string, embedding array<float>")
    assert {r.item_id: r.item_embedding_avg for r in mean_vectors(df).collect()} == {"a": [2.0, 4.0], "b": [5.0, 5.0]}


def test_encoder_is_repeatable_and_null_safe(spark):
    df = spark.createDataFrame([(1, "good good phone"), (2, None), (3, "good good phone"), (4, "")], "i int, t string")
    got = {r.i: r.embedding for r in embed_column(df, "t", encoder=hashing_encoder(16)).collect()}
    assert got[1] == got[3] and len(got[1]) == 16 and got[2] == got[4] == [0.0] * 16
    assert np.linalg.norm(got[1]) == pytest.approx(1.0, abs=1e-6)


def test_product_filter_falls_back(spark):
    hits = spark.createDataFrame([(1, "x", "x", 1), (1, "y", "x", 2), (2, "y", "z", 1), (3, "y", "", 1), (4, None, "q", 1)],
                                 "query_id int, item_id string, product_id string, rank int")
    kept = {(r.query_id, r.item_id) for r in retrieval.prefer_product(hits).collect()}
    assert kept == {(1, "x"), (2, "y"), (3, "y"), (4, None)}


def test_context_blocks(spark):
    asked = spark.createDataFrame([(1, "ok?"), (2, "none?")], "query_id int, question string")
    hits = spark.createDataFrame([(1, 2, 4.0, "T" * 70, "b" * 600), (1, 1, None, None, None)],
                                 "query_id int, rank int, rating double, review_title string, embed_text string")
    got = {r.query_id: r for r in retrieval.context_blocks(asked, hits).withColumn("prompt", retrieval.answer_prompt("question", "context")).collect()}
    assert got[1].context == "Review 1 (?/5 stars): \n\nReview 2 (4.0/5 stars) — " + "T" * 60 + ": " + "b" * 500
    assert got[2].context == "No relevant reviews found."
    assert got[2].prompt.endswith("Reviews:\nNo relevant reviews found.\n\nQuestion: none? [/INST]")


def test_scores_and_match_labels(spark):
    users = spark.createDataFrame([("u", [1.0, 0.0])], "user_id string, user_vec array<double>")
    items = spark.createDataFrame([("a", [2.0, 1.0]), ("b", [2.0, 5.0]), ("c", [-1.0, 0.0])], "item_id string, item_vec array<double>")
    ranked = recommend.match_labels(recommend.score_catalogue(users, items, 2)).orderBy("rank").collect()
    assert [(r.item_id, r.score, r.match_pct, r.rank_label) for r in ranked] == [("a", 0.8808, 100, "#1"), ("b", 0.8808, 100, "#2")]
    listed = spark.createDataFrame([("u", "c"), ("u", "a"), ("u", "nope"), ("ghost", "a")], "user_id string, item_id string")
    assert {(r.item_id, r.rank) for r in recommend.score_candidates(listed, users, items).collect()} == {("a", 1), ("c", 2)}


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_metrics_with_ties_and_one_class(spark):
    rows = [(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1), (1, 0.3), (0, 0.3), (0, 0.3)]
    pairs = [(p, n) for p in rows if p[0] for n in rows if not n[0]]
    want = sum(1.0 if p[1] > n[1] else 0.5 if p[1] == n[1] else 0.0 for p, n in pairs) / len(pairs)
    got = evaluation.binary_metrics(scored(spark, rows)).first()
    assert got.auc == pytest.approx(want) and got.precision == 1.0 and got.recall == pytest.approx(1 / 3)
    none = evaluation.binary_metrics(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert none.auc is None and (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    certain = evaluation.binary_metrics(scored(spark, [(1, 0.0), (0, 0.0)])).first()
    assert certain.loss == 50.0   # a wrong certain score costs at most 100


def test_perplexity_is_capped(spark):
    assert evaluation.perplexity(spark.createDataFrame([(100.0,)], "loss double")).first()[0] == pytest.approx(np.exp(20))


@pytest.mark.parametrize("few_queries", [1, 4096])
@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_top_k_stays_whole_with_odd_values_and_ties(spark, metric, few_queries):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(400 + i, [1.0, v]) for i, v in enumerate((nan, inf, -inf, None))] + [(500, [2.0, 4.0])]
    vectors = spark.createDataFrame(rows, "vid bigint, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 1.0]), (2, [0.0, 1.0]), (3, [nan, 1.0])], "query_id bigint, query_vec array<double>")
    got = top_k(queries, vectors, 5, vector_id="vid", metric=metric, few_queries=few_queries, block_queries=1, block_vectors=64).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append(r["vector_id"])
    best = [500, 0, 1, 2, 3] if metric == "dot" else [0, 1, 2, 3, 4]
    assert by_query == {1: best, 2: best}


def test_measured_search_reaches_its_recall(spark):
    vectors = np.random.default_rng(8).normal(size=(400, 24))
    rows = frame(spark, vectors)
    model = ivf.fit_clusters(rows, n_list=12)
    clustered = ivf.assign_clusters(model, rows)
    asked = rows.filter("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding AS query_vec")
    want = {(q * 20, i) for q, ids in brute(vectors[::20], vectors, 5).items() for i in ids}

    def share(found):
        return len({(r.query_id, r.vector_id) for r in found.collect()} & want) / len(want)

    assert share(ivf.approximate_top_k(asked, clustered, model, 5, nprobe=2, vector_id="vec_id")) < 0.9
    assert share(ivf.measured_top_k(asked, clustered, model, 5, nprobe=2, least=0.9, vector_id="vec_id")) >= 0.9


def test_small_blocks_do_not_multiply_the_rows(spark):
    """Rows sent to the grid grow with the table, not with its square, and later stripes of vectors still win or tie rightly."""
    from reviewloom.operators import topk
    assert [topk._cells(n, 64) for n in (1, 500, 5_000, 100_000)] == [1, 8, 8, 8]
    assert topk._cells(1 << 20, 64) == 16 and topk._cells(100, 1 << 12) == 1
    rng = np.random.default_rng(11)
    vectors = rng.integers(-2, 3, size=(9_500, 3)).astype(float)   # more than two stripes, nearly all of them ties
    vectors[9_400] = [3.0, 3.0, 2.5]
    queries = rng.integers(-2, 3, size=(270, 3)).astype(float)
    got = topk._local_top(queries, vectors, np.arange(9_500) * 2, 6)
    assert got.groupby("q").size().eq(6).all() and got["q"].nunique() == 270
    scores = np.round(queries @ vectors.T, topk.RANK_DIGITS)
    for q, part in got.groupby("q"):
        want = np.lexsort((np.arange(9_500), -scores[q]))[:6]
        assert part["vid"].tolist() == (want * 2).tolist() and np.array_equal(part["score"], scores[q][want])
