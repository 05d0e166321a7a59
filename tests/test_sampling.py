import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import sampling
from reviewloom.operators.dedup import latest_per_key, one_per_key
from reviewloom.operators.features import fill_features, item_features, labelled_interactions, user_features
from reviewloom.operators.joins import index_interactions
from reviewloom.operators.ordered import dense_index, running_totals


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 37, 299, 300, 500])
def test_exact_sample_size_and_choice(spark, n):
    df = spark.range(300)
    got = sorted(r.id for r in sampling.sample_exact(df, n, ("id",)).collect())
    assert got == sorted(sorted(range(300), key=lambda i: md5(f"42_{i}"))[:n])


def test_cap_per_group_keeps_small_groups_and_null_group(spark):
    rows = [(i, "big") for i in range(200)] + [(i, "small") for i in range(200, 203)] + [(i, None) for i in range(300, 330)]
    df = spark.createDataFrame(rows, "id int, g string")
    sizes = {r.g: r["count"] for r in sampling.cap_per_group(df, "g", 10, ("id",)).groupBy("g").count().collect()}
    assert sizes == {"big": 10, "small": 3, None: 10}


def test_no_cap_returns_all(spark):
    assert sampling.cap_rows(spark.range(5), None, ("id",)).count() == 5


def test_splits_are_complete_disjoint_and_stable(spark):
    df = spark.range(5000).withColumn("split", sampling.split_label(F.col("id"), sampling.example_shares(0.9, 0.05)))
    counts = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000 and set(counts) == {"train", "val", "test"}
    assert 4350 < counts["train"] < 4650
    again = df.repartition(7).withColumn("split2", sampling.split_label(F.col("id"), sampling.example_shares(0.9, 0.05)))
    assert again.filter("split <> split2").count() == 0
    assert sum(d.count() for d in sampling.random_splits(df, {"train": 0.9, "val": 0.1}).values()) == 5000


def test_running_totals_and_dense_index(spark):
    rng = random.Random(1)
    values = rng.sample(range(10_000), 500)
    df = spark.createDataFrame([(v, v % 7) for v in values], "k int, x int")
    got = {r.k: r.total for r in running_totals(df, ["k"], {"total": F.col("x")}, partitions=5).collect()}
    total, want = 0, {}
    for v in sorted(values):
        total += v % 7
        want[v] = total
    assert got == want
    words = spark.createDataFrame([(w,) for w in ["b", "a", "é", "Z", "a", None, "b"]], "w string")
    assert {r.w: r.i for r in dense_index(words, "w", "i").collect()} == {"Z": 0, "a": 1, "b": 2, "é": 3}


def test_unknown_ids(spark):
    pairs = spark.createDataFrame([("u", "i"), ("x", "i")], "user_id string, item_id string")
    users = spark.createDataFrame([("u", 4)], "user_id string, user_idx bigint")
    items = spark.createDataFrame([("i", 2)], "item_id string, item_idx bigint")
    assert index_interactions(pairs, users, items).count() == 1
    mapped = {r.user_id: r.user_idx for r in index_interactions(pairs, users, items, unknown="first").collect()}
    assert mapped == {"u": 4, "x": 0}


def test_negatives_have_the_ratio_and_exclude_seen(spark):
    rows = [(f"u{i % 4}", f"i{i % 3}", i, i % 4, i % 3, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, event_timestamp int, user_idx bigint, item_idx bigint, label double")
    keys = ("user_id", "item_id", "event_timestamp")
    made = sampling.training_samples(df, 10, 10, keys)
    assert made.count() == 60 * 4 and made.filter("label = 0").count() == 180
    unseen = sampling.negative_pairs(df, 10, 10, keys, exclude_seen=True)
    assert unseen.join(df, ["user_idx", "item_idx"]).count() == 0


def test_one_row_per_key(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 1, None), (None, 5, "z"), (None, 4, "w")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert {(r.k, r.t) for r in one_per_key(df, ["k"], ["t"]).collect()} == {("a", 1), ("b", 1), (None, 4)}
    assert {(r.k, r.v) for r in latest_per_key(df, ["k"], "t").collect()} == {("a", "x"), ("b", None), (None, "z")}


def reviews(spark):
    rows = [
        ("u1", "i1", 5.0, "abc", 0, 1, "x"),
        ("u1", "i1", 3.0, None, 3 * 86_400_000 - 1, 2, None),
        ("u1", "i2", None, "abcde", 86_400_000, None, "y"),
        ("u2", "i3", 4.0, "", 7, 1, None),
    ]
    return spark.createDataFrame(rows, "user_id string, parent_asin string, rating double, text string, timestamp bigint, helpful_vote int, category string")


def test_user_features_edges(spark):
    got = {r.user_id: r for r in user_features(reviews(spark)).collect()}
    one = got["u1"]
    assert (one.user_avg_rating, one.user_review_count, one.user_unique_items, one.user_avg_review_length) == (4.0, 3, 2, 4.0)
    assert (one.user_category_count, one.user_tenure_days) == (2, 2)
    assert (got["u2"].user_category_count, got["u2"].user_tenure_days) == (0, 0)


def test_item_features_edges(spark):
    meta = spark.createDataFrame([("i1", "from 14.99", 3), ("i1", "10.5", 9), ("i2", "2", None)], "parent_asin string, price string, rating_number int")
    got = {r.item_id: r for r in item_features(reviews(spark), meta).collect()}
    assert len(got) == 3
    assert got["i1"].item_price == 10.5 and got["i2"].item_price == 2.0 and got["i3"].item_price is None
    assert got["i1"].item_rating_stddev == pytest.approx(2 ** 0.5) and got["i3"].item_rating_stddev is None
    assert got["i1"].item_total_helpful_votes == 3
    bare = item_features(reviews(spark))
    assert bare.schema["item_price"].dataType.simpleString() == "float" and bare.filter("item_price is not null").count() == 0


def test_labelled_interactions_and_fill(spark):
    df = spark.createDataFrame([("u", "i", 1_700_000_000_123, 4.0)], "user_id string, parent_asin string, timestamp bigint, rating double")
    row = labelled_interactions(df).select("item_id", F.unix_millis("event_timestamp").alias("ms"), "label").first()
    assert tuple(row) == ("i", 1_700_000_000_123, 1.0)
    with pytest.raises(ValueError):
        labelled_interactions(df.drop("timestamp"))
    with pytest.raises(ValueError):
        labelled_interactions(df.drop("rating"))
    filled = fill_features(spark.createDataFrame([(None, 2)], "a double, b bigint"), ("a", "b", "c")).first()
    assert tuple(filled) == (0.0, 2, 0.0)


def test_digests_of_draws_are_compiled(spark):
    """A digest inside a higher-order function is interpreted row by row."""
    df = spark.createDataFrame([(1, 2, 1.0, "u", "i", 5)], "user_idx int, item_idx int, label double, user_id string, item_id string, event_timestamp bigint")
    keys = ("user_id", "item_id", "event_timestamp")
    for unseen in (False, True):
        made = sampling.training_samples(df, 10, 10, keys, exclude_seen=unseen)
        assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(made.columns) == ["item_idx", "label", "user_idx"]
