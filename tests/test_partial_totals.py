"""Stored totals by category agree with totals per pair, and need no sorted sets."""

from pyspark.sql import functions as F

from reviewloom.operators import features as ft
from reviewloom.store import Source
from reviewloom.store.views import partial_views

SCHEMA = "user_id string, parent_asin string, rating double, text string, timestamp bigint, helpful_vote int, category string"
ROWS = [
    ("u1", "i1", 5.0, "abc", 0, 1, "x"), ("u1", "i1", 3.0, None, 3 * 86_400_000, 2, None), ("u1", "i1", 3.0, "q", 5, 2, "y"),
    ("u1", "i2", None, "abcde", 86_400_000, None, "y"), ("u2", None, 4.0, "", 7, 1, None), (None, "i1", 2.0, "ab", 9, 1, "x"),
    (None, None, 2.0, "ab", 8, 1, "z"), ("u3", "i3", None, None, 4, None, None), ("u1", "i1", 5.0, "abc", 0, 1, "x"),
]


def rows_of(df):
    return sorted(repr(r) for r in df.select(sorted(df.columns)).collect())


def test_features_by_category_agree_with_those_of_pairs(spark):
    reviews = spark.createDataFrame(ROWS, SCHEMA)
    want = ft.user_features(reviews)
    halves = [reviews.filter("timestamp < 7"), reviews.filter("timestamp >= 7")]
    totals = ft.added_totals(ft.category_totals(halves[0]).unionByName(ft.category_totals(halves[1])), ["user_id", "parent_asin", "category"])
    assert rows_of(ft.user_features_by_category(totals)) == rows_of(want)
    assert rows_of(ft.item_features_of(totals)) == rows_of(ft.item_features(reviews))
    assert totals.filter("user_id = 'u1' AND parent_asin = 'i1'").count() == 3


def test_partial_results_are_kept_in_hash_tables(spark):
    """A set of each pair's categories would make Spark sort all rows before and after the shuffle."""
    source = Source("raw_reviews", loader=lambda session: session.createDataFrame(ROWS, SCHEMA), millis_field="timestamp")
    for view in partial_views(source):
        folded = view.partial.fold(source.load(spark))
        added = view.partial.combine(folded.unionByName(folded))
        for made in (folded, added, view.partial.finish(added)):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
        assert added.agg(F.sum("n")).first()[0] == 2 * len(ROWS)


def test_the_narrower_features_are_joined_first(spark):
    """What is joined first is shuffled again for the second join."""
    from reviewloom.plans.work_queries import with_features
    reviews = spark.createDataFrame(ROWS, SCHEMA)
    pairs = reviews.select("user_id", F.col("parent_asin").alias("item_id")).distinct()
    made = with_features(pairs, ft.user_features(reviews), ft.item_features(reviews))
    joins = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert "user_id" in joins[0] and "item_id" in joins[1]
    assert made.count() == 3 and {r.item_review_count for r in made.collect()} == {5, 1}
