"""The physical plans the operators are meant to have."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from reviewloom.operators import features as ft
from reviewloom.operators.asof import asof_join
from reviewloom.sources import driver_tables as dt
from reviewloom.store import Entity, FeatureStore, FeatureView, Source
from reviewloom.store.feature_store import within

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = ["user_features", "item_features", "interactions", "current_feature_join", "distinct_reviews", "point_in_time_join",
        "latest_event_per_user", "mean_item_vectors", "similar_vectors", "catalogue_scores", "counter_rates", "latency_quantiles",
        "run_comparison", "classifier_metrics", "training_set"]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_row_at_a_time_python(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in text


def test_only_needed_columns_are_read(spark):
    text = plan(ft.interactions(dt.reviews(spark, SF)))
    assert "p_name" not in text and "l_discount" not in text and "o_totalprice" not in text


def test_interval_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    dt.reviews(spark, SF).write.parquet(path)
    raw = spark.read.parquet(path).withColumn("event_timestamp", F.timestamp_millis("timestamp"))
    bounded = within(raw, "event_timestamp", datetime(1995, 1, 1), datetime(1996, 1, 1), "timestamp")
    text = plan(ft.user_features(bounded))
    assert "GreaterThanOrEqual(timestamp," in text and "LessThanOrEqual(timestamp," in text
    assert "helpful_vote" not in text.split("ReadSchema")[1]


def test_usual_point_in_time_join_is_one_shuffle(spark):
    rows = dt.events(spark, SF)
    text = plan(asof_join(rows.select("event_id", "user_id", "ts"), rows.select("user_id", "ts", "value"), "user_id", ["value"],
                          entity_time="ts", feature_time="ts"))
    assert text.count("Exchange") == 1 and text.count("Window") == 1


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(contract.queries()["top_items_per_user"](spark, SF))


def test_lookup_reads_the_asked_buckets(spark, tmp_path):
    entity = Entity("c_custkey", dtype=T.LongType())
    source = Source("customers", loader=lambda s: dt.table(s, SF, "customer").withColumn("event_timestamp", F.lit(datetime(2024, 1, 1)).cast("timestamp")))
    store = FeatureStore(spark, str(tmp_path / "store"), buckets=8)
    store.apply([FeatureView("customers", (entity,), (("c_acctbal", T.DoubleType()),), source)])
    store.materialize(datetime(2023, 1, 1), datetime(2025, 1, 1))
    asked = spark.createDataFrame([(3,), (3,), (10 ** 9,), (None,)], "c_custkey bigint")
    found = store.get_online_features(["customers:c_acctbal"], asked)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(", plan(found)) and "Exchange hash" not in plan(found)
    rows = found.collect()
    assert len(rows) == 4 and sum(r.c_acctbal is not None for r in rows) == 2
    many = store.get_online_features(["customers:c_acctbal"], asked, few_requests=1).collect()
    assert sorted(map(str, many)) == sorted(map(str, rows))
