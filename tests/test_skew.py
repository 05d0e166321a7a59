import pytest

from reviewloom.operators.joins import restore_ids
from reviewloom.operators.skew import join_unique, key_load, key_loads


def frames(spark):
    left = spark.createDataFrame([("hot", i) for i in range(30)] + [(None, i) for i in range(20)] + [("a", 1), ("b", 2)], "k string, i int")
    right = spark.createDataFrame([("hot", 1.0), ("a", 2.0), ("z", 3.0)], "k string, v double")
    return left, right


def test_heavy_keys_and_missing_keys(spark):
    left, _ = frames(spark)
    load = key_load(left, "k", hot_rows=10)
    assert load.keys == (("hot",),) and load.no_key
    both = key_loads(left.withColumn("j", left.i % 2), "k", "j", hot_rows=24)
    assert both[0].keys == (("hot",),) and not both[0].no_key
    assert sorted(both[1].keys) == [(0,), (1,)]
    assert key_load(left, ["k", "i"], hot_rows=10).keys == ()
    assert key_load(left, "k", hot_rows=None).keys == ()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_plain_join(spark, how):
    left, right = frames(spark)
    want = sorted(map(str, left.join(right, "k", how).select("k", "i", "v").collect()))
    for hot_rows in (10, 25, None):
        got = join_unique(left, right, "k", how, key_load(left, "k", hot_rows)).select("k", "i", "v").collect()
        assert sorted(map(str, got)) == want


def test_ids_are_restored_for_hot_and_unknown_indexes(spark):
    rows = [(0, i % 3, i) for i in range(20)] + [(1, 0, 20), (9, 0, 21), (None, 1, 22), (None, 1, 23), (None, None, 24)]
    df = spark.createDataFrame(rows, "user_idx bigint, item_idx bigint, n int")
    users = spark.createDataFrame([(0, "u0"), (1, "u1")], "user_idx bigint, user_id string")
    items = spark.createDataFrame([(0, "i0"), (1, "i1"), (2, "i2")], "item_idx bigint, item_id string")
    want = {(n, None if u not in (0, 1) else f"u{u}", None if i is None else f"i{i}") for u, i, n in rows}
    for hot_rows in (1, 5, None):
        got = restore_ids(df, users, items, hot_rows).select("n", "user_id", "item_id").collect()
        assert len(got) == len(rows) and {tuple(r) for r in got} == want
    assert restore_ids(df.limit(0), users, items, 1).count() == 0
