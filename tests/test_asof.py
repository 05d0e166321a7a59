import random
from datetime import datetime, timedelta, timezone

import pytest

from reviewloom.operators.asof import asof_join

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
TTL = timedelta(days=3)


def at(days, micros=0):
    return T0 + timedelta(days=days, microseconds=micros)


def brute(entities, features, ttl):
    out = {}
    for eid, key, when in entities:
        best = None
        for fkey, ftime, created, value in features:
            if key is None or when is None or fkey != key or ftime > when:
                continue
            if best is None or (ftime, created) > (best[0], best[1]):
                best = (ftime, created, value)
        if best and ttl is not None and not best[0] > when - ttl:
            best = None
        out[eid] = best[2] if best else None
    return out


def run(spark, entities, features, ttl=TTL, **options):
    e = spark.createDataFrame(entities, "eid int, k string, event_timestamp timestamp")
    f = spark.createDataFrame(features, "k string, event_timestamp timestamp, created int, v double")
    rows = asof_join(e, f, "k", ["v"], ttl=ttl, created="created", **options).collect()
    assert len(rows) == len(entities)
    return {r.eid: r.v for r in rows}


def test_borders(spark):
    entities = [(1, "a", at(10)), (2, "a", at(4, -1)), (3, "a", at(4)), (4, "a", at(0)), (5, "a", at(1)), (6, "b", at(5)), (7, None, at(5)), (8, "a", None)]
    features = [("a", at(1), 1, 1.0), ("a", at(1), 2, 2.0), ("a", at(20), 1, 9.0), (None, at(1), 1, 7.0)]
    found = run(spark, entities, features)
    assert found == {1: None, 2: 2.0, 3: None, 4: None, 5: 2.0, 6: None, 7: None, 8: None}
    assert found == brute(entities, features, TTL)


@pytest.mark.parametrize("versions", [1, 6])
@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 3])
@pytest.mark.parametrize("ttl", [None, timedelta(days=2)])
def test_same_as_brute_force(spark, versions, hot_rows, ttl):
    rng = random.Random(versions)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    entities = [(i, rng.choice(keys), at(rng.randrange(12))) for i in range(120)]
    features, seen = [], set()
    for i in range(80):
        key, when = rng.choice(["hot", "hot", "a", "d"]), at(rng.randrange(12), rng.randrange(2))
        if versions == 1 and key in seen:
            continue
        seen.add(key)
        features.append((key, when, i, float(i)))
    assert run(spark, entities, features, ttl, hot_rows=hot_rows, chunks=5) == brute(entities, features, ttl)


def test_repeated_moments_of_a_hot_key(spark):
    entities = [(i, "hot", at(5)) for i in range(200)]
    features = [("hot", at(1 + i % 3), i, float(i)) for i in range(50)]
    assert run(spark, entities, features, None, hot_rows=10, chunks=8) == brute(entities, features, None)


def test_hot_and_usual_keys_together(spark):
    entities = [(i, "hot" if i % 2 else f"k{i % 50}", at(i % 40)) for i in range(400)]
    features = [("hot" if i % 2 else f"k{i % 50}", at(i % 37, i), i, float(i)) for i in range(300)]
    assert run(spark, entities, features, timedelta(days=4), hot_rows=100) == brute(entities, features, timedelta(days=4))


def test_empty_sides(spark):
    assert run(spark, [(1, "a", at(1))], []) == {1: None}
    assert run(spark, [], [("a", at(1), 1, 1.0)]) == {}
