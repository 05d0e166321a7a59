import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from reviewloom.llm.mixing import mix_sources, source_targets


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(1500):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "é", None, "tiny"] if i % 50 == 0 else ["a", "a", "b", "c", "é", None])
        text = rng.choice([None, ""]) if i % 97 == 0 else " ".join(["w"] * min(2000, int(rng.paretovariate(1.2) * 10)))
        rows.append((i, source, text, 5))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, taken int")


def targets(sizes, weights=(1, 2, 3)):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        rest = sum(sizes.values()) - sum(capped.values())
        whole = sum(weight[s] for s in free)
        given = {s: Fraction(rest * weight[s], whole) for s in free}
        above = {s: 3 * sizes[s] for s in free if given[s] > 3 * sizes[s]}
        if not above:
            return {s: float(capped.get(s, given.get(s))) for s in names}
        capped |= above


def test_targets_sizes_and_copies(spark):
    rows = corpus()
    got = [r.asDict() for r in mix_sources(frame(spark, rows)).collect()]
    sizes, per_source = {i: len((t or "").split()) for i, _, t, _ in rows}, {}
    for i, s, *_ in rows:
        per_source[s] = per_source.get(s, 0) + sizes[i]
    want = targets(per_source)
    taken = {}
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == per_source[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= max(sizes[i] for i, x, *_ in rows if x == s) / 2 + 1
    whole = {s: int(want[s] // per_source[s]) for s in want}
    assert all(r["copies"] - whole[r["source"]] in (0, 1) for r in got if r["size"] and want[r["source"]] < 3 * per_source[r["source"]])


def test_reruns_agree_whatever_the_partitions(spark):
    rows = corpus(2)
    one = {r["doc_id"]: r["taken"] for r in mix_sources(frame(spark, rows).repartition(2)).collect()}
    assert one == {r["doc_id"]: r["taken"] for r in mix_sources(frame(spark, rows[::-1]).repartition(7)).collect()}


def test_preferred_documents_are_likelier(spark):
    rows = [(i, "s" if i % 2 else "t", "w " * 20, 0) for i in range(2000)]
    got = mix_sources(frame(spark, rows), weights=(1, 4), preference=F.when(F.col("doc_id") < 1000, 2.0).otherwise(0.5)).collect()
    taken = lambda s, low: sum(r["taken"] for r in got if r["source"] == s and (r["doc_id"] < 1000) == low)
    for s in "st":
        target = next(r["target"] for r in got if r["source"] == s)
        assert taken(s, True) > 1.5 * taken(s, False)
        assert abs(taken(s, True) + taken(s, False) - target) <= 20


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, None, 1), (1, "a", "x y", 1), (1, "a", "x y", 1), (2, None, "", 1)]
    got = mix_sources(frame(spark, rows)).collect()
    assert len(got) == 4 and {r["taken"] for r in got if r["doc_id"] == 1} in ({2}, {4}, {0}, {6})
    assert mix_sources(frame(spark, [])).collect() == []
    assert source_targets(spark.createDataFrame([("a", 0)], "source string, size long")).first()["target"] == 0.0
