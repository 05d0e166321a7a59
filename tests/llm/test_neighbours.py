import numpy as np
import pytest

from reviewloom.llm import neighbours


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, q string, bits int")


def brute(rows, queries, k):
    rows = sorted({(i, tuple(np.float32(x) for x in v)) for i, v in rows if usable(v) and i is not None})
    out = {}
    for q, v in {(i, tuple(np.float32(x) for x in v)) for i, v in queries if usable(v) and i is not None}:
        near = sorted((float(np.sqrt(((np.array(w, float) - np.array(v, float)) ** 2).sum())), i) for i, w in rows if i != q)[:k]
        out[q] = [(r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def found(spark, rows, queries, k=10):
    out = {}
    for r in neighbours.nearest(frame(spark, rows), frame(spark, queries), k).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("block", [4096, 64])
def test_recall_and_scores(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "FIRST_CANDIDATES", 32)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 16))
    rows = [(i, (centres[i % 5] + rng.normal(size=16)).tolist()) for i in range(1500)]
    queries = rows[::50]
    got, want = found(spark, rows, queries), brute(rows, queries, 10)
    assert set(got) == set(want)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits >= 9 * len(want)
    true = {(q, i): d for q in want for i, d in [(i, d) for _, i, d in brute(rows, queries, 1500)[q]]}
    for q, list_ in got.items():
        assert [r for r, *_ in list_] == list(range(1, 11))
        assert [d for *_, d in list_] == sorted(d for *_, d in list_)
        assert all(abs(d - true[q, i]) < 1e-12 for _, i, d in list_)


def test_ties_equal_vectors_and_unusable_rows(spark):
    bad = [(900, None), (901, [0.0, 0.0]), (902, [float("nan"), 1.0]), (903, [float("inf"), 1.0]), (904, [None, 1.0]), (None, [1.0, 1.0]), (905, [1.0, 2.0, 3.0])]
    rows = [(i, [1.0, 1.0]) for i in range(40)] + [(50 + i, [1.0, 2.0]) for i in range(5)] + [(60, [-3.0, 0.5])] * 2
    queries = [(0, [1.0, 1.0]), (7, [1.0, 1.0]), (39, [1.0, 1.0]), (50, [1.0, 2.0]), (60, [-3.0, 0.5])] + bad
    got = found(spark, rows + bad, queries)
    want = brute([r for r in rows], [q for q in queries if q[0] is not None and q[0] < 900], 10)
    assert {q: [(r, i) for r, i, _ in v] for q, v in got.items()} == {q: [(r, i) for r, i, _ in v] for q, v in want.items()}


def test_few_and_none(spark):
    assert found(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])], [(1, [1.0, 0.0])]) == {1: [(1, 2, 2 ** 0.5)]}
    assert found(spark, [], []) == {}
    assert found(spark, [(1, [1.0, 0.0])], [(1, [1.0, 0.0])]) == {}
