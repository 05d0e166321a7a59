import numpy as np
import pytest

from reviewloom.llm import whitening
from reviewloom.llm.whitening import polar, spectral_components, whiten

NAMES = "vec_id long, embedding array<float>, x int, Component string"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "c") for i, v in rows],
                                 NAMES.replace("float", kind))


def brute(rows, k=16):
    """By Python integers and numpy's own eigensolver."""
    coded = [(i, tuple(int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in coded})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[float(x[j] * n - s[j]) / n for j in range(d)] for x in fit])
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = {}
    for i, x in coded:
        w = np.array([float(x[j] * n - s[j]) / n for j in range(d)]) @ v / np.sqrt(e)
        out[i] = sum((n * x[j] - s[j]) ** 2 for j in range(d)), w
    return out, n, e


def check(spark, rows, k=16, kind="float"):
    want, n, e = brute(rows, k)
    got = {}
    for r in whiten(frame(spark, rows, kind), k).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == set(want)
    first = got[rows[0][0]]
    assert sorted(first) == list(range(1, len(e) + 1))
    # One sign a component, from the row that it is largest in.
    signs = []
    for c in range(len(e)):
        at = max(want, key=lambda i: abs(want[i][1][c]))
        signs.append(np.sign(want[at][1][c] * got[at][c + 1]["whitened"]))
    for i, (deviation, w) in want.items():
        for c, r in got[i].items():
            assert r["n"] == n and r["deviation"] == deviation
            assert abs(r["whitened"] * signs[c - 1] - w[c - 1]) < 1e-7
            assert r["identity_error"] < 1e-9
    return got


def test_agrees_with_a_plain_version(spark):
    rng = np.random.default_rng(1)
    mixing = rng.normal(size=(24, 24))
    rows = [(i, (mixing @ rng.normal(size=24) + 3).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[i][1]) for i in range(300)]
    got = check(spark, rows)
    assert all(len(g) == 16 for g in got.values())
    total = sum(r["explained"] for r in got[0].values())
    assert 0 < total <= 1
    check(spark, rows, k=5, kind="double")


def test_rows_that_take_no_part_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(50)] + [(60, [0.0, 0.0, 0.0])]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 1.0]), (103, [1.0, float("-inf"), 1.0]), (104, [1.0]), (105, []),
           (106, [1e30, 0.0, 0.0])]
    df = frame(spark, rows + bad + [(0, rows[0][1]), (None, rows[1][1])])
    got = whiten(df).collect()
    assert sorted(r["component"] for r in got if r["vec_id"] == 0) == [1, 1, 2, 2, 3, 3]
    assert sum(r["vec_id"] is None for r in got) == 3 and len(got) == 3 * 53 and {r["n"] for r in got} == {51}
    check(spark, rows)


def test_empty_equal_and_flat(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whiten(frame(spark, [(1, []), (2, [])])).collect() == []
    flat = whiten(frame(spark, [(i, [float(i), 5.0, -float(i)]) for i in range(20)])).collect()
    assert {r["component"] for r in flat} == {1} and all(r["identity_error"] < 1e-9 and abs(r["explained"] - 1) < 1e-9 for r in flat)


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i % 3) * 2.0 ** 40, float(i)]) for i in range(30)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(frame(spark, rows, "double")).collect()}
    coded = [[int(c * 64) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(x[j] for x in coded) for j in range(2)]
    want = [sum((30 * x[j] - sums[j]) ** 2 for j in range(2)) for x in coded]
    assert got == {i: w if w < 2 ** 63 else None for i, w in enumerate(want)} and None in got.values()
    # Beyond 32 bits but within a long: exact.
    rows = [(i, [float(i % 7) * 2.0 ** 17]) for i in range(70)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(frame(spark, rows, "double")).collect()}
    assert got == {i: (7 * (i % 7) * 2 ** 23 - 21 * 2 ** 23) ** 2 for i in range(70)}


@pytest.mark.parametrize("values", [range(1, 65), [1e-9 * 3 ** i for i in range(40)], [5.0] * 10 + [1.0] * 6, [1 + 1e-9 * i for i in range(20)],
                                    [2.0] * 8, [3.0, 0.0, 0.0, 0.0], [1.0], [4.0, 2.0, 0.0, -2.0, -4.0], [1, 1, 1, 1, 1, 1, 1, 1e8]])
def test_components_of_known_matrices(values):
    rng = np.random.default_rng(3)
    values = np.array(sorted(values, reverse=True), dtype=float)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, v = spectral_components(a)
    scale = np.abs(values).max()
    assert np.allclose(e, values, rtol=0, atol=1e-13 * scale * len(values))
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-13 * len(e)
    assert np.abs(a @ v - v * e).max() < 1e-13 * scale * len(e)


def test_polar_factor_has_the_signs():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = np.array([10.0 ** -i for i in range(12)]) * np.where(np.arange(12) % 2, 1, -1)
    assert np.abs(polar((q * values) @ q.T) - (q * np.sign(values)) @ q.T).max() < 1e-3
    values = np.array([1.0, -2, 3, -4] * 3)
    assert np.abs(polar((q * values) @ q.T) - (q * np.sign(values)) @ q.T).max() < 1e-13
    assert np.array_equal(polar(np.zeros((3, 3))), np.eye(3))
