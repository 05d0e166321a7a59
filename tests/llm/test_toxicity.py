import random
import zlib

import numpy as np
import pytest

from reviewloom.llm import toxicity


def made(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        toxic = int(i % 4 == 0)
        for _ in range(2 * toxic):
            text.insert(rng.randrange(len(text) + 1), rng.choice(["stupid", "Moron!", "zuqqa" + rng.choice("xyz")]))
        rows.append((i, " ".join(text), toxic))
    return rows


@pytest.fixture(scope="module")
def quick():
    before = toxicity.UPDATES
    toxicity.UPDATES = 150
    yield
    toxicity.UPDATES = before


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "s", "l") for i, t, _ in rows], "doc_id long, text string, score string, predicted string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return docs, labels


def test_held_out_accuracy_and_scores(spark, quick):
    rows = made(900, 1)
    docs, labels = frames(spark, rows)
    model = toxicity.fit_on(docs, labels)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score_toxicity(docs, model).collect()}
    unseen = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i][1] == y for i, y in unseen]) > 0.9
    assert all(0 <= s <= 1 and p == int(s >= 0.7) for s, p in got.values())
    again = toxicity.score_toxicity(docs.repartition(7), toxicity.fit_on(docs.repartition(5), labels)).collect()
    assert max(abs(r["score"] - got[r["doc_id"]][0]) for r in again) < 1e-5


def test_held_out_labels_do_not_matter(spark, quick):
    rows = made(200, 2)
    flipped = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, t, y in rows]
    one, two = (toxicity.fit_on(*frames(spark, r)) for r in (rows, flipped))
    assert all(np.array_equal(one.p[k], two.p[k]) for k in one.p)


def test_last_words_of_a_long_text_count(quick):
    rows = made(600, 3)
    model = toxicity.fit([t.encode() for _, t, _ in rows], [y for *_, y in rows])
    clean = " ".join(["abc"] * 30_000)
    low, high = model.scores([clean.encode(), (clean + " stupid").encode()])
    assert low < 0.5 < high


def test_nulls_empty_and_missing_classes(spark):
    docs, labels = frames(spark, [(1, "a b", 0), (2, None, 0), (3, "", 0), (None, "x", 1), (1, "a b", 0)])
    model = toxicity.fit_on(docs, labels.filter("doc_id < 3"))
    assert model == 0.0
    assert [r["score"] for r in toxicity.score_toxicity(docs, model).collect()] == [0.0] * 5
    assert toxicity.score_toxicity(docs.limit(0), toxicity.Network()).collect() == []
    net = toxicity.Network()
    assert net.scores([None, b""]) == net.scores([b"", b" ..."])
    assert toxicity.score_toxicity(docs, net).count() == 5


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        rows = toxicity.window_rows(np.arange(1, n + 1, dtype=np.int32))
        assert set(rows.ravel()) - {0} == set(range(1, n + 1))
        assert all(a[toxicity.STEP] == b[0] for a, b in zip(rows, rows[1:]))


def test_gradients():
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, rows = toxicity.read_words([b"one two three four five six " * 8, b"two"])
    windows = np.concatenate([toxicity.window_rows(r) for r in rows])
    toward = np.linspace(-1, 1, len(windows))
    grads = net.gradients(words, windows, toward)
    rng = np.random.default_rng(1)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        at = np.argmax(np.abs(grads[name].reshape(-1))) if name in ("word", "char") else rng.integers(len(flat))
        step, before = 1e-3, flat[at]
        sums = []
        for x in (before + step, before - step):
            flat[at] = x
            sums.append(float((net.run(net.inputs(words)[1], windows) * toward).sum()))
        flat[at] = before
        assert (sums[0] - sums[1]) / (2 * step) == pytest.approx(grads[name].reshape(-1)[at], rel=0.03, abs=2e-4), name
