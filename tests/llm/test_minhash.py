import random

import brute
import numpy as np
import pytest

from reviewloom.llm import minhash
from reviewloom.llm.components import components


def run(spark, rows, length=2, percent=80):
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, component long")
    return [tuple(r) for r in minhash.near_duplicates(docs, length, percent).collect()]


def copies(rng, n, base, edits):
    words = base.split()
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = "x" + str(rng.randrange(10**6))
        out.append(" ".join(w))
    return out


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    for group in range(6):
        base = " ".join(rng.choice(vocabulary) for _ in range(60))
        texts += copies(rng, 30, base, 8)
    texts += ["one", "one", "One two", "one two", "", None, None, " \t\n ", "é É", "É é"] + ["same text here"] * 20
    texts += [" ".join(["a b c"] * 4000), " ".join(["a b c"] * 4001)]
    rng.shuffle(texts)
    return dict(enumerate(texts, start=10))


def test_components_and_sets_agree_with_all_pairs(spark):
    docs = corpus()
    got = {r[0]: r[1:] for r in run(spark, [(i, t, "k", 1) for i, t in docs.items()])}
    assert got == brute.near_duplicates(docs, 2, 80)


def test_five_words(spark):
    docs = corpus()
    got = {r[0]: r[1:] for r in run(spark, [(i, t, None, None) for i, t in docs.items()], 5, 80)}
    assert got == brute.near_duplicates(docs, 5, 80)


def test_large_blocks_and_no_star_links(spark, monkeypatch):
    """A chain: neighbours are similar, the ends are not, so the smallest node links few."""
    rng = random.Random(5)
    words = [f"v{rng.randrange(10**6)}" for _ in range(60)]
    docs = {}
    for i in rng.sample(range(200), 200):
        docs[i] = " ".join(words)
        words[rng.randrange(60)] = f"v{rng.randrange(10**6)}"
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", 8)
    monkeypatch.setattr(minhash, "SET_BLOCK", 500)
    got = {r[0]: r[1:] for r in run(spark, [(i, t, "", 0) for i, t in docs.items()])}
    assert got == brute.near_duplicates(docs, 2, 80)


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c", "k", 1), (None, None, "k", 1), (4, "a b c", None, None), (4, "a b c", None, None), (9, "a b c", "k", 2), (7, "", "", 3)]
    assert sorted(run(spark, rows), key=str) == sorted(
        [(None, 2, None, True), (None, 0, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False), (7, 0, 7, True)], key=str)
    assert run(spark, []) == []


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[1000:]
    got = minhash.estimates(*(np.frombuffer(minhash.packed(minhash.minima(x)), dtype=np.uint8) for x in (a, b)))
    assert got == pytest.approx(1 / 3, abs=0.12)


def test_components(spark):
    links = [(5, 1), (5, 7), (7, 9), (20, 21), (22, 21), (30, 30)] + [(100 + i, 101 + i) for i in range(50)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in brute.roots({x for p in links for x in p}, links).items() if k != 30}


def test_a_large_component_does_not_come_again_with_every_straggler(spark):
    """Each of twenty linked documents shares a bucket with a pair of its own that is more of that bucket."""
    large, pairs = list(range(20)), [(100 + 2 * i, 101 + 2 * i) for i in range(20)]
    labels = spark.createDataFrame([(n, 0) for n in large] + [(n, a) for a, b in pairs for n in (a, b)], "node long, component long")
    members = spark.createDataFrame([(1000 + i, n) for i in large for n in (i, *pairs[i])], "group long, node long")
    rest = [tuple(r) for r in minhash._open(members, labels.select("node"), labels).collect()]
    assert sorted(rest) == [(0, n, 0) for n in large] + [(0, n, a) for a, b in pairs for n in (a, b)]
