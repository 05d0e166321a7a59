import hashlib
import random

import brute

from reviewloom.llm import substrings


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 90))) for _ in range(12)]
    docs = {}
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 7)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))))
        docs[i] = rng.choice([" ", "\n", "\t \x0b"]).join(parts)
    docs[n] = "a " * 500
    docs[n + 1] = "a b " * 300
    docs[n + 2] = ""
    docs[n + 3] = docs[0] = docs[5]
    docs[n + 4] = "é x y " * 30
    docs[n + 5] = " ".join(str(i % 97) for i in range(30_000))
    return docs


def run(spark, rows, window=20):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, first int")
    got = substrings.remove_repeats(docs, window).collect()
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got]


def check(spark, docs, window=20):
    got = {i: (n, gone, hashlib.sha256((t or "").encode()).hexdigest()) for i, n, gone, t in run(spark, [(i, t, None, 1) for i, t in docs.items()], window)}
    assert got == brute.repeated_words(docs, window)


def test_agrees_with_all_windows(spark):
    check(spark, corpus())


def test_short_windows(spark):
    check(spark, corpus(2, 60), 4)


def test_anchor_with_many_stretches(spark, monkeypatch):
    rng = random.Random(4)
    common = " ".join(f"c{i}" for i in range(16))
    docs = {i: " ".join([f"x{rng.randrange(8)}" for _ in range(6)] + [common] + [f"y{rng.randrange(8)}" for _ in range(6)]) for i in range(300)}
    monkeypatch.setattr(substrings, "MANY_STRETCHES", 5)
    check(spark, docs)


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"v{i}" for i in range(30))
    got = run(spark, [(3, text, "", 1), (3, text, "", 1), (None, None, None, None), (1, None, "", 2)])
    assert sorted(got, key=str) == sorted([(3, 30, 0, text), (3, 30, 0, text), (None, 0, 0, None), (1, 0, 0, None)], key=str)
    assert sorted(run(spark, [(3, text, "", 1), (None, text, "", 1)]), key=str) == sorted([(3, 30, 30, ""), (None, 30, 0, text)], key=str)
    assert run(spark, []) == []


def test_automaton_gives_longest_matches():
    rng = random.Random(2)
    for _ in range(200):
        seen = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        automaton = substrings.SuffixAutomaton()
        for s in seen:
            automaton.add(s)
        text = [rng.randrange(3) for _ in range(15)]
        subs = {tuple(s[i:j]) for s in seen for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        want = [max([n for n in range(e + 2) if n == 0 or tuple(text[e + 1 - n:e + 1]) in subs]) for e in range(len(text))]
        assert automaton.matches(text) == want
