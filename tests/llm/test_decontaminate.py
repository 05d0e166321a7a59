import random

import brute
from pyspark.sql import functions as F

from reviewloom.llm.decontaminate import contamination, decontaminate


def plain(docs, items, window):
    windows = {}
    for item, text in items:
        words = brute.normal_words(text)
        n = min(window, len(words))
        for s in range(len(words) - n + 1) if words else ():
            windows.setdefault(tuple(words[s:s + n]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = brute.normal_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                got = windows.get(tuple(words[s:s + n]))
                if got:
                    hit |= set(range(s, s + n))
                    found |= got
        out.append((doc, len(words), len(hit), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, items int"),
            spark.createDataFrame(items, "item_id long, text string"))


def marked(df):
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()], key=str)


def test_agrees_with_all_windows(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["a", "B", "c3", "é", "Ü", "x-y", "z"])
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 16)))) for i in range(40)] + [(100, None), (101, "!!"), (102, "Solo")]
    docs = [(i, " ".join(word() for _ in range(rng.randrange(0, 80))) + " " + (rng.choice(items)[1] or "")) for i in range(80)]
    docs += [(500, None), (501, ""), (None, items[3][1]), (502, "solo"), (502, "solo"), (503, " ".join(["z"] * 20_000))]
    d, b = frames(spark, docs, items)
    assert marked(contamination(d, b, window=5)) == plain(docs, items, 5)
    assert marked(contamination(d, b)) == plain(docs, items, 10)


def test_spans_and_removal(spark):
    d, b = frames(spark, [(1, "p q r s t u v"), (2, "nothing here"), (3, None)], [(7, "q R"), (8, "r s"), (9, "u")])
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in contamination(d, b, window=2).collect()}
    assert got == {1: [(2, 4), (6, 6)], 2: [], 3: []}
    assert sorted(r["doc_id"] for r in decontaminate(d, b, window=2).collect()) == [2, 3]
    assert decontaminate(d, b, window=2).columns == d.columns
    assert decontaminate(d, b, keep=lambda m: F.col("n_hit") < 4 + 1, window=2).count() == 3


def test_empty_tables(spark):
    d, b = frames(spark, [(1, "a b c")], [])
    assert marked(contamination(d, b)) == [(1, 3, 0, [], False)]
    d, b = frames(spark, [], [(1, "a b c")])
    assert marked(contamination(d, b)) == []


def test_no_python_in_the_plan(spark):
    d, b = frames(spark, [(1, "a b c")], [(1, "a b c")])
    plan = contamination(d, b)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
