import math
import random
from collections import Counter

import brute
import numpy as np
import pytest

from reviewloom.llm import search as searching
from reviewloom.llm.search import search


def plain(docs, queries, k):
    """docs: (id, text) rows; queries: (item, text) rows -> {item: [(rank, id, score)]}, every document scored."""
    words = [(i, Counter(brute.normal_words(t))) for i, t in docs]
    words = [(i, c) for i, c in words if c]
    n_docs, n_terms = len(words), sum(sum(c.values()) for _, c in words)
    asked = {}
    for item, text in set(queries):
        asked.setdefault(item, Counter()).update(brute.normal_words(text))
    out = {}
    for item, terms in asked.items():
        df = {t: sum(t in c for _, c in words) for t in terms}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        scores = []
        for i, c in words:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(q * weight[t] * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in terms.items() if c[t])
            if score > 0:
                scores.append((-score, math.inf if i is None else i))
        if scores:
            out[item] = [(r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def found(spark, docs, queries, k=20):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, _text int")
    asked = spark.createDataFrame([(i, t, "x") for i, t in queries], "item_id long, text string, doc_id string")
    out = {}
    for r in search(docs, asked, k).collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {i: sorted(v) for i, v in out.items()}


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " -- "), (None, docs[3][1]), (None, "w9 w8 zz"), (7, docs[7][1]), (7, docs[7][1]), (n + 3, "W1, w2;W3 é" * 9_000)]
    docs += [(2 * n + i, docs[40][1]) for i in range(60)]
    queries = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 20, 60])))) for i in range(25)]
    queries += [(30, None), (31, "..."), (32, "unheard of"), (33, "W2 w2 w2"), (33, "W2 w2 w2"), (34, "w1"), (34, "w2"), (None, "w5 w200 é"), (35, docs[40][1]), (36, "ZZ")]
    return docs, queries


@pytest.mark.parametrize("postings", [10 ** 6, 500])
def test_agrees_with_scoring_every_document(spark, monkeypatch, postings):
    monkeypatch.setattr(searching, "BLOCK_POSTINGS", postings)
    docs, queries = corpus()
    want = plain(docs, queries, 20)
    assert found(spark, docs, queries) == want
    assert 30 not in want and 32 not in want and len(want[33]) == 20 and None in want
    assert any(i is None for rows in want.values() for _, i, _ in rows)


def test_passes_over_the_documents(spark, monkeypatch):
    monkeypatch.setattr(searching, "QUERY_TERMS", 100)
    docs, queries = corpus(200, 2)
    assert found(spark, docs, queries, 5) == plain(docs, queries, 5)


def test_empty_tables(spark):
    docs, queries = corpus(50, 3)
    assert found(spark, [], queries) == {} and found(spark, docs, []) == {}
    assert found(spark, [(1, None)], queries) == {} and found(spark, docs, [(1, "")]) == {}
    assert found(spark, [(1, "a b")], [(1, "a")]) == plain([(1, "a b")], [(1, "a")], 20)


def block_of(rng, n_docs, n_terms, share):
    has = rng.random((n_docs, n_terms)) < share
    docs, terms = np.nonzero(has)
    return docs, terms, rng.integers(1, 1000, len(docs))


def test_range_maxima_agree_with_every_range():
    rng = np.random.default_rng(5)
    docs, terms, impacts = block_of(rng, 70, 5, 0.4)
    block = searching.Postings(docs, terms, impacts, 70)
    lists = np.arange(5)
    for low in range(70):
        for high in range(low, 71):
            at, most = block.highest(block.place(lists, np.array([low])), block.place(lists, np.array([high])))
            for t in range(5):
                inside = impacts[(terms == t) & (docs >= low) & (docs < high)]
                assert most[0, t] == (inside.max() if len(inside) else 0)
                if len(inside):
                    assert block.impacts[at[0, t]] == most[0, t] and low <= block.docs[at[0, t]] < high


def test_few_documents_are_scored_where_one_term_decides():
    rng = np.random.default_rng(6)
    docs, terms, impacts = block_of(rng, 5_000, 12, 0.3)
    block = searching.Postings(docs, terms, impacts, 5_000)
    ids = rng.permutation(5_000)
    for weights in (np.array([1000] + [1] * 11), np.arange(1, 13), np.zeros(12, dtype=np.int64)):
        best = searching.Best.none(20)
        scored = searching.search_block(block, ids, np.arange(12), weights, best)
        total = np.zeros(5_000, dtype=np.int64)
        np.add.at(total, docs, impacts * weights[terms])
        order = [d for d in np.lexsort((ids, -total))[:20] if total[d] > 0]
        assert best.ids.tolist() == ids[order].tolist() and best.scores.tolist() == total[order].tolist()
        assert scored < (500 if weights[0] == 1000 else 5_001)
