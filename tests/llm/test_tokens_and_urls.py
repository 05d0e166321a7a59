import random

import public_tokenizers
from tokenizers import Tokenizer

from reviewloom.llm.tokens import PairVocabulary, count_tokens
from reviewloom.llm.url_filter import judge_urls

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(1)
    letters = list("aab  \n\t'sé1,.ß漢\x1c\x85") + ["<|endoftext|>", "the", " of", "'ll"]
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    return [*out, None, "", "a" * 5000, "é" * 3000, " " * 1000, "ab" * 4000, "<|endoftext|>" * 3, "word " * 50_000]


def test_counts_agree_with_the_library(spark):
    rows = list(enumerate(texts()))
    known = Tokenizer.from_file(PATH)
    want = {i: len(known.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    df = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(None, "a b", "y")], "doc_id long, text string, n_tokens string")
    got = {r["doc_id"]: r for r in count_tokens(df, PATH).collect()}
    assert {i: r["n_tokens"] for i, r in got.items() if i is not None} == want
    assert all(got[i]["n_bytes"] == len((t or "").encode()) and got[i]["over_limit"] == (want[i] > 512) for i, t in rows)
    assert got[None]["n_tokens"] == 2
    assert count_tokens(df.limit(0), PATH).collect() == []


def test_forgetting_known_words_changes_nothing(monkeypatch):
    monkeypatch.setattr("reviewloom.llm.tokens.KNOWN_WORDS", 10)
    some = texts()[:300]
    assert PairVocabulary(PATH).count_texts(some) == [PairVocabulary(PATH).count_texts([t])[0] for t in some]


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("a.com", "", "block"), ("b.com", "/x", "allow"), ("b.com", "/x", "block")]


def plain(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_verdicts_agree_with_all_rules(spark):
    rng = random.Random(2)
    urls = [None, "", "no scheme", "://", "http://ORG", "http://x.org?/es/", "http://É.Example.ORG/es/1#/de/", "http://xorg/", "http://.org/", "http://a.com", "http://q.a.com/de/",
            "https://a://b.com/x", "http://" + "a." * 300 + "com/de/", "http://com/de/" + "y" * 100_000, "http://b.com/x/y"]
    urls += [f"http{rng.choice('s ')}://{rng.choice(['www.', '', 'a.b.'])}{rng.choice(['example.org', 'a.com', 'b.com', 'c.net'])}{rng.choice(['/', '', '/es/', '/de/', '/x', '?q'])}{i}" for i in range(200)]
    pages = spark.createDataFrame([(i, u, "r", 1) for i, u in enumerate(urls)] + [(None, urls[5], "r", 1)], "page_id long, url string, rule string, chars int")
    for rules in (RULES, RULES + [(None, "/", "block"), ("z", None, "allow")], []):
        got = judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
        rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
        valid = [r for r in rules if None not in r]
        assert rows == {**{i: plain(u, valid) for i, u in enumerate(urls)}, None: plain(urls[5], valid)}
    assert judge_urls(pages.limit(0), spark.createDataFrame(RULES, "host string, path string, verdict string")).collect() == []
