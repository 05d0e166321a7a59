"""Columns named like what an operator makes or uses, in another case: given values stay, made ones are replaced."""

from reviewloom.llm.decontaminate import contamination
from reviewloom.llm.mixing import mix_sources
from reviewloom.llm.substrings import remove_repeats
from reviewloom.llm.url_filter import judge_urls


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "mine", "gone")], "page_id long, url string, _BEST string, Host string")
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    row = judge_urls(pages, rules).first()
    assert (row["_BEST"], row["host"], row["verdict"]) == ("mine", "a.org", "block")
    assert judge_urls(pages, rules.limit(0)).first()["verdict"] == "allow"


def test_repeats(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "a", "b", "c"), (2, text, "d", "e", "f")], "doc_id long, text string, _doc string, _FLAGS string, N_Words string")
    got = {r["doc_id"]: (r["_doc"], r["_FLAGS"], r["n_words"], r["n_removed"]) for r in remove_repeats(docs).collect()}
    assert got == {1: ("a", "b", 30, 0), 2: ("d", "e", 30, 30)}


def test_contamination(spark):
    text = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text, "a", "b", "c"), (2, "x", "d", "e", "f")], "doc_id long, text string, _id string, N_WORDS string, _spans string")
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    got = {r["doc_id"]: (r["_id"], r["_spans"], r["n_words"], r["n_hit"]) for r in contamination(docs, bench).collect()}
    assert got == {1: ("a", "c", 12, 12), 2: ("d", "f", 1, 0)}
    assert contamination(docs, bench.limit(0)).count() == 2


def test_very_long_text_in_a_mix(spark):
    docs = spark.createDataFrame([(1, "a", "word " * 300_000), (2, "a", "x y"), (3, "b", "z " * 50_000)], "doc_id long, source string, text string")
    rows = {r["doc_id"]: r for r in mix_sources(docs).collect()}
    assert rows[1]["size"] == 300_000 and all(r["taken"] <= 3 * r["size"] for r in rows.values())
