import json
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import reviews as rv
from reviewloom.functions import text as tx
from reviewloom.functions.catalog import category_of
from reviewloom.plans.jobs import clean_reviews, instruction_examples


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_byte_truncation_never_cuts_a_character(spark):
    texts = [c * n for c in ("a", "é", "€", "😀", "aé€😀") for n in (0, 1, 2, 3, 5, 126, 127, 128, 169, 170, 254, 255, 508, 509)]
    texts += ["x" * k + "😀" * 3 for k in range(500, 512)]
    # A replacement mark of the text itself stays, also just before the cut.
    texts += ["x" * k + "\ufffd" + c * 4 for k in range(500, 509) for c in ("é", "€", "😀", "\ufffd")]
    want = [t if len(t.encode()) <= 508 else t.encode()[:508].decode("utf-8", errors="ignore") for t in texts]
    assert column(spark, texts, tx.truncate_bytes("v")) == want
    assert column(spark, [None], tx.truncate_bytes("v")) == [None]


def test_stars_truncate_and_default_to_three(spark):
    given = [None, "4.7", "abc", "", " 2 ", "1e0", "-0.5", "nan", "inf", "5d", "3."]
    assert column(spark, given, tx.star_rating("v", is_text=True)) == [3, 4, 3, 3, 2, 1, 0, 3, 3, 3, 3]
    numbers = [None, 4.99, math.nan, math.inf, 2.0]
    assert column(spark, numbers, tx.star_rating("v"), "double") == [3, 4, 3, 3, 2]


def test_labels_and_prices(spark):
    assert column(spark, [None, 3.9, 4.0, 5.0], rv.positive_label("v"), "double") == [0.0, 0.0, 1.0, 1.0]
    assert column(spark, ["14.5", "from 14.99", "", None], rv.price_as_float("v")) == [14.5, None, None, None]


def test_sentiments(spark):
    stars = [1, 2, 3, 4, 5]
    assert column(spark, stars, tx.star_sentiment("v"), "int") == ["negative", "negative", "neutral", "positive", "positive"]
    texts = ["Overall POSITIVE, not negative", "Negative", "fine", ""]
    assert column(spark, texts, tx.text_sentiment("v")) == ["positive", "negative", "neutral", "neutral"]
    assert column(spark, texts, tx.text_sentiment("v", "mixed", True)) == ["POSITIVE", "NEGATIVE", "MIXED", "MIXED"]


def test_token_count_follows_unicode_whitespace(spark):
    texts = ["", "  ", "a b", " a\tb\n c ", "a b", "a b　c", "a\x1cb\x1fc", "one", "a​b"]
    assert column(spark, texts, tx.token_count("v")) == [len(t.split()) for t in texts]


def test_clean_text(spark):
    texts = ["<p>a  b</p>\n\tc ", "<br><br/>", "a < b", "<a\nb>x", None]
    assert column(spark, texts, tx.clean_text("v")) == ["a b c", "", "a < b", "x", None]


def test_embed_text_with_missing_parts(spark):
    df = spark.createDataFrame([("t", "x"), (None, "x"), ("t", None), (None, None)], "title string, text string")
    assert [r[0] for r in df.select(tx.embed_text()).collect()] == ["t x", " x", "t ", " "]
    assert [r[0] for r in df.select(tx.embed_text(strip=True)).collect()] == ["t x", "x", "t", ""]


def test_review_id_skips_missing_parts(spark):
    import hashlib
    df = spark.createDataFrame([("u", "i", 5), ("u", None, 5)], "user_id string, parent_asin string, timestamp bigint")
    want = [hashlib.sha256(s.encode()).hexdigest() for s in ("u_i_5", "u_5")]
    assert [r[0] for r in df.select(tx.review_id()).collect()] == want


def test_chat_prompt_parts(spark):
    df = spark.createDataFrame([("do", "in", "out"), ("do", "", ""), ("do", None, None), (None, "in", "")],
                               "instruction string, input string, output string")
    got = [r[0] for r in df.select(tx.chat_prompt(F.struct("instruction", "input", "output"))).collect()]
    assert got == ["[INST] do\n\nin [/INST] out", "[INST] do [/INST]", "[INST] do [/INST]", "[INST] \n\nin [/INST]"]


def test_category_prefixes_in_order(spark):
    ids = ["B09X", "B0A", "B00Z", "B01Z", "195", "1", "05", "03", "04", "X", ""]
    assert column(spark, ids, category_of("v")) == [
        "Electronics", "Electronics", "Home & Kitchen", "Gadgets & Accessories", "Books — Non-Fiction", "Books",
        "Books — Reference", "Books — Fiction", "Books", "General", "General"]


REVIEW = T.StructType([T.StructField(n, t) for n, t in (
    ("user_id", T.StringType()), ("parent_asin", T.StringType()), ("timestamp", T.LongType()), ("title", T.StringType()),
    ("text", T.StringType()), ("rating", T.StringType()))])


def examples(spark, rows):
    df = spark.createDataFrame(rows, REVIEW)
    return [json.loads(r.jsonl) for r in instruction_examples(clean_reviews(df)).collect()]


def test_example_length_borders(spark):
    def kinds(text):
        return sorted(len(e["metadata"]) for e in examples(spark, [("u", "i", 1, "T", text, "5")]))

    assert kinds("x" * 49) == []
    assert kinds("x" * 50) == [2]
    assert kinds("x" * 99) == [2]
    assert kinds("x" * 100) == [1, 2]
    assert kinds("<b>" + "x" * 48 + "</b>") == []       # long enough raw, too short once cleaned
    assert kinds("<p>" * 40) == []                       # tags only


def test_example_content(spark):
    found = examples(spark, [("u", "i", 1, "", "é \"quoted\"  " + "y" * 100, "4.7"), ("v", "i", 1, None, "z" * 60, "abc")])
    by_input = {e["input"]: e for e in found}
    body = "é \"quoted\" " + "y" * 100
    summary = by_input[f"Product: Unknown\nReview: {body}"]
    assert summary["metadata"] == {"rating": 4, "sentiment": "positive"} and summary["output"] == ""
    assert by_input[f"Product: Unknown\nReview (4/5 stars): {body}"]["metadata"] == {"rating": 4}
    other = by_input["Product: Unknown Product\nReview: " + "z" * 60]
    assert other["metadata"] == {"rating": 3, "sentiment": "neutral"}


def test_duplicates_by_user_and_raw_text(spark):
    text = "w" * 60
    rows = [("u", "b", 5, "late", text, "1"), ("u", "a", 2, "early", text, "5"), ("v", "a", 9, "other", text, "3"), (None, "a", 1, "n", None, "3")]
    kept = clean_reviews(spark.createDataFrame(rows, REVIEW)).collect()
    assert sorted((r.user_id, r.title) for r in kept) == [("u", "early"), ("v", "other")]


def test_normalized_timestamps(spark):
    seconds = spark.createDataFrame([("a", 100)], "asin string, unixReviewTime int")
    row = rv.normalize_reviews(seconds).first()
    assert (row.parent_asin, row.timestamp, row.helpful_vote) == ("a", 100_000, 0)
    both = spark.createDataFrame([("a", "b")], "asin string, parent_asin string")
    assert rv.unify_item_column(both).first().parent_asin == "b"
    ms = spark.createDataFrame([(1_700_000_000_987, "i", "u"), (None, "i", "u"), (1, None, "u"), (1, "i", None)],
                               "timestamp bigint, asin string, user_id string")
    done = rv.processed_reviews(ms)
    assert done.columns == ["timestamp", "item_id", "user_id", "event_timestamp"]
    assert [r[0] for r in done.select(F.unix_millis("event_timestamp")).collect()] == [1_700_000_000_000]
