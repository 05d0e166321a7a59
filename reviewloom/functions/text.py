"""Text columns: cleaning, truncation, identifiers, prompts and sentiment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Length limits and prompt wording of the text sets.
MIN_REVIEW_CHARS = 50
MIN_QA_CHARS = 100
MIN_EMBED_CHARS = 20
EMBED_INPUT_CHARS = 500
VIEW_TEXT_CHARS = 511
VECTOR_TEXT_BYTES = 508
VECTOR_ID_CHARS = 500
SUMMARY_INSTRUCTION = (
    "Summarize the following product review in 1-2 sentences. "
    "Include the overall sentiment (positive/negative/neutral)."
)
QA_INSTRUCTION = (
    "Based on the following product review, answer questions about the product. "
    "Be helpful, accurate, and concise."
)

EXAMPLE_SCHEMA = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
    T.StructField("metadata", T.StructType([
        T.StructField("rating", T.IntegerType()),
        T.StructField("sentiment", T.StringType()),
    ])),
])


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(text: Column | str) -> Column:
    """Strip tags, collapse whitespace runs to one blank, trim."""
    bare = F.regexp_replace(_col(text), r"<[^>]+>", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def embed_text(title: Column | str = "title", text: Column | str = "text", strip: bool = False) -> Column:
    """Title and text joined by a blank, missing parts as empty strings."""
    empty = F.lit("")
    joined = F.concat_ws(" ", F.coalesce(_col(title), empty), F.coalesce(_col(text), empty))
    return F.trim(joined) if strip else joined


def truncate_chars(text: Column | str, limit: int) -> Column:
    return F.substring(_col(text), 1, limit)


def truncate_bytes(text: Column | str, limit: int = VECTOR_TEXT_BYTES) -> Column:
    """Longest prefix of at most ``limit`` UTF-8 bytes that does not cut a character.

    A character of up to four bytes begins at one of the four bytes from ``limit - 2`` to
    ``limit + 1``; the prefix ends before the last such beginning.
    """
    value = _col(text)
    data = F.encode(value, "UTF-8")

    def begins(at: int) -> Column:
        return ~F.hex(F.substring(data, at, 1)).between("80", "BF")

    end = F.when(begins(limit + 1), limit)
    for back in (1, 2):
        end = end.when(begins(limit + 1 - back), limit - back)
    head = F.substring(data, F.lit(1), end.otherwise(limit - 3)).cast("string")
    return F.when(F.octet_length(value) <= limit, value).otherwise(head)


def review_id(user: Column | str = "user_id", item: Column | str = "parent_asin",
              ms: Column | str = "timestamp") -> Column:
    """Stable review id: hash of user, item and time; missing parts are skipped."""
    return F.sha2(F.concat_ws("_", _col(user), _col(item), _col(ms).cast("string")), 256)


def surrogate_id() -> Column:
    """Unique number per row; it changes with the partitioning, so stable ids are preferred."""
    return F.monotonically_increasing_id()


def vector_key(identifier: Column | str) -> Column:
    """Primary key of a vector row: hex digest of the review id."""
    return F.sha2(_col(identifier).cast("string"), 256)


def star_rating(rating: Column | str, is_text: bool = False) -> Column:
    """Whole star by truncation; missing or unparsable ratings count as three."""
    value = _col(rating)
    if is_text:
        number = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
        value = F.when(value.rlike(number), F.trim(value))
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(3))


def star_sentiment(star: Column | str) -> Column:
    value = _col(star)
    return F.when(value >= 4, "positive").when(value <= 2, "negative").otherwise("neutral")


def text_sentiment(text: Column | str, fallback: str = "neutral", upper: bool = False) -> Column:
    """Sentiment word found in generated text; ``fallback="mixed"`` with ``upper`` is the display form."""
    low = F.lower(_col(text))
    found = F.when(low.contains("positive"), "positive").when(low.contains("negative"), "negative")
    found = found.otherwise(fallback)
    return F.upper(found) if upper else found


def _product(title: Column) -> Column:
    return F.when(F.length(title) > 0, title).otherwise(F.lit("Unknown"))


def summary_example(title: Column | str, text: Column | str, star: Column | str) -> Column:
    """Summarisation example as JSON; null when the text is shorter than fifty characters."""
    title, text, star = _col(title), _col(text), _col(star)
    body = F.struct(
        F.lit(SUMMARY_INSTRUCTION).alias("instruction"),
        F.concat(F.lit("Product: "), _product(title), F.lit("\nReview: "), text).alias("input"),
        F.lit("").alias("output"),
        F.struct(star.alias("rating"), star_sentiment(star).alias("sentiment")).alias("metadata"),
    )
    return F.when(F.length(text) >= MIN_REVIEW_CHARS, F.to_json(body))


def qa_example(title: Column | str, text: Column | str, star: Column | str) -> Column:
    """Question-answer example as JSON; null when the text is shorter than one hundred characters."""
    title, text, star = _col(title), _col(text), _col(star)
    body = F.struct(
        F.lit(QA_INSTRUCTION).alias("instruction"),
        F.concat(F.lit("Product: "), _product(title), F.lit("\nReview ("), star.cast("string"),
                 F.lit("/5 stars): "), text).alias("input"),
        F.lit("").alias("output"),
        F.struct(star.alias("rating")).alias("metadata"),
    )
    return F.when(F.length(text) >= MIN_QA_CHARS, F.to_json(body))


def chat_prompt(example: Column | str) -> Column:
    """Instruction, optional input and optional output of one example as a chat string."""
    value = _col(example)
    part = {name: F.coalesce(value[name], F.lit("")) for name in ("instruction", "input", "output")}
    given = F.when(F.length(part["input"]) > 0, F.concat(F.lit("\n\n"), part["input"])).otherwise("")
    answer = F.when(F.length(part["output"]) > 0, F.concat(F.lit(" "), part["output"])).otherwise("")
    return F.concat(F.lit("[INST] "), part["instruction"], given, F.lit(" [/INST]"), answer)


def summary_prompt(product: Column | str, review: Column | str) -> Column:
    """Request prompt asking for a summary of one review."""
    return F.concat(F.lit(f"[INST] {SUMMARY_INSTRUCTION}\n\nProduct: "), _col(product),
                    F.lit("\nReview: "), _col(review), F.lit(" [/INST]"))


def token_count(text: Column | str) -> Column:
    """Number of whitespace-separated tokens, with Unicode whitespace and separators as breaks."""
    pieces = F.split(_col(text), r"(?U)[\s\x1c-\x1f]+")
    return F.size(F.filter(pieces, lambda piece: piece != ""))
