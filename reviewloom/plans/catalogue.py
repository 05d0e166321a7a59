"""Named queries over the test tables, with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name; ``sql`` is None where SQL has no equivalent."""
    def add(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = Entry(run, sql)
        return run
    return add


# The review view of the test tables in the comparison engine's dialect.
REVIEWS_SQL = """reviews AS (
  SELECT cast(o.o_custkey AS varchar) AS user_id, cast(l.l_partkey AS varchar) AS parent_asin,
         1.0::double + (cast(l.l_quantity AS bigint) % 5) AS rating, p.p_name AS title,
         concat_ws(' ', p.p_name, p.p_brand, p.p_type, o.o_orderpriority) AS text,
         epoch_ms(l.l_shipdate) AS timestamp, l.l_linenumber AS helpful_vote, p.p_type AS category
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""

USERS_SQL = """user_features AS (
  SELECT user_id, avg(rating) AS user_avg_rating, count(*) AS user_review_count,
         count(DISTINCT parent_asin) AS user_unique_items, avg(length(text)) AS user_avg_review_length,
         count(DISTINCT category) AS user_category_count,
         cast(trunc((max(timestamp) - min(timestamp)) / 86400000) AS integer) AS user_tenure_days,
         max(timestamp) AS last_ms
  FROM reviews GROUP BY user_id)"""

ITEMS_SQL = """item_features AS (
  SELECT a.*, cast(m.p_retailprice AS float) AS item_price FROM (
    SELECT parent_asin AS item_id, avg(rating) AS item_avg_rating, stddev(rating) AS item_rating_stddev,
           count(*) AS item_review_count, cast(sum(helpful_vote) AS bigint) AS item_total_helpful_votes,
           avg(length(text)) AS item_avg_review_length, max(timestamp) AS last_ms
    FROM reviews GROUP BY parent_asin) a
  LEFT JOIN part m ON a.item_id = cast(m.p_partkey AS varchar))"""

DOC_REVIEWS_SQL = """doc_reviews AS (
  SELECT doc_id, source AS user_id, lang AS title, text, 1.0::double + (n_chars % 5) AS rating,
         cast(doc_id AS varchar) AS parent_asin, doc_id AS timestamp FROM documents)"""

CLEAN_SQL = """cleaned AS (
  SELECT user_id, doc_id, rating, coalesce(title, 'Unknown Product') AS title,
         trim(regexp_replace(regexp_replace(text, '<[^>]+>', '', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') AS text
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, text ORDER BY doc_id) AS rn
        FROM doc_reviews WHERE length(text) >= 50) WHERE rn = 1)"""


def hex_number(expression: str) -> str:
    """SQL for the first eight hex digits of an md5 digest as a number."""
    return f"cast('0x' || substr(md5({expression}), 1, 8) AS bigint)"
