"""Review-shaped views over the TPC-H style test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per line item: customer, part, a 1-5 rating and a short text."""
    lines, orders, parts = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    lines = spread(lines.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_linenumber"), "l_orderkey")
    joined = (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
                   .join(parts, lines.l_partkey == parts.p_partkey))
    return joined.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("parent_asin"),
        (F.lit(1.0) + F.pmod(F.col("l_quantity").cast("bigint"), F.lit(5))).alias("rating"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type", "o_orderpriority").alias("text"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.col("l_linenumber").alias("helpful_vote"),
        F.col("p_type").alias("category"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product metadata: part key and price."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("parent_asin"), F.col("p_retailprice").alias("price"))


def document_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews: source as user and title, and a star from the character count."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    return docs.select(
        "doc_id",
        F.col("source").alias("user_id"),
        F.col("lang").alias("title"),
        "text",
        (F.lit(1.0) + F.pmod(F.col("n_chars"), F.lit(5))).alias("rating"),
        F.col("doc_id").cast("string").alias("parent_asin"),
        F.col("doc_id").alias("timestamp"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a session-zone timestamp and its epoch milliseconds."""
    raw = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return raw.withColumn("ms", F.unix_millis("ts"))
