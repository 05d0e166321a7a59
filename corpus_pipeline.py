"""Prepare a corpus in five stages: toxicity, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and is
written as Parquet and read again before the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.decontaminate import decontaminate
from reviewloom.llm.lines import dedup_lines
from reviewloom.llm.minhash import drop_near_duplicates
from reviewloom.llm.mixing import mix_sources
from reviewloom.llm.registry import Entry, table
from reviewloom.llm.toxicity import fit_on, score_toxicity
from reviewloom.session import written

# SQL has no equivalent of the first stages; tests compare each with a brute-force version.
ORACLE_SQL = None


def _aside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], made: tuple[str, ...]) -> DataFrame:
    """Run ``stage`` with columns of ``docs`` that have names which it makes under other names meanwhile."""
    renamed = {c: f"_own_{c}" for c in docs.columns if c.lower() in made}
    out = stage(docs.withColumnsRenamed(renamed))
    return out.drop(*made).withColumnsRenamed({new: old for old, new in renamed.items()}).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score of 0.7 and more) go."""
    model = fit_on(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return _aside(docs, lambda d: score_toxicity(d, model).filter("predicted = 0"), ("score", "predicted"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; documents keep the rest of their text."""
    def cut(given: DataFrame) -> DataFrame:
        out = dedup_lines(given)
        if "n_chars" in given.columns:
            kind = given.schema["n_chars"].dataType
            out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
        return out

    return _aside(docs, cut, ("n_lines", "n_removed"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles stays."""
    return drop_near_duplicates(docs, length=5, percent=80).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word passage of the benchmark go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _aside(docs, lambda d: decontaminate(d, benchmark), ("n_words", "n_hit", "n_items", "items", "spans", "contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many copies of each document the mix takes."""
    return mix_sources(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ENTRIES = {"pipeline": Entry(run, ORACLE_SQL)}
