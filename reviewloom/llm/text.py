"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Words of the plain kind: runs of anything but space and the control characters tab to carriage return.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
# What separates normalised words: every ASCII character that is no digit and no small letter.
NORMAL_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Rows per Arrow batch for whole texts; a batch of Spark's default 10,000 long documents would not fit a worker.
TEXT_ROWS_PER_BATCH = 64


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def normal_words(text: Column) -> Column:
    """Array of normalised words: lower-cased ASCII letters, digits and all characters beyond ASCII; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NORMAL_GAP), "")


def plain_word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("bigint")


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Join condition that also pairs nulls."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def in_small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small enough for a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))


def others(docs: DataFrame, *made: str) -> list[str]:
    """Columns of ``docs`` but those named in ``made``, in any case."""
    taken = {c.lower() for c in made}
    return [c for c in docs.columns if c.lower() not in taken]


def fresh(docs: DataFrame, base: str) -> str:
    """A helper column's name that no column of ``docs`` has, in any case."""
    taken = {c.lower() for c in docs.columns}
    while base.lower() in taken:
        base += "_"
    return base
