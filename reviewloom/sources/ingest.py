"""Ingest of review JSONL: new files only, good rows by category, bad lines with their reason.

A folder of raw files grows; each run takes the files that no run before it has taken,
named in a log, and writes them under a run of its own before the log says so.  A run
that is lost leaves nothing a reader sees, and the next one takes its files again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.sampling import cap_per_group
from reviewloom.session import written
from reviewloom.sources.readers import REVIEW_SCHEMA, SAMPLE_PER_CATEGORY, list_files
from reviewloom.sources.writers import ROWS_PER_PART
from reviewloom.store.buckets import CommitLog

REJECTS = "file string, line string, reason string"


def _reason(parsed: Column) -> Column:
    """Why a parsed line is no review; null for a good one."""
    item = F.coalesce(parsed["parent_asin"], parsed["asin"])
    return (F.when(parsed.isNull() | parsed["_broken"].isNotNull(), "not a review object")
             .when(F.coalesce(parsed["user_id"], F.lit("")) == "", "no user")
             .when(F.coalesce(item, F.lit("")) == "", "no item")
             .when(parsed["rating"].isNull() | F.isnan(parsed["rating"]) | ~parsed["rating"].between(0, 5), "no rating from 0 to 5")
             .when(parsed["timestamp"].isNull(), "no time"))


def read_reviews(spark: SparkSession, files: list[str], extra: T.StructType | None = None) -> DataFrame:
    """Lines of JSONL files parsed one by one: ``file``, ``line``, ``review`` (null fields where absent) and ``reason`` (null if good).

    Blank lines are left out.  A field of another type than declared makes its line bad,
    so no value is lost silently.
    """
    fields = [*REVIEW_SCHEMA.fields, *(extra.fields if extra else [])]
    schema = T.StructType([*fields, T.StructField("_broken", T.StringType())])
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    parsed = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    marked = lines.filter(F.trim("line") != "").withColumn("_parsed", parsed).withColumn("reason", _reason(F.col("_parsed")))
    return marked.select("file", "line", F.struct(*[F.col(f"_parsed.{f.name}") for f in fields]).alias("review"), "reason")


class ReviewIngest:
    """Tables ``reviews`` (by run and category) and ``rejects`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str, extra: T.StructType | None = None) -> None:
        self.spark, self.path, self.extra = spark, path.rstrip("/"), extra
        self.log = CommitLog(spark, f"{self.path}/log")

    def taken(self) -> set[str]:
        return {f for e in self.log.read().values() for f in e["files"]}

    def run(self, folder: str, category: str | None = None, per_category: int | None = None) -> DataFrame:
        """Take the files of ``folder`` that are new; returns per file its good rows and bad lines by reason.

        ``category`` names the category of files that do not carry it in their rows;
        ``per_category`` keeps so many rows of each, chosen by digest, in this run
        (``SAMPLE_PER_CATEGORY`` is the size of a sample).
        """
        while True:
            seen = max(self.log.numbers(), default=0)
            known = self.taken()
            new = [f for f in list_files(self.spark, folder) if f not in known]
            if not new:
                return self.spark.createDataFrame([], "file string, reason string, lines bigint")
            run = uuid.uuid4().hex
            parsed = written(read_reviews(self.spark, new, self.extra), "parsed")
            good = parsed.filter("reason IS NULL").select("file", "review.*")
            if "category" not in good.columns:
                good = good.withColumn("category", F.lit(category))
            good = good.withColumn("category", F.coalesce("category", F.lit(category or "unknown")))
            kept = good if per_category is None else cap_per_group(good, "category", per_category, ("user_id", "parent_asin", "asin", "timestamp", "text"))
            # A category may hold most rows: files are bounded, tasks write what they have read.
            (kept.drop("file").write.option("maxRecordsPerFile", ROWS_PER_PART).option("compression", "snappy")
                 .partitionBy("category").parquet(f"{self.path}/reviews/run={run}"))
            parsed.filter("reason IS NOT NULL").select("file", "line", "reason").write.parquet(f"{self.path}/rejects/run={run}")
            counts = parsed.groupBy("file", "reason").agg(F.count("*").alias("lines"))
            lines = {f"{r['file']}|{r['reason'] or ''}": r["lines"] for r in counts.collect()}  # a few rows for each new file
            try:
                self.log.claim({"run": run, "files": new, "lines": lines}, after=seen)
            except RuntimeError:
                continue  # another run was first; what is new is looked up again
            return counts

    def _runs(self) -> list[str]:
        return [e["run"] for _, e in sorted(self.log.read().items())]

    def reviews(self) -> DataFrame | None:
        """All good rows; None before the first run."""
        return _all(self.spark, [f"{self.path}/reviews/run={r}" for r in self._runs()])

    def rejects(self) -> DataFrame:
        """All bad lines with their file and reason."""
        found = _all(self.spark, [f"{self.path}/rejects/run={r}" for r in self._runs()])
        return self.spark.createDataFrame([], REJECTS) if found is None else found


def _all(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    out = None
    for path in paths:
        part = spark.read.parquet(path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def sample_run(ingest: ReviewIngest, folder: str, category: str | None = None) -> DataFrame:
    """A run of the sample mode."""
    return ingest.run(folder, category, SAMPLE_PER_CATEGORY)
