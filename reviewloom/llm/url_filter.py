"""URL filter: host-suffix and path-prefix expressions, joined to rules on short digests.

Every rule and every expression of a URL is ``host + path``.  A rule fits a URL when
one of the URL's expressions has its digest; the equi-join runs on the first
characters of the digests and full digests confirm.  Expressions are made only for
the shapes that rules have (labels in the host, characters in the path), so a long
path costs no more than a short one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.text import ascii_lower, fresh, others

PREFIX = 8            # hex characters of a digest that are joined on
BROADCAST_RULES = 200_000  # rows of about 200 bytes; more rules are joined by shuffle


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; those names replace columns of ``pages``.

    ``rules`` has host, path and verdict ("allow" or "block").  A rule fits its host
    and all subdomains when the URL's path starts with the rule's.  The longest
    ``host + path`` wins, then the longest host, then "block".  Null URLs and URLs
    without ``://`` have an empty host and path and get the default, as does every URL
    when there are no rules.  Repeated rows keep their own result rows; rules with a
    null host, path or verdict fit nothing.
    """
    ready = (rules.select("host", "path", "verdict").dropna().distinct()
                  .withColumn("_rule", F.concat("host", "path"))
                  .withColumn("_labels", F.size(F.split("host", r"\."))).withColumn("_chars", F.length("path")))
    digests = (ready.withColumn("_full", F.sha2("_rule", 256))
                    .select(F.substring("_full", 1, PREFIX).alias("_prefix"), "_full", "_rule", "_chars",
                            F.length("host").alias("_host_chars"), F.col("verdict").alias("_verdict")))
    # One row per shape, not per rule: bounded by labels in a host times lengths of a path.
    shapes = [(r["_labels"], r["_chars"]) for r in ready.select("_labels", "_chars").distinct().collect()]
    kept, chosen = others(pages, "host", "path", "rule", "verdict"), fresh(pages, "_best")
    parsed = pages.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    if not shapes:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    few = digests.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES

    # Equal URLs are judged once.
    labels = F.split("host", r"\.")
    expressions = [
        F.when((F.size(labels) >= n) & (F.length("path") >= chars),
               F.concat(F.array_join(F.slice(labels, F.size(labels) - n + 1, F.lit(n)), "."), F.substring("path", 1, chars)))
        for n, chars in shapes]
    expanded = (parsed.select("host", "path").distinct()
                      .select("host", "path", F.explode(F.array_compact(F.array(*expressions))).alias("_expression"))
                      .withColumn("_digest", F.sha2("_expression", 256))
                      .withColumn("_prefix", F.substring("_digest", 1, PREFIX)))
    hits = (expanded.join(F.broadcast(digests) if few else digests, "_prefix")
                    .filter(F.col("_digest") == F.col("_full")))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        F.length("_rule").alias("chars"), F.col("_host_chars").alias("host_chars"),
        (F.col("_verdict") == "block").alias("blocks"), F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"))).alias(chosen))
    judged = parsed.join(best, ["host", "path"], "left")
    return judged.select(*kept, "host", "path", F.col(chosen)["rule"].alias("rule"),
                         F.coalesce(F.col(chosen)["verdict"], F.lit(default)).alias("verdict"))
