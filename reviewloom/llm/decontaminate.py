"""Benchmark decontamination: a hash set of normalised test n-grams against the windows of every document.

Only DataFrame functions.  A window is hashed by its first, middle and last word.  The
hashes of a document's windows are exploded and probed against the benchmark's windows
inside one generated stage; all words of a hit are compared there, so windows that
agree in the hash alone are no hit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.text import fresh, normal_words, others

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000  # windows of about 150 bytes; more are joined by shuffle


def _hash(words: str, start: str, length: str) -> str:
    """SQL for the hash of a window that begins at word ``start``, from 0."""
    return (f"xxhash64({words}[{start}], {words}[{start} + ({length}) div 2], {words}[{start} + ({length}) - 1])")


def _window_hashes(words: str, length: int) -> Column:
    """Hash of every window of ``length`` words, in order; none when there are fewer words."""
    return F.expr(f"transform(if(size({words}) >= {length}, sequence(0, size({words}) - {length}), array()), "
                  f"i -> {_hash(words, 'i', str(length))})")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """Distinct windows of the benchmark: ``_length``, ``_hash``, ``_window`` (words) and ``_items``, the items they are in.

    An item of fewer words than a window, but not none, is one window.  Null texts have none.
    """
    items = benchmark.select(F.col(item).cast("string").alias("_item"), normal_words(F.col(text)).alias("_words"))
    items = items.filter(F.size("_words") > 0).withColumn("_length", F.least(F.size("_words"), F.lit(window)))
    starts = items.select("_item", "_words", "_length",
                          F.explode(F.expr("sequence(1, size(_words) - _length + 1)")).alias("_start"))
    return (starts.select("_item", "_length", F.expr("slice(_words, _start, _length)").alias("_window"))
                  .groupBy("_length", "_window").agg(F.collect_set("_item").alias("_items"))
                  .withColumn("_hash", F.expr(_hash("_window", "0", "_length"))))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id",
                  only_hit: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted), ``spans`` and ``contaminated``.

    A word inside any occurrence of a benchmark window is hit; ``spans`` are the maximal
    runs of hit words as (first, last) word numbers from 1.  Null and empty texts have no
    words and no hits; rows that repeat id and text get the same result; null ids are
    paired like any other; columns of those names are replaced.  ``only_hit`` gives the
    contaminated rows alone.
    """
    windows = benchmark_windows(benchmark, window)
    # At most `window` distinct lengths.
    lengths = [r[0] for r in windows.select("_length").distinct().collect()]
    few = windows.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    made = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    kept = others(docs, *made)
    # Helper columns take names that no given column has.
    own_id, own_hash, hit_id, hit_hash, found_spans = (fresh(docs, n) for n in ("_id", "_text_hash", "_hit_id", "_hit_hash", "_spans"))
    key = [F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_text_hash")]
    spread = docs.select(*key, normal_words(F.col(text)).alias("_words"))
    hits = None
    for length in sorted(lengths):
        probe = spread.select("*", F.posexplode(_window_hashes("_words", length)).alias("_at", "_hash"))
        side = windows.filter(F.col("_length") == length).withColumnRenamed("_hash", "_window_hash")
        found = probe.join(F.broadcast(side) if few else side, (F.col("_hash") == F.col("_window_hash"))
                           & (F.slice("_words", F.col("_at") + 1, F.lit(length)) == F.col("_window")))
        found = found.select("_id", "_text_hash", F.struct((F.col("_at") + 1).alias("first"),
                                                           (F.col("_at") + F.lit(length)).alias("last")).alias("_span"), "_items")
        hits = found if hits is None else hits.unionByName(found)
    base = docs.select(*kept, F.col(doc_id).alias(own_id), F.xxhash64(text).alias(own_hash), F.size(normal_words(F.col(text))).cast("bigint").alias("n_words"))
    if hits is None:
        rows = base.withColumns({found_spans: F.lit(None).cast("array<struct<first:int,last:int>>"),
                                 "items": F.lit(None).cast("array<string>")})
    else:
        # What meets in one group are the hits of one document.
        per_doc = hits.groupBy("_id", "_text_hash").agg(
            F.array_sort(F.collect_set("_span")).alias("_spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"))
        per_doc = per_doc.select(F.col("_id").alias(hit_id), F.col("_text_hash").alias(hit_hash), F.col("_spans").alias(found_spans), "items")
        rows = base.join(per_doc, F.col(own_id).eqNullSafe(F.col(hit_id)) & (F.col(own_hash) == F.col(hit_hash)),
                         "inner" if only_hit else "left")
    merged = F.expr(f"""aggregate(coalesce({found_spans}, array()), cast(array() as array<struct<first:int,last:int>>), (done, s) ->
        if(size(done) > 0 and element_at(done, -1).last >= s.first - 1,
           concat(slice(done, 1, size(done) - 1),
                  array(named_struct('first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, s.last)))),
           concat(done, array(s))))""")
    rows = rows.withColumn("spans", merged).withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    covered = F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    rows = rows.withColumn("n_hit", covered)
    out = rows.select(*kept, "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", "spans",
                      (F.col("n_hit") > 0).alias("contaminated"))
    return out.filter("contaminated") if only_hit else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: Callable[[DataFrame], Column] | None = None, **options) -> DataFrame:
    """``docs`` without contaminated documents; ``keep`` may judge by ``n_hit``, ``n_words`` or ``n_items`` instead."""
    marked = contamination(docs, benchmark, **options)
    wanted = ~F.col("contaminated") if keep is None else keep(marked)
    return marked.filter(wanted).select(*docs.columns)
