"""Mix sources to target weights by Pareto order sampling.

Each document expects ``target / source size`` copies.  Whole copies are certain;
for the rest a document has an inclusion probability.  Documents are ranked by
``odds(u) / odds(probability)`` with a digest-based uniform ``u`` and taken in that
order until their words reach what the source still lacks.  The rank where a source
stops is found by counting slices of the rank, so that no source is ever sorted in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.text import plain_word_count
from reviewloom.operators.ordered import dense_index
from reviewloom.session import written

MOST = 3          # copies of a document and multiple of a source's size, at most
RANK_BITS = 52    # a rank is the numerator of a fraction over 2**52
SLICE_BITS = 13   # slices counted at a time


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    ``sizes`` has source and size.  Sources in code point order, null last, get the
    weights in turn.  They share ``share`` of all sizes; a target stops at three times
    its source's size and the excess is shared again by weight until none is above.
    Each round reads two sums, whatever the number of sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = dense_index(totals.select("source"), "source", "_at")
    last = numbered.count()
    placed = (totals.join(numbered, "source", "left")
                    .withColumn("_at", F.coalesce("_at", F.lit(last)))
                    .withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                        (F.col("_at") % len(weights) + 1).cast("int")))
                    .withColumn("_cap", F.col("source_size") * MOST))
    placed = written(placed, "sources")
    whole = (placed.agg(F.sum("source_size")).first()[0] or 0) * share
    rest, weight = whole, placed.agg(F.sum("_weight")).first()[0] or 0
    while weight:
        above = F.col("_cap") < F.lit(float(rest)) * F.col("_weight") / F.lit(float(weight))
        capped, free = placed.agg(F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_weight")))).first()
        left, free = whole - (capped or 0), free or 0
        if (left, free) == (rest, weight):
            break
        rest, weight = left, free
    even = F.lit(float(rest)) * F.col("_weight") / F.lit(float(weight)) if weight else F.lit(float("inf"))
    return placed.select("source", "source_size", F.least(F.col("_cap").cast("double"), even).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), text: str = "text", seed: str = "mix",
                preference: Column | None = None) -> DataFrame:
    """``docs`` without its text, with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Sizes count plain words; a null text has none.  ``preference`` (positive; default
    the same for all) makes some documents of a source likelier than others.  A document
    is copied three times at most.  Results depend on ids and texts alone, so reruns
    agree; rows that repeat id and text share one rank and are taken together.  Rows
    with a null source form a source of their own; an empty table gives an empty result.
    Columns of those five names are replaced.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c not in (text, "source", *made)]
    keys = F.concat_ws("\x01", F.lit(seed), F.col("doc_id").cast("string") if "doc_id" in docs.columns else F.lit(""),
                       F.md5(F.coalesce(F.col(text), F.lit(""))))
    sized = docs.select(*kept, "source", plain_word_count(F.col(text)).alias("size"),
                        # 52 bits of a digest, shifted by a half so that 0 and 1 cannot occur.
                        ((F.conv(F.substring(F.md5(keys), 1, 13), 16, 10).cast("bigint") + 0.5) / 2.0 ** RANK_BITS).alias("_u"),
                        (F.lit(1.0) if preference is None else preference.cast("double")).alias("_preference"))
    sized = written(sized, "sizes")
    targets = written(source_targets(sized, weights), "targets")
    pace = _paces(sized, targets)
    placed = sized.join(pace, sized["source"].eqNullSafe(pace["source"])).drop(pace["source"])
    # A hair above a whole number is rounding, not a chance of one more copy.
    expected = F.least(F.lit(float(MOST)), F.col("_pace") * F.col("_preference"))
    copies = F.floor(expected + 1e-9)
    placed = placed.withColumn("_whole", copies).withColumn("_chance", F.greatest(F.lit(0.0), expected - F.col("_whole")))
    odds = (F.col("_u") / (1 - F.col("_u"))) * ((1 - F.col("_chance")) / F.col("_chance"))
    rank = F.when(F.col("_chance") > 1e-9, F.floor(odds / (1 + odds) * F.lit(2.0 ** RANK_BITS - 1)).cast("bigint"))
    ranked = written(placed.withColumn("_rank", rank), "ranked")
    cuts = _cuts(ranked)
    joined = ranked.join(cuts, ranked["source"].eqNullSafe(cuts["source"]), "left").drop(cuts["source"])
    extra = F.coalesce((F.col("_rank") < F.col("_cut")) | ((F.col("_rank") == F.col("_cut")) & F.col("_with_cut")), F.lit(False))
    copied = F.col("_whole") + extra.cast("bigint")
    return joined.select(*kept, "source", "size", "source_size", "target", copied.alias("copies"),
                         (copied * F.col("size")).alias("taken"))


def _paces(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the copies expected per unit of preference, so that expected words equal the target.

    Documents that would pass three copies are fixed at three and the pace of the rest
    rises; every round reads one number, how many sources still changed.
    """
    state = targets.withColumn("_pace", F.lit(0.0))
    previous = None
    while True:
        at = sized.join(state.select(F.col("source").alias("_source"), "_pace"), sized["source"].eqNullSafe(F.col("_source")))
        full = F.col("_pace") * F.col("_preference") >= MOST
        sums = at.groupBy("source").agg(
            F.coalesce(F.sum(F.when(full, F.col("size") * float(MOST))), F.lit(0.0)).alias("_full"),
            F.coalesce(F.sum(F.when(~full, F.col("size") * F.col("_preference"))), F.lit(0.0)).alias("_free"))
        new = targets.join(sums, targets["source"].eqNullSafe(sums["source"]), "left").drop(sums["source"]).withColumn(
            "_pace", F.when(F.col("_free") > 0, (F.col("target") - F.col("_full")) / F.col("_free"))
                      .otherwise(F.when(F.col("source_size") > 0, F.lit(float(MOST))).otherwise(0.0)))
        state = written(new.select("source", "source_size", "target", "_pace", "_full"), "paces")
        current = state.agg(F.sum("_full")).first()[0]
        if current == previous or not current:
            return state.drop("_full")
        previous = current


def _cuts(ranked: DataFrame) -> DataFrame:
    """Per source the rank where it stops (``_cut``) and whether the documents at that rank still belong to it."""
    chance = ranked.filter(F.col("_rank").isNotNull() & (F.col("size") > 0)).select("source", "size", "_rank", "_chance")
    needs = chance.groupBy("source").agg(F.sum(F.col("size") * F.col("_chance")).alias("_need"))
    state = needs.select("source", "_need", F.lit(0).cast("bigint").alias("_cut"))
    for shift in range(RANK_BITS - SLICE_BITS, -1, -SLICE_BITS):
        state = state.withColumnRenamed("source", "_source")
        inside = chance.join(state, chance["source"].eqNullSafe(F.col("_source"))
                             & (F.shiftright("_rank", shift + SLICE_BITS) == F.col("_cut")))
        slices = inside.groupBy("source", "_need", F.shiftright("_rank", shift).alias("_slice")).agg(F.sum("size").alias("_words"))
        running = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
        # At most 8,192 slices of a source meet here.
        upto = slices.withColumn("_upto", F.sum("_words").over(running)).withColumn("_before", F.col("_upto") - F.col("_words"))
        crossing = upto.groupBy("source").agg(
            F.min(F.when(F.col("_upto") >= F.col("_need") - 1e-6, F.struct("_slice", "_before", "_words", "_need"))).alias("at"),
            F.max(F.struct("_slice", "_before", "_words", "_need")).alias("end"))
        state = written(crossing.withColumn("at", F.coalesce("at", "end"))
                                .select("source", (F.col("at._need") - F.col("at._before")).alias("_need"),
                                        F.col("at._slice").alias("_cut"), F.col("at._words").alias("_words")), "cut")
    return state.select("source", "_cut", (F.col("_need") * 2 >= F.col("_words")).alias("_with_cut"))
