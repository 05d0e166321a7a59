"""Binary classifier metrics over (label, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.ordered import running_totals


def threshold_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Rows, log loss, accuracy (at or above the threshold), precision, recall and F1 (above it)."""
    y, p = F.col(label).cast("double"), F.col(score).cast("double")
    floor = F.lit(-100.0)
    safe_log = lambda x: F.when(x > 0, F.greatest(F.log(x), floor)).otherwise(floor)
    loss = -(y * safe_log(p) + (1 - y) * safe_log(1 - p))
    above, positive = p > threshold, y == 1
    counts = df.agg(
        F.count("*").alias("rows"),
        F.avg(loss).alias("loss"),
        F.avg(((p >= threshold) == positive).cast("double")).alias("accuracy"),
        F.count_if(above & positive).alias("_tp"),
        F.count_if(above & ~positive).alias("_fp"),
        F.count_if(~above & positive).alias("_fn"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    return counts.select("rows", "loss", "accuracy", ratio(tp, tp + fp).alias("precision"),
                         ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve with tied scores counted half; null when one class is absent.

    Rows are first folded to one row per distinct score, so ties never meet in one task.
    """
    y = F.col(label).cast("double")
    groups = df.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.count_if(y == 1).alias("_pos"), F.count_if(y != 1).alias("_neg"))
    placed = running_totals(groups, ["_score"], {"_neg_upto": F.col("_neg")})
    below = F.col("_neg_upto") - F.col("_neg")
    wins = F.sum(F.col("_pos").cast("double") * (below + F.col("_neg") / 2.0))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return placed.agg(F.when(pairs > 0, wins / pairs).alias("auc"))


def binary_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """All metrics in one row."""
    at = threshold_metrics(df, label, score, threshold)
    both = at.unionByName(roc_auc(df, label, score), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in (*at.columns, "auc")])


def perplexity(df: DataFrame, loss: str = "loss") -> DataFrame:
    """Exponential of the mean loss, the mean capped at 20."""
    return df.agg(F.exp(F.least(F.avg(loss), F.lit(20.0))).alias("perplexity"))
