"""Ranking metrics for churn scores (D4): PR curve, average precision,
recall at a precision floor.

Scores are first reduced to one row per distinct score (ties form one
threshold), then accumulated in descending score order with the
range-bucketed running totals, so no step gathers all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.running import running_totals
from churnlens.session import materialize


def recency_baseline_score(panel: DataFrame, threshold_days: int) -> DataFrame:
    """A fixed, model-free score: recency / (recency + N), in [0, 1)."""
    r = F.col("recency_days").cast("double")
    return panel.withColumn("score", r / (r + F.lit(float(threshold_days))))


def pr_curve(scored: DataFrame, score_col: str = "score", label_col: str = "is_churned") -> DataFrame:
    """(score, pos, tp, fp, precision, recall) per distinct score, highest first. Eager: the
    score histogram is written to the scratch folder when this is called."""
    hist = materialize(scored.groupBy(F.col(score_col).alias("score")).agg(
        F.count_if(F.col(label_col)).cast("bigint").alias("pos"),
        F.count(F.lit(1)).cast("bigint").alias("n")), "score_histogram")
    run = running_totals(hist, "score", ["pos", "n"], descending=True).withColumn("_k", F.lit(0))
    total = hist.agg(F.sum("pos").cast("double").alias("_P")).withColumn("_k", F.lit(0))  # one row
    tp = F.col("cum_pos")
    return run.join(F.broadcast(total), "_k").select(
        "score", "pos",
        tp.cast("bigint").alias("tp"),
        (F.col("cum_n") - tp).cast("bigint").alias("fp"),
        (tp.cast("double") / F.col("cum_n").cast("double")).alias("precision"),
        F.when(F.col("_P") > 0, tp.cast("double") / F.col("_P")).otherwise(F.lit(0.0)).alias("recall"),
    )


def pr_summary(curve: DataFrame, min_precision: float) -> DataFrame:
    """Average precision (sum of recall steps x precision) and the best
    recall among thresholds with precision >= ``min_precision``."""
    total = F.sum("pos")
    ap = F.sum(F.col("pos").cast("double") * F.col("precision")) / total.cast("double")
    return curve.agg(
        F.when(total > 0, ap).otherwise(F.lit(0.0)).alias("average_precision"),
        F.coalesce(F.max(F.when(F.col("precision") >= min_precision, F.col("recall"))),
                   F.lit(0.0)).alias("recall_at_precision"),
        F.lit(float(min_precision)).alias("min_precision"),
        total.cast("bigint").alias("n_positive"),
        F.max("tp").alias("_tp"), F.max(F.col("tp") + F.col("fp")).cast("bigint").alias("n_rows"),
    ).drop("_tp")


def confusion_at(scored: DataFrame, threshold: float, score_col: str = "score",
                 label_col: str = "is_churned") -> DataFrame:
    """Confusion counts at one score threshold (score >= threshold -> positive)."""
    p = F.col(score_col) >= threshold
    y = F.col(label_col)
    return scored.agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"),
                      F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"))
