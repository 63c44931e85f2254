"""Exact baseline Shapley contributions (D5) and global importance.

With seven features there are 2^7 = 128 coalitions. Each scored row is
expanded into its 128 coalition rows (features in the coalition keep the
row's value, the rest take the baseline value), all of them are scored in
one distributed model pass, and the contributions are weighted sums per
row. The 128 rows of one input row are generated in the same task, so
the partial aggregate collapses them before any shuffle.

phi_i = sum over S not containing i of |S|! (M-|S|-1)! / M! * (f(S + i) - f(S))
and sum_i phi_i = f(x) - f(baseline).
"""

from __future__ import annotations

from collections.abc import Callable
from math import factorial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.model import churn_probability, model_input
from churnlens.schemas import FEATURE_COLUMNS


def baseline_point(reference: DataFrame) -> dict[str, float]:
    """Mean of each (finite-filled) feature over a reference batch: 7 numbers."""
    row = model_input(reference).agg(*[F.avg(c).alias(c) for c in FEATURE_COLUMNS]).first()
    return {c: float(row[c]) for c in FEATURE_COLUMNS}


def shapley_contributions(model: PipelineModel | Callable[[DataFrame], DataFrame], rows: DataFrame,
                          baseline: dict[str, float], key_cols=("customer_id", "snapshot_date")) -> DataFrame:
    """(keys..., base_value, prediction, phi_<feature> x 7) of a model, or of any scoring that
    adds ``churn_probability`` to feature rows."""
    m = len(FEATURE_COLUMNS)
    full = (1 << m) - 1
    weights = [factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)]
    w_arr = F.array(*[F.lit(w) for w in weights])

    mask = F.col("_mask")
    size = F.bit_count(mask)
    x = model_input(rows).select(*key_cols, *FEATURE_COLUMNS)
    expanded = x.withColumn("_mask", F.explode(F.sequence(F.lit(0), F.lit(full))))
    mixed = expanded.select(*key_cols, "_mask", *[
        F.when(F.shiftright(mask, i).bitwiseAND(1) == 1, F.col(c)).otherwise(F.lit(baseline[c])).alias(c)
        for i, c in enumerate(FEATURE_COLUMNS)])
    f = F.col("churn_probability")
    scored = model(mixed) if callable(model) else churn_probability(model, mixed)

    aggs = [F.sum(F.when(mask == 0, f)).alias("base_value"),
            F.sum(F.when(mask == full, f)).alias("prediction")]
    for i, c in enumerate(FEATURE_COLUMNS):
        has_i = F.shiftright(mask, i).bitwiseAND(1) == 1
        # element_at is 1-based: weight for |S| = size-1 (with i) or size (without i)
        coef = F.when(has_i, F.element_at(w_arr, size)).otherwise(-F.element_at(w_arr, size + 1))
        aggs.append(F.sum(f * coef).alias(f"phi_{c}"))
    return scored.groupBy(*key_cols).agg(*aggs)


def global_importance(contributions: DataFrame) -> DataFrame:
    """Mean |phi| per feature, ranked (one row per feature)."""
    phis = [f"phi_{c}" for c in FEATURE_COLUMNS]
    long = contributions.select(*phis).unpivot([], phis, "feature", "phi")
    imp = long.groupBy(F.regexp_replace("feature", "^phi_", "").alias("feature")).agg(
        F.avg(F.abs("phi")).alias("mean_abs_contribution"),
        F.avg("phi").alias("mean_contribution"))
    # seven rows: a global rank over them is bounded
    rank = F.row_number().over(Window.orderBy(F.desc("mean_abs_contribution"), "feature"))
    return imp.withColumn("rank", rank.cast("bigint"))
