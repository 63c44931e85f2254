"""Temporal train/test split of the snapshot panel.

Not random: rows are split by snapshot date. Test rows are the snapshots
on or after ``test_start``; train rows are those whose whole label window
ends by then (``snapshot_date + N days <= test_start``), so no train label
looks at test-period purchases. Rows in between are the embargo.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import ntz


def temporal_split(panel: DataFrame, test_start, threshold_days: int) -> DataFrame:
    t = ntz(test_start)
    s = F.col("snapshot_date")
    return panel.withColumn(
        "split",
        F.when(s >= t, F.lit("test"))
        .when(s + F.make_dt_interval(F.lit(int(threshold_days))) <= t, F.lit("train"))
        .otherwise(F.lit("embargo")))


def split_counts(split_panel: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    churned = F.count_if(F.col("is_churned"))
    return split_panel.groupBy("split").agg(
        n.alias("n_rows"),
        F.count_distinct("customer_id").alias("n_customers"),
        F.count_distinct("snapshot_date").alias("n_snapshots"),
        churned.alias("n_churned"),
        (churned.cast("double") / n.cast("double")).alias("churn_rate"),
    )
