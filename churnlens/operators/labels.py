"""Forward churn label at one date.

Churned = no real purchase in the window (T, T + N days]; the population
is the same as the features' (a real purchase strictly before T). Kept
apart from feature code: scoring never calls it.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import ntz, parse_timestamp, up_to_month
from churnlens.operators.features import is_real


def churn_labels(clean: DataFrame, as_of_date, threshold_days: int) -> DataFrame:
    """(customer_id, is_churned) in one aggregate over lines up to T + N."""
    t = ntz(as_of_date)
    end = t + F.make_dt_interval(F.lit(int(threshold_days)))
    ts = F.col("invoice_date")
    real = is_real()
    last = parse_timestamp(as_of_date) + timedelta(days=int(threshold_days))
    lines = up_to_month(clean, last).filter(ts <= end)  # reaches the scan; later lines never matter
    return (lines.groupBy("customer_id")
            .agg(F.count_if((ts < t) & real).alias("_before"),
                 F.bool_or((ts > t) & real).alias("_returned"))
            .filter(F.col("_before") > 0)
            .select("customer_id", (~F.coalesce(F.col("_returned"), F.lit(False))).alias("is_churned")))
