"""Inter-purchase gaps (D1) and favourite product.

D1: the churn threshold is documented as the 90th percentile of gaps
between consecutive real purchases of a customer. A purchase is a
distinct real invoice time; a gap is the whole days between consecutive
purchases. Two purchases on the same calendar date are always 0 whole
days apart, so the gaps are computed per (customer, date) -- count of
distinct times minus one gaps of 0 days -- plus one gap across each pair of
consecutive purchase dates. The per-customer window then runs over
purchase dates, bounded by the calendar span, not by the number of
purchases, so a customer holding a large share of lines stays cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.columns import ntz, whole_days_between
from churnlens.operators.features import is_real


def gap_histogram(clean: DataFrame) -> DataFrame:
    """(gap_days, n_gaps): the whole multiset of inter-purchase gaps."""
    ts = F.col("invoice_date")
    days = (clean.filter(is_real() & ts.isNotNull())
            .groupBy("customer_id", F.to_date(ts).alias("d"))
            .agg(F.count_distinct(ts).alias("n_times"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")))
    w = Window.partitionBy("customer_id").orderBy("d")
    days = days.withColumn("_prev_last", F.lag("last_ts").over(w))
    prev_last = F.col("_prev_last")

    def gap(days_col, weight):
        return F.struct(days_col.cast("bigint").alias("gap_days"), weight.cast("bigint").alias("w"))

    # one pass over the per-day rows: the gap from the previous purchase date
    # (weight 1) and the same-date gaps of 0 days (weight n_times - 1)
    gaps = days.select(F.explode(F.array_compact(F.array(
        F.when(prev_last.isNotNull(), gap(whole_days_between(prev_last, F.col("first_ts")), F.lit(1))),
        F.when(F.col("n_times") > 1, gap(F.lit(0), F.col("n_times") - 1)),
    ))).alias("g"))
    return (gaps.groupBy(F.col("g.gap_days").alias("gap_days"))
            .agg(F.sum("g.w").cast("bigint").alias("n_gaps")))


def gap_percentiles(hist: DataFrame, percentages=(0.5, 0.9)) -> DataFrame:
    """Exact weighted percentiles (linear interpolation) of the gap histogram.

    The histogram has one row per distinct whole-day gap, so its size is
    bounded by the date span of the data.
    """
    p50, p90 = percentages
    return hist.agg(
        F.sum("n_gaps").cast("bigint").alias("n_gaps"),
        F.percentile(F.col("gap_days"), F.lit(p50), F.col("n_gaps")).alias("median_gap_days"),
        F.percentile(F.col("gap_days"), F.lit(p90), F.col("n_gaps")).alias("p90_gap_days"),
        (F.sum(F.col("gap_days") * F.col("n_gaps")).cast("double")
         / F.sum("n_gaps").cast("double")).alias("mean_gap_days"),
    )


def favourite_product(clean: DataFrame, as_of_date=None) -> DataFrame:
    """Per customer, the stock code on most real lines (ties: smallest code).

    min(struct(-lines, code)) is an ordinary partial aggregate, so no
    per-customer list of products is ever gathered.
    """
    rows = clean.filter(is_real() & F.col("stock_code").isNotNull())
    if as_of_date is not None:
        rows = rows.filter(F.col("invoice_date") < ntz(as_of_date))
    counts = rows.groupBy("customer_id", "stock_code").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("stock_code"))).alias("m"))
    return best.select("customer_id", F.col("m.stock_code").alias("favourite_stock_code"),
                       (-F.col("m.neg_n")).cast("bigint").alias("favourite_lines"))
