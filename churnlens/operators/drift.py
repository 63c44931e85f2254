"""Feature drift between two batches of the feature table.

One rule for what a value is: NULL and NaN are missing, infinities are
counted as non-finite, and only finite values enter the measures. Both
batches are reduced once to a histogram (one row per feature and distinct
value, with its count on either side); the population stability index over
baseline quantile bins and the two-sample Kolmogorov-Smirnov statistic are
both read off it with range-bucketed running totals, so no sample is
gathered in one place. Building the histogram is eager (it is written to
the scratch folder).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.running import running_totals
from churnlens.session import materialize
from churnlens.schemas import FEATURE_COLUMNS

PSI_EPSILON = 1e-4  # proportion used for a bin that is empty on one side


def is_missing(v: Column) -> Column:
    return v.isNull() | F.isnan(v)


def is_infinite(v: Column) -> Column:
    return ~is_missing(v) & (F.abs(v) == F.lit(float("inf")))


def value_histogram(baseline: DataFrame, current: DataFrame, columns=FEATURE_COLUMNS) -> DataFrame:
    """(feature, value, nb, nc): how often each finite value stands in either batch; written once."""
    def long(df: DataFrame, side: str) -> DataFrame:
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        v = F.col("value")
        return (wide.unpivot([], list(columns), "feature", "value").filter(~is_missing(v) & ~is_infinite(v))
                .select("feature", "value", F.lit(int(side == "b")).alias("nb"), F.lit(int(side == "c")).alias("nc")))

    return materialize(long(baseline, "b").unionByName(long(current, "c")).groupBy("feature", "value").agg(
        F.sum("nb").alias("nb"), F.sum("nc").alias("nc")), "value_histogram")


def ks_from(hist: DataFrame) -> DataFrame:
    """(feature, ks_statistic, n_baseline, n_current) of a histogram."""
    totals = hist.groupBy("feature").agg(F.sum("nb").alias("n_baseline"), F.sum("nc").alias("n_current"))
    run = running_totals(hist, "value", ["nb", "nc"], group_cols=["feature"])
    share = lambda cum, n: F.when(F.col(n) > 0, F.col(cum) / F.col(n)).otherwise(F.lit(0.0))
    gap = F.abs(share("cum_nb", "n_baseline") - share("cum_nc", "n_current"))
    # one row per feature: bounded broadcast
    return (run.join(F.broadcast(totals), "feature")
            .groupBy("feature", "n_baseline", "n_current").agg(F.max(gap).alias("ks_statistic"))
            .select("feature", "ks_statistic", F.col("n_baseline").cast("bigint"),
                    F.col("n_current").cast("bigint")))


def baseline_bin_edges(hist: DataFrame, n_bins: int) -> DataFrame:
    """(feature, edges): the n_bins-1 baseline quantile edges (inverted CDF).

    Edge q is the smallest value whose cumulative count reaches
    ceil(q * n / n_bins), q = 1 .. n_bins-1.
    """
    base = hist.filter("nb > 0")
    totals = base.groupBy("feature").agg(F.sum("nb").alias("_N"))
    # one row per feature: bounded broadcast
    run = running_totals(base, "value", ["nb"], group_cols=["feature"]).join(F.broadcast(totals), "feature")
    edges = [F.min(F.when(F.col("cum_nb") >= F.expr(f"({q} * _N + {n_bins} - 1) div {n_bins}"),
                          F.col("value"))) for q in range(1, n_bins)]
    # q-ordered edges are already ascending; duplicates are kept (fixed length)
    return run.groupBy("feature").agg(F.array(*edges).alias("edges"))


def psi_from(hist: DataFrame, n_bins: int = 10) -> DataFrame:
    """(feature, psi, n_bins_used, n_baseline, n_current) of a histogram: its rows are binned,
    not the batches. A feature without baseline values has no bins and no row."""
    edges = F.broadcast(materialize(baseline_bin_edges(hist, n_bins), "psi_edges"))  # n_bins-1 per feature
    # bin = number of edges below the value; equal edges leave a gap in
    # the numbering but cut the values the same way
    b = sum(F.when(F.element_at(F.col("edges"), i) < F.col("value"), F.lit(1)).otherwise(F.lit(0))
            for i in range(1, n_bins))
    counts = hist.join(edges, "feature").groupBy("feature", b.alias("bin")).agg(
        F.sum("nb").alias("nb"), F.sum("nc").alias("nc"))
    totals = counts.groupBy("feature").agg(F.sum("nb").alias("n_baseline"), F.sum("nc").alias("n_current"))
    share = lambda n, of: F.when(F.col(n) == 0, F.lit(PSI_EPSILON)).otherwise(F.col(n) / F.col(of))
    pb, pc = share("nb", "n_baseline"), share("nc", "n_current")
    term = (pc - pb) * F.log(pc / pb)
    return (counts.join(F.broadcast(totals), "feature")
            .groupBy("feature", "n_baseline", "n_current")
            .agg(F.sum(term).alias("psi"), F.count(F.lit(1)).alias("n_bins_used"))
            .select("feature", "psi", F.col("n_bins_used").cast("bigint"),
                    F.col("n_baseline").cast("bigint"), F.col("n_current").cast("bigint")))


def ks_statistic(baseline: DataFrame, current: DataFrame) -> DataFrame:
    return ks_from(value_histogram(baseline, current))


def psi(baseline: DataFrame, current: DataFrame, n_bins: int = 10) -> DataFrame:
    return psi_from(value_histogram(baseline, current), n_bins)


def _moments(df: DataFrame, side: str) -> DataFrame:
    """(feature, mean, std, null rate, non-finite count) of a batch: one wide aggregate, whose
    single row is then turned into a row per feature."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS])
    n = F.count(F.lit(1)).cast("double")
    parts = []
    for c in FEATURE_COLUMNS:
        v = F.col(c)
        x = F.when(~is_missing(v) & ~is_infinite(v), v)
        parts.append(F.struct(
            F.lit(c).alias("feature"), F.avg(x).alias(f"mean_{side}"), F.stddev_samp(x).alias(f"std_{side}"),
            F.when(n > 0, F.count_if(is_missing(v)).cast("double") / n).alias(f"null_rate_{side}"),
            F.count_if(is_infinite(v)).alias(f"n_non_finite_{side}")))
    return wide.agg(F.array(*parts).alias("_all")).select(F.inline("_all"))


def summary_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, mean/stddev/null-rate of both batches, their deltas, non-finite counts)."""
    out = _moments(baseline, "baseline").join(_moments(current, "current"), "feature")
    delta = lambda m: (F.col(f"{m}_current") - F.col(f"{m}_baseline")).alias(f"{m}_delta")
    return out.select("feature", "mean_baseline", "mean_current", delta("mean"), "std_baseline", "std_current", delta("std"),
                      "null_rate_baseline", "null_rate_current", delta("null_rate"),
                      "n_non_finite_baseline", "n_non_finite_current")


def drift_report(baseline: DataFrame, current: DataFrame, n_bins: int = 10) -> DataFrame:
    """One row per feature: moments and null rates, PSI and KS, all over the same values."""
    hist = value_histogram(baseline, current)
    return (summary_drift(baseline, current)
            .join(ks_from(hist), "feature", "left")
            .join(psi_from(hist, n_bins).select("feature", "psi", "n_bins_used"), "feature", "left"))
