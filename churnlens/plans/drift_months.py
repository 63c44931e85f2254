"""Feature drift between any stored months (D8), without reading the panel again.

Per snapshot month and feature the table keeps how often each finite value stands, and how many values are missing
or infinite. Counts of several months merge by addition, and every figure of the drift report (moments, null rates, population
stability, Kolmogorov-Smirnov) follows from them. A month is written once, when the panel gains or changes it;
the months beside it stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions.columns import ntz
from churnlens.operators.drift import is_infinite, is_missing, ks_from, psi_from
from churnlens.schemas import FEATURE_COLUMNS
from churnlens.session import materialize
from churnlens.sources.tables import TableTarget

HISTOGRAM_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.TimestampNTZType()),
    T.StructField("feature", T.StringType()),
    T.StructField("kind", T.StringType()),  # value | missing | infinite
    T.StructField("value", T.DoubleType()),
    T.StructField("n", T.LongType()),
])


class MonthHistograms:
    """Value counts of the panel's features by snapshot month, in a table under ``path``."""

    def __init__(self, path: str):
        self.table = TableTarget(path, schema=HISTOGRAM_SCHEMA, partition_by=["snapshot_date"])

    def update(self, panel: DataFrame) -> None:
        """Take in the months of ``panel``, each whole: one met before is replaced, others are left as they are.
        Null snapshot dates are of no month and left out."""
        wide = panel.filter(F.col("snapshot_date").isNotNull()).select(
            "snapshot_date", *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS])
        v = F.col("value")
        kind = F.when(is_missing(v), "missing").when(is_infinite(v), "infinite").otherwise("value")
        counts = (wide.unpivot(["snapshot_date"], list(FEATURE_COLUMNS), "feature", "value").withColumn("kind", kind)
                  .groupBy("snapshot_date", "feature", "kind", F.when(kind == "value", v).alias("value"))
                  .agg(F.count(F.lit(1)).alias("n")))
        self.table.replace_parts(counts.select(HISTOGRAM_SCHEMA.names))

    def months(self, spark: SparkSession) -> DataFrame:
        """(snapshot_date) of the months kept."""
        return self.table.read(spark).select("snapshot_date").distinct()

    def report(self, spark: SparkSession, baseline: Iterable, current: Iterable, n_bins: int = 10) -> DataFrame:
        """The drift report of ``current`` months against ``baseline`` months (first instants of months), as
        ``drift_report`` of their panel rows. A month may be on both sides; months that are not kept count nothing.
        A feature without any value on either side has no row."""
        base, cur = _any_of(baseline), _any_of(current)
        kept = self.table.read(spark).filter(base | cur)
        n = lambda side: F.sum(F.when(side, F.col("n")).otherwise(F.lit(0)))
        counts = materialize(kept.groupBy("feature", "kind", "value").agg(n(base).alias("nb"), n(cur).alias("nc")), "month_counts")
        hist = counts.filter("kind = 'value'").drop("kind")
        return (_summary(counts).join(ks_from(hist), "feature", "left")
                .join(psi_from(hist, n_bins).select("feature", "psi", "n_bins_used"), "feature", "left"))


def _any_of(months: Iterable) -> Column:
    return F.coalesce(F.col("snapshot_date").isin([ntz(m) for m in months]), F.lit(False))


def _summary(counts: DataFrame) -> DataFrame:
    """Moments, null rates and non-finite counts of either side. Deviations are taken from the mean, not from sums
    of squares, so nothing cancels."""
    sides = (("baseline", "nb"), ("current", "nc"))
    finite = F.col("kind") == "value"
    of = lambda cond, c: F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0)))
    first = []
    for side, c in sides:
        first += [F.sum(c).alias(f"rows_{side}"), of(finite, c).alias(f"n_{side}"), of(F.col("kind") == "missing", c).alias(f"_missing_{side}"),
                  of(F.col("kind") == "infinite", c).alias(f"n_non_finite_{side}"),
                  F.sum(F.when(finite, F.col("value") * F.col(c))).alias(f"sum_{side}")]
    totals = counts.groupBy("feature").agg(*first)
    for side, _ in sides:
        totals = totals.withColumn(f"mean_{side}", F.when(F.col(f"n_{side}") > 0, F.col(f"sum_{side}") / F.col(f"n_{side}")))
    # one row per feature: bounded broadcast
    means = F.broadcast(totals.select("feature", "mean_baseline", "mean_current"))
    spread = counts.filter(finite).join(means, "feature").groupBy("feature").agg(*[
        F.sum(F.col(c) * (F.col("value") - F.col(f"mean_{side}")) * (F.col("value") - F.col(f"mean_{side}"))).alias(f"squares_{side}")
        for side, c in sides])
    out = totals.join(spread, "feature", "left")
    for side, _ in sides:
        out = out.withColumns({
            f"std_{side}": F.when(F.col(f"n_{side}") > 1, F.sqrt(F.col(f"squares_{side}") / (F.col(f"n_{side}") - 1))),
            f"null_rate_{side}": F.when(F.col(f"rows_{side}") > 0, F.col(f"_missing_{side}") / F.col(f"rows_{side}"))})
    delta = lambda m: (F.col(f"{m}_current") - F.col(f"{m}_baseline")).alias(f"{m}_delta")
    return out.select("feature", "mean_baseline", "mean_current", delta("mean"), "std_baseline", "std_current", delta("std"),
                      "null_rate_baseline", "null_rate_current", delta("null_rate"), "n_non_finite_baseline", "n_non_finite_current")
