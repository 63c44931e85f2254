"""Customer snapshot panel and its reports.

One row per (customer, usable snapshot date T): the seven features over
lines strictly before T, plus ``is_churned`` from the window (T, T+N].

Default plan ("bucketed"): each line lands in exactly one month bucket,
computed by column arithmetic (no join with the calendar):

  g = #{snapshots T_i <= ts}  (the line counts for every snapshot j >= g)

1. sums per (customer, g) -- map-side combined with 2, so a hot
   customer ships one row per bucket per map task;
2. exact distinct counts without re-reading: per (customer, invoice) and
   (customer, stock_code) the first bucket a real line appears in;
3. one window per customer over its buckets (at most one row per month,
   so its size is bounded by the calendar, not by the data): running
   sums/min/max give the features, a reverse running min of real purchase
   times gives the label.

The "range" plan gives every line to every later snapshot (the snapshots of
a line are a run of months, so they are generated, not joined) and aggregates
per (customer, T), all in the task that holds the customer. Its time grows with
lines x snapshots and with the hottest customer; it is the cross-check of the
bucketed plan and no job runs it.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.columns import iso_format, ntz, up_to_month
from churnlens.operators.features import Money, finish_features, is_real
from churnlens.plans.calendar import Calendar, calendar_for, calendar_frame
from churnlens.schemas import SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA


RANGE_TASK_LINES = 250_000  # lines of a task of the range plan


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(int(n)))


def _empty_panel(clean: DataFrame) -> DataFrame:
    return clean.sparkSession.createDataFrame([], SNAPSHOT_SCHEMA)


def _snapshot_date(cal: Calendar, j: Column) -> Column:
    return ntz(cal.first) + F.make_ym_interval(F.lit(0), j.cast("int"))


def _relevant_lines(clean: DataFrame, cal: Calendar) -> DataFrame:
    """Lines that can affect some snapshot: dated and not after T_last + N."""
    horizon = cal.last_usable + timedelta(days=cal.threshold_days)
    ts = F.col("invoice_date")
    return up_to_month(clean, horizon).filter(ts.isNotNull() & (ts <= ntz(horizon)))


def _bucket_columns(cal: Calendar, ts: Column | None = None) -> dict[str, Column]:
    """g = #{usable T_i <= ts} (capped at K) and whether ts == T_{g-1} exactly."""
    k = cal.n_usable
    ts = F.col("invoice_date") if ts is None else ts
    idx = (F.year(ts) - cal.first.year) * 12 + (F.month(ts) - cal.first.month)
    month_start = _snapshot_date(cal, idx)  # T_idx, extended past the calendar
    g = (F.when(ts < ntz(cal.first), F.lit(0))
         .when(ts < month_start, idx)
         .otherwise(idx + 1))
    return {
        "g": F.least(g, F.lit(k)).cast("int"),
        "on_boundary": (ts == month_start) & (idx >= 0) & (idx <= k - 1),
    }


def snapshot_panel(clean: DataFrame, cal: Calendar) -> DataFrame:
    """U14, bucketed plan (default)."""
    k = cal.n_usable
    if k == 0:
        return _empty_panel(clean)
    real = is_real()
    money = Money(clean)
    ts = F.col("invoice_date")
    lines = (_relevant_lines(clean, cal)
             .select("customer_id", "invoice", "stock_code", "invoice_date",
                     money.line_value().alias("value"), "has_non_positive_quantity", real.alias("real"))
             .withColumns(_bucket_columns(cal)))
    real = F.col("real")

    # 1. what each line adds to its (customer, bucket)
    added = lines.select(
        "customer_id", "g", real.cast("bigint").alias("n_real"), F.col("value").alias("value_sum"), F.lit(1).cast("bigint").alias("n_lines"),
        F.col("has_non_positive_quantity").cast("bigint").alias("n_nonpos"), F.when(real, ts).alias("max_real"),
        F.when(real, ts).alias("min_real"), F.when(real & ~F.col("on_boundary"), ts).alias("min_real_strict"))

    # 2. first-seen bucket of each distinct invoice / stock code (real lines)
    def first_seen(key: str, out: str) -> DataFrame:
        return (lines.filter(real & F.col(key).isNotNull())
                .groupBy("customer_id", key).agg(F.min("g").alias("g"))
                .select("customer_id", "g", F.lit(1).cast("bigint").alias(out)))

    # summed together: combined in the tasks that hold the lines and the pairs, then moved once
    partials = (added
                .unionByName(first_seen("invoice", "n_new_invoices"), allowMissingColumns=True)
                .unionByName(first_seen("stock_code", "n_new_products"), allowMissingColumns=True)
                .groupBy("customer_id", "g").agg(
                    F.sum("n_real").alias("n_real"),
                    money.total(F.col("value_sum")).alias("value_sum"),
                    F.sum("n_lines").alias("n_lines"),
                    F.sum("n_nonpos").alias("n_nonpos"),
                    F.max("max_real").alias("max_real"),
                    F.min("min_real").alias("min_real"),
                    F.min("min_real_strict").alias("min_real_strict"),
                    F.sum("n_new_invoices").alias("n_new_invoices"),
                    F.sum("n_new_products").alias("n_new_products"),
                ))

    return panel_of_partials(partials, cal, money)


def panel_of_partials(partials: DataFrame, cal: Calendar, money: Money) -> DataFrame:
    """Merged per-(customer, bucket) partials -> the panel."""
    k = cal.n_usable
    # 3a. dense spine: each customer gets every bucket from its first one to K
    by_bucket = Window.partitionBy("customer_id").orderBy("g")
    spine = (partials
             .withColumn("_next_g", F.lead("g").over(by_bucket))
             .withColumn("j", F.explode(F.sequence(F.col("g"), F.coalesce(F.col("_next_g") - 1, F.lit(k))))))
    here = F.col("j") == F.col("g")
    spine = spine.select("customer_id", "j", *[
        F.when(here, F.col(c)).alias(c) for c in
        ["n_real", "value_sum", "n_lines", "n_nonpos", "max_real", "min_real", "min_real_strict",
         "n_new_invoices", "n_new_products"]])

    # 3b. running aggregates per customer (rows = buckets, bounded by K + 1)
    w = Window.partitionBy("customer_id").orderBy("j")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after_next = w.rowsBetween(2, Window.unboundedFollowing)
    running = spine.select(
        "customer_id", "j",
        F.sum("n_real").over(upto).alias("cum_real"),
        money.total(F.col("value_sum"), upto).alias("value_sum"),
        F.sum("n_lines").over(upto).alias("n_lines"),
        F.sum("n_nonpos").over(upto).alias("n_nonpos"),
        F.max("max_real").over(upto).alias("last_real_ts"),
        F.min("min_real").over(upto).alias("first_real_ts"),
        F.coalesce(F.sum("n_new_invoices").over(upto), F.lit(0)).alias("n_invoices"),
        F.coalesce(F.sum("n_new_products").over(upto), F.lit(0)).alias("n_products"),
        # next real purchase strictly after T_j: bucket j+1 without lines
        # sitting exactly on T_j, then any bucket from j+2 on
        F.least(F.lead("min_real_strict", 1).over(w),
                F.min("min_real").over(after_next)).alias("next_real_ts"),
    ).filter((F.col("j") < k) & (F.col("cum_real") > 0))

    t = _snapshot_date(cal, F.col("j"))
    out = finish_features(running.withColumn("snapshot_date", t), F.col("snapshot_date"), money)
    churned = ~F.coalesce(F.col("next_real_ts") <= F.col("snapshot_date") + _days(cal.threshold_days),
                          F.lit(False))
    return out.withColumn("is_churned", churned).select(*SNAPSHOT_COLUMNS)


def _at_snapshots(df: DataFrame, cal: Calendar, first: Column) -> DataFrame:
    """Each row once per snapshot from the ``first``-th on, as ``T``."""
    last = F.lit(cal.n_usable - 1)
    return (df.withColumn("_first", first).filter(F.col("_first") <= last)
            .withColumn("_j", F.explode(F.sequence(F.col("_first"), last)))
            .withColumn("T", _snapshot_date(cal, F.col("_j"))).drop("_first", "_j"))


def snapshot_panel_range(clean: DataFrame, cal: Calendar) -> DataFrame:
    """U14, range plan: every line at every snapshot it can affect.

    Lines are moved once, to the task of their customer, and only there repeated and aggregated, so what is shuffled grows
    with the lines and not with lines x snapshots. The number of tasks follows the lines (they are counted).
    """
    if cal.n_usable == 0:
        return _empty_panel(clean)
    ts = F.col("invoice_date")
    t = F.col("T")
    money = Money(clean)
    lines = _relevant_lines(clean, cal)
    tasks = max(1, math.ceil(lines.count() / RANGE_TASK_LINES))
    lines = lines.select("customer_id", "invoice", "stock_code", "invoice_date", F.coalesce(is_real(), F.lit(False)).alias("real"),
                         money.line_value().alias("value"), "has_non_positive_quantity").repartition(tasks, "customer_id")
    real = F.col("real")

    # distinct counts as plain counts: a key counts at T iff its first real line is before T (no distinct
    # aggregation over the repeated rows)
    def first_of(key: str) -> Column:
        seen = Window.partitionBy("customer_id", key).orderBy(real.desc(), ts)
        return (F.row_number().over(seen) == 1) & real & F.col(key).isNotNull()

    lines = lines.withColumns({"new_invoice": first_of("invoice"), "new_product": first_of("stock_code")})
    # the first snapshot with ts <= T + N: snapshots strictly before ts - N come earlier
    back = _bucket_columns(cal, ts - _days(cal.threshold_days))
    joined = _at_snapshots(lines.drop("invoice", "stock_code"), cal, back["g"] - back["on_boundary"].cast("int"))
    before = ts < t
    real_before = before & real
    agg = joined.groupBy("customer_id", "T").agg(
        F.count_if(real_before).alias("n_real"),
        F.max(F.when(real_before, ts)).alias("last_real_ts"),
        F.min(F.when(real_before, ts)).alias("first_real_ts"),
        money.total(F.when(before, F.col("value"))).alias("value_sum"),
        F.count_if(before).alias("n_lines"),
        F.count_if(before & F.col("has_non_positive_quantity")).alias("n_nonpos"),
        F.count_if(before & F.col("new_invoice")).alias("n_invoices"),
        F.count_if(before & F.col("new_product")).alias("n_products"),
        F.bool_or((ts > t) & real).alias("_returned"),
    ).filter(F.col("n_real") > 0)
    out = finish_features(agg.withColumnRenamed("T", "snapshot_date"), F.col("snapshot_date"), money)
    return out.withColumn("is_churned", ~F.coalesce(F.col("_returned"), F.lit(False))).select(*SNAPSHOT_COLUMNS)


def per_snapshot_counts(panel: DataFrame, cal: Calendar) -> DataFrame:
    """U16: customers, churned and churn rate per usable snapshot.

    Starts from the calendar, so a snapshot with no customers is still
    reported (0, 0, 0.0).
    """
    spark = panel.sparkSession
    cal_df = calendar_frame(spark, cal, usable_only=True).select("snapshot_date")
    counts = panel.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(F.col("is_churned")).alias("n_churned"))
    # both sides hold at most one row per month: bounded broadcast
    joined = cal_df.join(F.broadcast(counts), "snapshot_date", "left")
    n = F.coalesce(F.col("n_customers"), F.lit(0)).cast("bigint")
    c = F.coalesce(F.col("n_churned"), F.lit(0)).cast("bigint")
    return joined.select(
        "snapshot_date", n.alias("n_customers"), c.alias("n_churned"),
        F.when(n > 0, c.cast("double") / n.cast("double")).otherwise(F.lit(0.0)).alias("churn_rate"))


def overall_report(panel: DataFrame, cal: Calendar) -> DataFrame:
    """U16 (overall part): one flat row."""
    agg = panel.agg(F.count(F.lit(1)).alias("rows_total"),
                    F.count_if(F.col("is_churned")).alias("n_churned"))
    return _overall_columns(agg, cal)


def _overall_columns(agg: DataFrame, cal: Calendar) -> DataFrame:
    rows = F.col("rows_total").cast("bigint")
    extra = [c for c in agg.columns if c not in ("rows_total", "n_churned")]
    return agg.select(
        F.lit(cal.threshold_days).cast("bigint").alias("threshold_days"),
        F.lit(cal.max_invoice_date.isoformat()).alias("max_invoice_date_observed"),
        F.lit(cal.cutoff.isoformat()).alias("last_labelable_cutoff"),
        F.lit(cal.start.isoformat()).alias("snapshot_start_date"),
        F.lit(cal.n_candidates).cast("bigint").alias("candidate_snapshot_dates"),
        F.lit(cal.n_usable).cast("bigint").alias("usable_snapshot_dates"),
        rows.alias("rows_total"),
        F.when(rows > 0, F.col("n_churned").cast("double") / rows.cast("double"))
        .otherwise(F.lit(0.0)).alias("churn_rate_overall"),
        *extra,
    )


def panel_report(panel: DataFrame, cal: Calendar) -> DataFrame:
    """The nested report row: overall fields + per_snapshot array by date.

    One aggregate over the per-snapshot rows (at most one per month, so the
    array is bounded) gives both the array and the overall totals.
    """
    per = per_snapshot_counts(panel, cal)
    agg = per.agg(
        F.coalesce(F.sum("n_customers"), F.lit(0)).cast("bigint").alias("rows_total"),
        F.coalesce(F.sum("n_churned"), F.lit(0)).cast("bigint").alias("n_churned"),
        F.array_sort(F.collect_list(F.struct(
            iso_format(F.col("snapshot_date")).alias("snapshot_date"),
            "n_customers", "n_churned", "churn_rate"))).alias("per_snapshot"))
    return _overall_columns(agg, cal)  # carries per_snapshot through


def population_parity(clean: DataFrame, panel: DataFrame, cal: Calendar) -> DataFrame:
    """Panel rows vs the label population, per snapshot.

    The label population at T is every customer whose first real purchase
    is before T, derived here independently of the panel plan. Both
    mismatch counts must be zero.
    """
    spark = clean.sparkSession
    if cal.n_usable == 0:
        return spark.createDataFrame([], "snapshot_date timestamp_ntz, n_feature_rows bigint, "
                                         "n_label_rows bigint, n_only_features bigint, n_only_labels bigint")
    first = (clean.filter(is_real() & F.col("invoice_date").isNotNull())
             .groupBy("customer_id").agg(F.min("invoice_date").alias("invoice_date")))
    # snapshots strictly after the first real purchase are j = g .. K-1 with
    # g = #{T_i <= first}: generated per customer, no join with the calendar
    g = _bucket_columns(cal)["g"]
    labelled = (first.withColumn("_g", g).filter(F.col("_g") < cal.n_usable)
                .select("customer_id", F.explode(F.sequence(F.col("_g"), F.lit(cal.n_usable - 1))).alias("j"))
                .select("customer_id", _snapshot_date(cal, F.col("j")).alias("snapshot_date"),
                        F.lit(True).alias("_in_labels")))
    featured = panel.select("customer_id", "snapshot_date", F.lit(True).alias("_in_features"))
    both = featured.join(labelled, ["customer_id", "snapshot_date"], "full_outer")
    counts = both.groupBy("snapshot_date").agg(
        F.count_if(F.col("_in_features")).alias("n_feature_rows"),
        F.count_if(F.col("_in_labels")).alias("n_label_rows"),
        F.count_if(F.col("_in_features") & F.col("_in_labels").isNull()).alias("n_only_features"),
        F.count_if(F.col("_in_labels") & F.col("_in_features").isNull()).alias("n_only_labels"))
    cal_df = calendar_frame(spark, cal, usable_only=True).select("snapshot_date")
    # both sides hold at most one row per month: bounded broadcast
    return cal_df.join(F.broadcast(counts), "snapshot_date", "left").select(
        "snapshot_date",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in
          ["n_feature_rows", "n_label_rows", "n_only_features", "n_only_labels"]])


def build_customer_snapshots(clean: DataFrame, snapshot_start_date,
                             threshold_days: int) -> tuple[DataFrame, DataFrame, Calendar]:
    """(panel, nested report row, calendar)."""
    cal = calendar_for(clean, snapshot_start_date, threshold_days)
    panel = snapshot_panel(clean, cal)
    return panel, panel_report(panel, cal), cal


__all__ = [
    "build_customer_snapshots",
    "overall_report",
    "panel_report",
    "per_snapshot_counts",
    "population_parity",
    "snapshot_panel",
    "snapshot_panel_range",
]
