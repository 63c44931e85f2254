"""Registered queries: one Spark job per operator, each over whole tables.

Every callable takes (spark, sf_dir) and returns a DataFrame whose columns
match the DuckDB oracle in ``churnlens.oracle_sql``. Intermediate tables that a
query needs (clean table, panel, histograms, model) are written when it is
called; its result is lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.columns import MONTH_COLUMN, ntz, parse_timestamp, round_significant, up_to_month, with_month
from churnlens.operators import clean as C
from churnlens.operators.features import customer_features, is_real, single_customer_features
from churnlens.operators.drift import drift_report, ks_statistic, psi, summary_drift
from churnlens.operators.gaps import favourite_product, gap_histogram, gap_percentiles
from churnlens.operators.labels import churn_labels
from churnlens.operators.model import (append_predictions, batch_predictions, churn_probability, evaluate_model, load_model,
                                       risk_level, save_model, train_churn_model)
from churnlens.operators.shapley import baseline_point, global_importance, shapley_contributions
from churnlens.operators.tree_paths import path_contributions
from churnlens.operators.metrics import confusion_at, pr_curve, pr_summary, recency_baseline_score
from churnlens.operators.split import split_counts, temporal_split
from churnlens.params import SYNTHETIC_PARAMS as P
from churnlens.plans import snapshots as S
from churnlens.plans.drift_months import MonthHistograms
from churnlens.plans.increments import PanelStore
from churnlens.plans.calendar import calendar_for, calendar_frame
from churnlens.plans.jobs import run_feature_engineering, run_ingestion, run_validation, verification_frame
from churnlens.schemas import FEATURE_COLUMNS, PANEL_REPORT_SCHEMA, RAW_SCHEMA, SNAPSHOT_SCHEMA
from churnlens.session import drop_scratch, materialize, scratch_path
from churnlens.sources.tables import TableTarget, read_report_json, write_report_json
from churnlens.sources.parts import list_parts, load_parts, part_row_counts
from churnlens.sources.retail_view import export_raw_parts, raw_by_part, raw_transactions_from_tables

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark, sf):
    return raw_transactions_from_tables(spark, sf)


def _clean(spark, sf) -> DataFrame:
    return C.clean_transactions(_raw(spark, sf), P.reference_date)


def _clean_persisted(spark, sf) -> DataFrame:
    """Clean table written once to the shared folder and read back.

    Cuts the raw -> clean lineage (a lost executor replays from the file,
    not from the five-way join) and lets later scans prune columns and
    push date filters into Parquet.
    """
    return materialize(_clean(spark, sf), "clean_transactions")


def _clean_by_month(spark, sf) -> DataFrame:
    """The clean table laid out in folders by invoice month, as the jobs keep it: date-bounded
    reads skip later months."""
    return materialize(with_month(_clean(spark, sf)), "clean_by_month", partition_by=MONTH_COLUMN)


def _exported_parts(spark, sf) -> dict[str, str]:
    """The raw log written once as a folder of named parts, then listed."""
    root = export_raw_parts(spark, sf, P.expected_parts, scratch_path(spark, "raw_export"))
    return list_parts(spark, root)


def q_raw_union_counts(spark, sf):
    tagged, _, _ = load_parts(spark, _exported_parts(spark, sf), P.expected_parts)
    return part_row_counts(tagged)


def q_raw_quarantine(spark, sf):
    """U1 from text: the raw log as CSV parts, some values of which the declared types do not hold; the ingestion job keeps the good
    lines and puts the others aside as they stand."""
    raw = raw_by_part(spark, sf, P.expected_parts)
    code = F.col("StockCode").cast("long")
    text = raw.withColumns({
        "Price": F.when(code % 13 == 0, F.concat(F.lit("£"), F.col("Price").cast("string"))).otherwise(F.col("Price").cast("string")),
        "Quantity": F.when(code % 17 == 0, F.concat(F.col("Quantity").cast("string"), F.lit(".0"))).otherwise(F.col("Quantity").cast("string"))})
    base = scratch_path(spark, "csv_parts")
    text.write.partitionBy("part").option("header", True).csv(f"{base}/source")
    raw_t, aside = TableTarget(f"{base}/raw"), TableTarget(f"{base}/quarantine", mode="append")
    run_ingestion(spark, list_parts(spark, f"{base}/source"), P.expected_parts, raw_t, "csv", RAW_SCHEMA, {"header": "true"}, aside)
    good = raw_t.read(spark).agg(F.lit("kept").alias("kind"), F.count(F.lit(1)).alias("rows"), F.sum("Quantity").alias("quantity"))
    bad = aside.read(spark).groupBy(F.concat(F.lit("put aside: "), F.col("part")).alias("kind")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("long").alias("quantity"))
    return good.union(bad)


def q_raw_rename(spark, sf):
    return C.rename_to_contract(_raw(spark, sf))


def q_dedup_exact(spark, sf):
    return C.drop_exact_duplicates(C.rename_to_contract(_raw(spark, sf)))


def q_exclude_no_customer(spark, sf):
    return C.exclude_without_customer(C.drop_exact_duplicates(C.rename_to_contract(_raw(spark, sf))))


def q_quality_flags(spark, sf):
    kept = C.exclude_without_customer(C.drop_exact_duplicates(C.rename_to_contract(_raw(spark, sf))))
    return C.add_quality_flags(kept, P.reference_date)


def q_clean_transactions(spark, sf):
    return _clean(spark, sf)


def q_validation_report(spark, sf):
    return C.validation_report(_raw(spark, sf), P.reference_date)


def q_customer_features_asof(spark, sf):
    return customer_features(_clean_persisted(spark, sf), P.as_of_date)


def q_single_customer_features(spark, sf):
    clean = _clean_by_month(spark, sf)
    # the customer is chosen by Spark from the data: most real lines before
    # the date, ties to the smallest id (a top-1 pick is the feature here)
    top = (up_to_month(clean, parse_timestamp(P.as_of_date)).filter(is_real() & (F.col("invoice_date") < ntz(P.as_of_date)))
           .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc("customer_id")).limit(1).select("customer_id"))
    return single_customer_features(clean, top, P.as_of_date)


def q_churn_labels(spark, sf):
    return churn_labels(_clean(spark, sf), P.as_of_date, P.threshold_days)


def q_snapshot_calendar(spark, sf):
    cal = calendar_for(_clean(spark, sf), P.snapshot_start_date, P.threshold_days)
    return calendar_frame(spark, cal).select("snapshot_date", "is_usable")


def _panel(spark, sf):
    # read whole a few times by one query: laying it out by month would cost more than it skips
    clean = _clean_persisted(spark, sf)
    cal = calendar_for(clean, P.snapshot_start_date, P.threshold_days)
    return clean, S.snapshot_panel(clean, cal), cal


def _panel_persisted(spark, sf):
    """The panel as downstream jobs see it: a written table, read back."""
    clean, panel, cal = _panel(spark, sf)
    return clean, materialize(panel, "customer_snapshots"), cal


def q_customer_snapshots(spark, sf):
    return _panel(spark, sf)[1]


def q_panel_increments(spark, sf):
    """U14 kept up to date: the lines arrive in three batches (the second holds late ones), only months that they change are written."""
    clean = _clean_persisted(spark, sf)
    store = PanelStore(scratch_path(spark, "panel_store"), P.snapshot_start_date, P.threshold_days)
    late = F.col("stock_code").cast("long") % 50 == 0
    early = F.col("invoice_date") < ntz(P.as_of_date)
    recent = F.col("invoice_date") >= ntz(P.test_start_date)
    store.update(clean.filter(early & ~late), "first")
    store.update(clean.filter(~early & ~recent | early & late), "second")
    store.update(clean.filter(recent), "third")
    return store.panel(spark)


def q_snapshot_report(spark, sf):
    _, panel, cal = _panel(spark, sf)
    return S.per_snapshot_counts(panel, cal)


def q_panel_report_overall(spark, sf):
    _, panel, cal = _panel(spark, sf)
    return S.overall_report(panel, cal)


def q_population_parity(spark, sf):
    clean, panel, cal = _panel(spark, sf)
    return S.population_parity(clean, panel, cal)


def q_rowcount_check(spark, sf):
    """The three jobs end to end, each table re-read and counted."""
    base = scratch_path(spark, "jobs")
    raw_t, clean_t, panel_t = (TableTarget(f"{base}/{name}", options={"compression": "zstd"})
                               for name in ("raw_transactions", "clean_transactions", "customer_snapshots"))
    root = export_raw_parts(spark, sf, P.expected_parts, scratch_path(spark, "raw_export"))
    a = run_ingestion(spark, list_parts(spark, root), P.expected_parts, raw_t)
    drop_scratch(spark, root)  # the raw table holds its rows by now, and nothing reads it again
    b = run_validation(spark, raw_t, clean_t, f"{base}/validation_report", P.reference_date)
    c = run_feature_engineering(spark, clean_t, panel_t, f"{base}/feature_engineering_report",
                                P.snapshot_start_date, P.threshold_days)
    return verification_frame(spark, [a["check"], b["check"], c["check"]])


def q_table_replace(spark, sf):
    """A second replace write leaves only the second frame."""
    clean = _clean_persisted(spark, sf)
    target = TableTarget(scratch_path(spark, "replace"), mode="replace")
    target.write(clean.filter(F.col("is_cancellation")))
    target.write(clean)
    return target.read(spark)


def q_table_replace_month(spark, sf):
    """U21 for one folder: a panel with one month spoilt, which is then replaced; all other months stay by reference."""
    _, panel, _ = _panel_persisted(spark, sf)
    target = TableTarget(scratch_path(spark, "replace_month"), schema=SNAPSHOT_SCHEMA, partition_by=["snapshot_date"])
    hit = F.col("snapshot_date") == ntz(P.as_of_date)
    target.write(panel.withColumn("is_churned", F.when(hit, ~F.col("is_churned")).otherwise(F.col("is_churned"))))
    target.replace_parts(panel.filter(hit))
    return target.read(spark)


def q_table_append(spark, sf):
    """Two appends keep both frames."""
    clean = _clean_persisted(spark, sf)
    target = TableTarget(scratch_path(spark, "append"), mode="append")
    target.write(clean.filter(F.col("is_cancellation")))
    target.write(clean.filter(~F.col("is_cancellation")))
    return target.read(spark)


def q_append_new_fields(spark, sf):
    """U20 + U22: appends whose rows have gained fields; each field of every append is read back."""
    clean = _clean_persisted(spark, sf)
    target = TableTarget(scratch_path(spark, "append_fields"), mode="append")
    few = ["customer_id", "invoice", "quantity"]
    target.write(clean.filter(F.col("is_cancellation")).select(few))
    target.write(clean.filter(~F.col("is_cancellation")).select("country", *few, "invoice_date"))
    return target.read(spark)


def q_refused_inputs(spark, sf):
    """The error of each input that a table refuses, and the rows that the table holds after it."""
    clean = _clean_persisted(spark, sf)
    target = TableTarget(scratch_path(spark, "refusing"), mode="append")
    target.write(clean.select("customer_id", "quantity"))
    inputs = {
        "unknown mode": lambda: TableTarget(target.path, mode="upsert"),
        "no path": lambda: TableTarget.from_config({"mode": "append"}),
        "rows that are no frame": lambda: target.write(clean.columns),
        "field of another type": lambda: target.write(clean.select("customer_id", F.col("quantity").cast("string").alias("quantity"))),
        "field in another case": lambda: target.write(clean.select("customer_id", F.col("quantity").alias("Quantity"))),
    }
    found = []
    for name, attempt in inputs.items():
        try:
            attempt()
        except (KeyError, TypeError, ValueError) as error:
            found.append((name, type(error).__name__))
    rows = target.read(spark).agg(F.count(F.lit(1)).alias("rows_held")).withColumn("_k", F.lit(0))  # one row
    cases = spark.createDataFrame(found, "input string, error string").withColumn("_k", F.lit(0))
    return cases.join(rows, "_k").select("input", "error", "rows_held")


def q_report_json_roundtrip(spark, sf):
    """Nested panel report -> JSON -> read back with its schema."""
    _, panel, cal = _panel(spark, sf)
    path = scratch_path(spark, "feature_engineering_report")
    write_report_json(S.panel_report(panel, cal), path)
    back = read_report_json(spark, path, PANEL_REPORT_SCHEMA)
    return (back.select("threshold_days", "rows_total", F.explode("per_snapshot").alias("s"))
            .select("threshold_days", "rows_total", "s.*"))


def q_purchase_gap_percentile(spark, sf):
    return gap_percentiles(gap_histogram(_clean(spark, sf)))


def q_purchase_gap_histogram(spark, sf):
    return gap_histogram(_clean(spark, sf))


def q_favourite_product(spark, sf):
    return favourite_product(_clean(spark, sf), P.as_of_date)


def _split_panel(spark, sf, with_clean: bool = False):
    clean, panel, _ = _panel_persisted(spark, sf)
    split = temporal_split(panel, P.test_start_date, P.threshold_days)
    return (split, clean) if with_clean else split


def q_temporal_split_counts(spark, sf):
    return split_counts(_split_panel(spark, sf))


def _baseline_curve(spark, sf):
    test = _split_panel(spark, sf).filter(F.col("split") == "test")
    return pr_curve(recency_baseline_score(test, P.threshold_days))


def q_pr_curve(spark, sf):
    return _baseline_curve(spark, sf)


def q_recall_at_precision(spark, sf):
    out = pr_summary(_baseline_curve(spark, sf), P.min_precision)
    return out.withColumn("average_precision", F.round("average_precision", 12))


def _drift_sides(spark, sf):
    sp = _split_panel(spark, sf)
    return sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test")


def q_feature_drift_psi(spark, sf):
    base, cur = _drift_sides(spark, sf)
    return psi(base, cur, P.drift_bins).withColumn("psi", F.round("psi", 9))


def q_feature_drift_ks(spark, sf):
    base, cur = _drift_sides(spark, sf)
    return ks_statistic(base, cur)


def q_feature_drift_summary(spark, sf):
    base, cur = _drift_sides(spark, sf)
    out = summary_drift(base, cur)
    return out.withColumns({c: round_significant(F.col(c)) for c in out.columns if c.startswith(("mean_", "std_"))})


def q_drift_report(spark, sf):
    """D8 as one report; float figures rounded, as their last bits depend on the order of sums."""
    base, cur = _drift_sides(spark, sf)
    out = drift_report(base, cur, P.drift_bins).withColumn("psi", F.round("psi", 9))
    return out.withColumns({c: round_significant(F.col(c)) for c in out.columns if c.startswith(("mean_", "std_"))})


def q_drift_between_months(spark, sf):
    """D8 between two stored months, from their value counts alone."""
    store = MonthHistograms(scratch_path(spark, "month_histograms"))
    store.update(_panel_persisted(spark, sf)[1])
    out = store.report(spark, [P.as_of_date], [P.test_start_date], P.drift_bins).withColumn("psi", F.round("psi", 9))
    return out.withColumns({c: round_significant(F.col(c)) for c in out.columns if c.startswith(("mean_", "std_"))})


# One model per application and source folder, as a job would keep it: trained by the first
# query that needs it, saved, and loaded by the others.
_MODELS: dict[tuple[str, str], tuple[str, DataFrame, DataFrame]] = {}


def _trained(spark, sf):
    """(model, train, test, clean); the model has the configured number of trees."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        sp, clean = _split_panel(spark, sf, with_clean=True)
        path = scratch_path(spark, "churn_model")
        save_model(train_churn_model(sp.filter(F.col("split") == "train"), P.model_params), path)
        _MODELS[key] = (path, sp, clean)
    path, sp, clean = _MODELS[key]
    return load_model(path), sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test"), clean


def _checked(scored: DataFrame) -> list:
    """What SQL can tell about a score without the model: its range, and the band that it falls in."""
    p = F.col("churn_probability")
    high, medium = P.risk_bands[0][1], P.risk_bands[1][1]
    band = F.when(p < medium, "low").when(p < high, "medium").otherwise("high")
    return [p.between(0.0, 1.0).alias("probability_in_range"), (F.col("risk_level") == band).alias("band_fits")]


def q_train_and_score(spark, sf):
    """D3 + D7: train on the train split, score every test row, band the risk."""
    model, _, test, _ = _trained(spark, sf)
    scored = churn_probability(model, test).withColumn("risk_level", risk_level(F.col("churn_probability"), P.risk_bands))
    return scored.select("customer_id", "snapshot_date", "is_churned", *_checked(scored))


def q_model_evaluation(spark, sf):
    """D4 on the trained model: its row of the metrics table, appended and read back."""
    model, _, test, _ = _trained(spark, sf)
    target = TableTarget(scratch_path(spark, "training_metrics"), mode="append")
    target.write(evaluate_model(model, test, P.model_params, P.min_precision))
    r = target.read(spark)
    figures = ("average_precision", "recall_at_precision")
    return r.select("n_rows", "n_positive", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_judged"),
                    (F.col("tp") + F.col("fn")).alias("n_churned"), "max_iter", "min_precision",
                    *[F.col(c).between(0.0, 1.0).alias(f"{c}_in_range") for c in figures])


def q_shapley_contributions(spark, sf):
    """D5 on the trained model: contributions add up to prediction - base value on every test row."""
    model, train, test, _ = _trained(spark, sf)
    out = path_contributions(model, test, baseline_point(train))
    total = sum((F.col(f"phi_{c}") for c in FEATURE_COLUMNS), F.lit(0.0))
    return out.select("customer_id", "snapshot_date", (F.abs(total - (F.col("prediction") - F.col("base_value"))) < 1e-9).alias("adds_up"))


def q_global_importance(spark, sf):
    """D6 on the trained model: every feature once, with a rank of its own."""
    model, train, test, _ = _trained(spark, sf)
    out = global_importance(path_contributions(model, test, baseline_point(train)))
    return out.select("feature", (F.col("mean_abs_contribution") >= F.abs("mean_contribution") - 1e-12).alias("not_below_its_mean"),
                      F.col("rank").between(1, len(FEATURE_COLUMNS)).alias("ranked"))


def formula_score(df: DataFrame) -> DataFrame:
    """A fixed score with interactions, for checking contributions against SQL."""
    r, f, q = F.col("recency_days"), F.col("frequency"), F.col("return_rate")
    m, t, n = F.col("monetary_total"), F.col("customer_tenure_days"), F.col("n_distinct_products")
    score = (r / (r + F.lit(134.0)) * (F.lit(1.0) - q) * F.lit(0.5) + F.lit(0.3) / (F.lit(2.0) + f) * t / (t + F.lit(365.0))
             + F.lit(0.1) / (F.lit(2.0) + n) + F.lit(0.1) * F.col("monetary_avg_order") / (F.abs(m) + F.lit(1000.0)))
    return df.withColumn("churn_probability", score)


def _formula_contributions(spark, sf):
    sp = _split_panel(spark, sf)
    return shapley_contributions(formula_score, sp.filter(F.col("split") == "test"),
                                 baseline_point(sp.filter(F.col("split") == "train")))


def q_shapley_formula(spark, sf):
    """D5 over a fixed formula, where SQL can evaluate all 128 coalitions."""
    out = _formula_contributions(spark, sf)
    return out.select("customer_id", "snapshot_date", *[
        F.round(c, 6).alias(c) for c in out.columns if c not in ("customer_id", "snapshot_date")])


def q_importance_formula(spark, sf):
    """D6 over the same formula."""
    out = global_importance(_formula_contributions(spark, sf))
    return out.select("feature", F.round("mean_abs_contribution", 6).alias("mean_abs_contribution"),
                      F.round("mean_contribution", 6).alias("mean_contribution"), "rank")


def q_batch_predictions(spark, sf):
    """Score the one-date features of every customer; append to the log."""
    model, _, _, clean = _trained(spark, sf)
    feats = customer_features(clean, P.test_start_date)
    preds = batch_predictions(model, feats, P.test_start_date, P.risk_bands)
    target = TableTarget(scratch_path(spark, "predictions"), mode="append")
    append_predictions(preds, target)
    log = target.read(spark)
    return log.select("customer_id", "as_of_date", *_checked(log))


def q_streaming_predictions(spark, sf):
    """D7 as a stream: feature batches for two dates arrive as files and are
    scored micro-batch by micro-batch into the append-only log."""
    from churnlens.streaming.scoring import read_prediction_log, start_prediction_stream

    model, _, _, clean = _trained(spark, sf)
    base = scratch_path(spark, "prediction_stream")
    for i, day in enumerate([P.as_of_date, P.test_start_date]):
        feats = customer_features(clean, day).withColumn("as_of_date", ntz(day))
        feats.write.mode("overwrite").parquet(f"{base}/features/part_{i}")
        # the second date is scored by the same stream, started again from its checkpoint
        start_prediction_stream(spark, model, f"{base}/features/*", f"{base}/log", f"{base}/checkpoint",
                                P.risk_bands).awaitTermination()
    log = read_prediction_log(spark, f"{base}/log")
    return log.select("customer_id", "as_of_date", *_checked(log))


def q_confusion_counts(spark, sf):
    """Confusion counts of the baseline score at 0.5 on the test split."""
    test = _split_panel(spark, sf).filter(F.col("split") == "test")
    return confusion_at(recency_baseline_score(test, P.threshold_days), 0.5)


def q_customer_snapshots_range(spark, sf):
    """U14 by the range plan (same rows as the bucketed plan), its cross-check."""
    clean = _clean_by_month(spark, sf)
    cal = calendar_for(clean, P.snapshot_start_date, P.threshold_days)
    return S.snapshot_panel_range(clean, cal)


QUERIES: dict[str, Query] = {
    "raw_union_counts": q_raw_union_counts,
    "raw_quarantine": q_raw_quarantine,
    "raw_rename": q_raw_rename,
    "dedup_exact": q_dedup_exact,
    "exclude_no_customer": q_exclude_no_customer,
    "quality_flags": q_quality_flags,
    "clean_transactions": q_clean_transactions,
    "validation_report": q_validation_report,
    "customer_features_asof": q_customer_features_asof,
    "single_customer_features": q_single_customer_features,
    "churn_labels": q_churn_labels,
    "snapshot_calendar": q_snapshot_calendar,
    "customer_snapshots": q_customer_snapshots,
    "panel_increments": q_panel_increments,
    "snapshot_report": q_snapshot_report,
    "panel_report_overall": q_panel_report_overall,
    "population_parity": q_population_parity,
    "rowcount_check": q_rowcount_check,
    "table_replace": q_table_replace,
    "table_replace_month": q_table_replace_month,
    "table_append": q_table_append,
    "append_new_fields": q_append_new_fields,
    "refused_inputs": q_refused_inputs,
    "report_json_roundtrip": q_report_json_roundtrip,
    "purchase_gap_percentile": q_purchase_gap_percentile,
    "purchase_gap_histogram": q_purchase_gap_histogram,
    "favourite_product": q_favourite_product,
    "temporal_split_counts": q_temporal_split_counts,
    "pr_curve": q_pr_curve,
    "recall_at_precision": q_recall_at_precision,
    "feature_drift_psi": q_feature_drift_psi,
    "feature_drift_ks": q_feature_drift_ks,
    "feature_drift_summary": q_feature_drift_summary,
    "train_and_score": q_train_and_score,
    "shapley_contributions": q_shapley_contributions,
    "global_importance": q_global_importance,
    "model_evaluation": q_model_evaluation,
    "shapley_formula": q_shapley_formula,
    "importance_formula": q_importance_formula,
    "drift_report": q_drift_report,
    "drift_between_months": q_drift_between_months,
    "batch_predictions": q_batch_predictions,
    "streaming_predictions": q_streaming_predictions,
    "confusion_counts": q_confusion_counts,
    "customer_snapshots_range": q_customer_snapshots_range,
}
