"""End-to-end jobs with persisted tables and count checks.

Each job reads its input table, writes its outputs once, and re-reads the
written table to check its row count against the recorded one. Counts
that a report needs are gathered with ``DataFrame.observe`` during the
write itself, so no job scans its input twice.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.columns import MONTH_COLUMN, with_month
from churnlens.operators import clean as C
from churnlens.operators.drift import drift_report
from churnlens.operators.features import customer_features, single_customer_features
from churnlens.operators.model import (append_predictions, batch_predictions, evaluate_model, load_model, save_model,
                                       train_churn_model)
from churnlens.operators.shapley import baseline_point, global_importance
from churnlens.operators.split import temporal_split
from churnlens.operators.tree_paths import path_contributions
from churnlens.params import Params
from churnlens.plans import snapshots as S
from churnlens.plans.calendar import calendar_for
from churnlens.schemas import FEATURE_COLUMNS, FLAG_COLUMNS, PANEL_REPORT_SCHEMA, VALIDATION_REPORT_SCHEMA, require_columns
from churnlens.session import freed_shuffles, materialize
from churnlens.sources.parts import MALFORMED_COLUMN, PART_COLUMN, load_parts, verify_row_count
from churnlens.sources.tables import TableTarget, read_report_json, write_report_json

log = logging.getLogger(__name__)


def run_ingestion(spark: SparkSession, parts: Mapping[str, object], expected: tuple[str, ...],
                  raw_target: TableTarget, fmt: str = "parquet", schema=None,
                  options: dict | None = None, quarantine_target: TableTarget | None = None) -> dict:
    """U1 + U2: parts -> raw table; per-part counts observed during the write.

    Lines of text with values that the declared schema does not hold go, as they stand, to ``quarantine_target`` (a history:
    mode 'append') and are counted per part; without such a table they fail the job.
    """
    put_aside = quarantine_target is not None
    if put_aside and quarantine_target.mode != "append":
        raise ValueError("quarantined lines are a history: their table needs mode 'append'")
    tagged, names, used_fallback = load_parts(spark, parts, expected, fmt, schema, options, put_aside)
    obs = Observation("ingestion_counts")
    good = F.col(MALFORMED_COLUMN).isNull() if put_aside else F.lit(True)
    metrics = [F.count_if(good).alias("total"), F.count_if(~good).alias("malformed")]
    for i, n in enumerate(names):
        mine = F.col(PART_COLUMN) == n
        metrics += [F.count_if(mine & good).alias(f"part_{i}"), F.count_if(mine & ~good).alias(f"malformed_{i}")]
    # observed before the filter, so one pass counts both kinds
    raw_target.write(tagged.observe(obs, *metrics).filter(good).drop(PART_COLUMN, MALFORMED_COLUMN))
    got = obs.get
    counts = {n: int(got[f"part_{i}"]) for i, n in enumerate(names)}
    counts["total"] = int(got["total"])
    check = verify_row_count("raw_transactions", raw_target.read(spark).count(), counts["total"])
    report = {"row_counts": counts, "used_fallback": used_fallback, "check": check}
    if put_aside:
        report["quarantined"] = {**{n: int(got[f"malformed_{i}"]) for i, n in enumerate(names)}, "total": int(got["malformed"])}
        if got["malformed"]:
            log.warning("%d lines hold values that the declared types do not; they are put aside.", got["malformed"])
            fields = [F.col(f"`{c}`") for c in tagged.columns if c not in (PART_COLUMN, MALFORMED_COLUMN)]
            quarantine_target.write(tagged.filter(~good).select(
                F.col(PART_COLUMN).alias("part"), F.col(MALFORMED_COLUMN).alias("record"),
                F.to_json(F.struct(*fields)).alias("read_as")))  # what of it the types do hold
    return report


def run_validation(spark: SparkSession, raw_target: TableTarget, clean_target: TableTarget,
                   report_path: str, reference_date=None) -> dict:
    """U3 + U11: raw -> clean table + JSON report; counts observed in the write."""
    raw = raw_target.read(spark)
    ref = C.resolve_reference_date(reference_date)
    renamed = C.rename_to_contract(raw)
    require_columns(renamed, C.REQUIRED, "raw transactions")
    distinct = C.distinct_with_copies(renamed)
    obs = Observation("validation_counts")
    clean = C.clean_from_distinct(distinct.observe(obs, *C.report_aggregates(ref)), ref)
    # a target laid out by month keeps the month as its folder
    clean_target.write(with_month(clean) if MONTH_COLUMN in clean_target.partition_by else clean)
    got = {k: int(v or 0) for k, v in obs.get.items()}
    report = {
        "source_rows": got["source_rows"],
        "duplicate_rows_dropped": got["duplicate_rows_dropped"],
        "rows_without_customer_id_excluded": got["rows_without_customer_id_excluded"],
        "clean_transactions_rows": got["clean_transactions_rows"],
        "reference_date_used": ref.isoformat(),
        "flags": {f: got[f] for f in FLAG_COLUMNS},
    }
    write_report_json(spark.createDataFrame([report], VALIDATION_REPORT_SCHEMA), report_path)
    stored = read_report_json(spark, report_path, VALIDATION_REPORT_SCHEMA).first()
    check = verify_row_count("clean_transactions", clean_target.read(spark).count(),
                             stored["clean_transactions_rows"])
    return {"report": report, "check": check}


def run_feature_engineering(spark: SparkSession, clean_target: TableTarget, panel_target: TableTarget,
                            report_path: str, snapshot_start_date, threshold_days: int) -> dict:
    """U14 + U16 + U17 + U18: clean -> panel table + JSON report, then the checks.

    The population of each snapshot is derived again from the clean table; a
    panel that holds other customers raises and names the snapshots.
    """
    clean = clean_target.read(spark)
    cal = calendar_for(clean, snapshot_start_date, threshold_days)
    panel_target.write(S.snapshot_panel(clean, cal))
    written = panel_target.read(spark)
    # one row per month reaches the driver
    with freed_shuffles(spark):
        odd = S.population_parity(clean, written, cal).filter("n_only_features > 0 OR n_only_labels > 0").collect()
    if odd:
        raise ValueError("the panel's population is not that of the labels at "
                         + ", ".join(f"{r['snapshot_date']:%Y-%m-%d} ({r['n_only_features']} only in the panel, "
                                     f"{r['n_only_labels']} missing)" for r in odd))
    # the report reads two narrow columns of the written panel
    write_report_json(S.panel_report(written, cal), report_path)
    stored = read_report_json(spark, report_path, PANEL_REPORT_SCHEMA).first()
    check = verify_row_count("customer_snapshots", written.count(), stored["rows_total"])
    return {"calendar": cal, "report": stored.asDict(recursive=True), "check": check}


def run_training(spark: SparkSession, panel_target: TableTarget, model_path: str, metrics_target: TableTarget,
                 params: Params) -> dict:
    """D2 + D3 + D4: panel -> saved model, and its row appended to the metrics table."""
    if metrics_target.mode != "append":
        raise ValueError("training metrics are a history: their table needs mode 'append'")
    split = temporal_split(panel_target.read(spark), params.test_start_date, params.threshold_days)
    save_model(train_churn_model(split.filter("split = 'train'"), params.model_params), model_path)
    before = metrics_target.read(spark).count() if metrics_target.exists(spark) else 0
    metrics_target.write(evaluate_model(load_model(model_path), split.filter("split = 'test'"), params.model_params,
                                        params.min_precision))
    check = verify_row_count("training_metrics", metrics_target.read(spark).count(), before + 1)
    return {"model": model_path, "check": check}


def run_explanation(spark: SparkSession, panel_target: TableTarget, model_path: str, contributions_target: TableTarget,
                    importance_target: TableTarget, params: Params) -> dict:
    """D5 + D6: contributions of the saved model on every test row, and their global ranking."""
    split = temporal_split(panel_target.read(spark), params.test_start_date, params.threshold_days)
    test = split.filter("split = 'test'")
    contributions_target.write(path_contributions(load_model(model_path), test, baseline_point(split.filter("split = 'train'"))))
    written = contributions_target.read(spark)
    importance_target.write(global_importance(written))
    check = verify_row_count("shapley_contributions", written.count(), test.count())
    return {"importance": [r.asDict() for r in importance_target.read(spark).orderBy("rank").collect()], "check": check}


def run_scoring(spark: SparkSession, clean_target: TableTarget, model_path: str, log_target: TableTarget,
                as_of_date, params: Params, customer_id: str | None = None) -> dict:
    """Features at a date, scored by the saved model and appended to the prediction log; of one customer only, if
    it is named (in a table sorted by customer the scan skips what does not hold it)."""
    clean = clean_target.read(spark)
    features = materialize(customer_features(clean, as_of_date) if customer_id is None
                           else single_customer_features(clean, customer_id, as_of_date), "features")
    before = log_target.read(spark).count() if log_target.exists(spark) else 0
    append_predictions(batch_predictions(load_model(model_path), features, as_of_date, params.risk_bands), log_target)
    return {"check": verify_row_count("predictions", log_target.read(spark).count(), before + features.count())}


def run_drift(spark: SparkSession, panel_target: TableTarget, report_target: TableTarget, params: Params) -> dict:
    """The test split's features against the train split's, as one saved report."""
    split = temporal_split(panel_target.read(spark), params.test_start_date, params.threshold_days)
    report_target.write(drift_report(split.filter("split = 'train'"), split.filter("split = 'test'"), params.drift_bins))
    written = report_target.read(spark)
    return {"report": [r.asDict() for r in written.orderBy("feature").collect()],  # one row per feature
            "check": verify_row_count("drift_report", written.count(), len(FEATURE_COLUMNS))}


def verification_frame(spark: SparkSession, checks: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [(c["table"], c["loaded_rows"], c["expected_rows"], c["matches"]) for c in checks],
        "table string, loaded_rows bigint, expected_rows bigint, matches boolean")


__all__ = ["run_drift", "run_explanation", "run_feature_engineering", "run_ingestion", "run_scoring", "run_training",
           "run_validation", "verification_frame"]
