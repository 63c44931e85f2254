"""Run one stage of the batch flow: ``python -m churnlens <stage> ...``.

Stages read and write tables under one warehouse folder:
  ingestion            <source folder of named parts> -> raw_transactions, quarantine (lines of text that the declared types do not hold)
  validation           raw_transactions -> clean_transactions + validation_report.json
  feature_engineering  clean_transactions -> customer_snapshots + feature_engineering_report.json
  training             customer_snapshots -> churn_model + training_metrics (appended)
  explanation          customer_snapshots, churn_model -> shapley_contributions, feature_importance
  scoring              clean_transactions, churn_model -> predictions (appended)
  drift                customer_snapshots -> drift_report
  all                  all of them in order
Each stage ends with its row-count check (logged, never fatal).
"""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import replace

from churnlens.params import Params
from churnlens.functions.columns import MONTH_COLUMN
from churnlens.plans.jobs import (run_drift, run_explanation, run_feature_engineering, run_ingestion, run_scoring,
                                  run_training, run_validation)
from churnlens.schemas import CLEAN_SCHEMA, RAW_SCHEMA, SNAPSHOT_SCHEMA
from churnlens.session import get_session, release_scratch
from churnlens.sources.parts import TEXT_FORMATS, list_parts
from churnlens.sources.tables import TableTarget

STAGES = ("ingestion", "validation", "feature_engineering", "training", "explanation", "scoring", "drift", "all")


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="churnlens")
    ap.add_argument("stage", choices=STAGES)
    ap.add_argument("--warehouse", required=True, help="folder holding the tables and reports")
    ap.add_argument("--source", help="folder of named source parts (ingestion)")
    ap.add_argument("--format", default="parquet", help="format of the source parts")
    ap.add_argument("--reference-date", default=Params().reference_date)
    ap.add_argument("--snapshot-start", default=Params().snapshot_start_date)
    ap.add_argument("--threshold-days", type=int, default=Params().threshold_days)
    ap.add_argument("--expected-parts", nargs="*", default=list(Params().expected_parts))
    ap.add_argument("--files-per-snapshot", type=int, default=None,
                    help="files written per snapshot month of the panel (default: by size)")
    ap.add_argument("--files-per-month", type=int, default=None,
                    help="files written per invoice month of the clean table (default: by size)")
    ap.add_argument("--test-start", default=Params().test_start_date, help="first snapshot of the test split")
    ap.add_argument("--as-of", default=None, help="date to score at (default: the first test snapshot)")
    ap.add_argument("--customer", default=None, help="score this customer only")
    ap.add_argument("--trees", type=int, default=Params().model_params["n_estimators"])
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")

    spark = get_session(args.master)
    wh = args.warehouse.rstrip("/")
    params = replace(Params(), test_start_date=args.test_start, threshold_days=args.threshold_days,
                     model_params={**Params().model_params, "n_estimators": args.trees})
    raw_t = TableTarget(f"{wh}/raw_transactions", empty_schema=RAW_SCHEMA)
    # lines lie in folders by invoice month, so date-bounded reads skip later months, and in each file by customer
    clean_t = TableTarget(f"{wh}/clean_transactions", partition_by=[MONTH_COLUMN],
                          files_per_partition=args.files_per_month, empty_schema=CLEAN_SCHEMA, sort_by=["customer_id"])
    # the panel is laid out by snapshot month, so per-snapshot reads prune folders
    panel_t = TableTarget(f"{wh}/customer_snapshots", schema=SNAPSHOT_SCHEMA, partition_by=["snapshot_date"],
                          files_per_partition=args.files_per_snapshot)
    out = {}
    if args.stage in ("ingestion", "all"):
        if not args.source:
            ap.error("ingestion needs --source")
        opts = {"header": "true"} if args.format == "csv" else None
        # text carries no types: the source's are declared
        schema = RAW_SCHEMA if args.format in TEXT_FORMATS else None
        aside = TableTarget(f"{wh}/quarantine", mode="append") if schema is not None else None
        out["ingestion"] = run_ingestion(spark, list_parts(spark, args.source), tuple(args.expected_parts), raw_t,
                                         fmt=args.format, schema=schema, options=opts, quarantine_target=aside)
    if args.stage in ("validation", "all"):
        res = run_validation(spark, raw_t, clean_t, f"{wh}/validation_report.json", args.reference_date)
        out["validation"] = res
    if args.stage in ("feature_engineering", "all"):
        res = run_feature_engineering(spark, clean_t, panel_t, f"{wh}/feature_engineering_report.json",
                                      args.snapshot_start, args.threshold_days)
        out["feature_engineering"] = {"report": {k: v for k, v in res["report"].items() if k != "per_snapshot"},
                                      "check": res["check"]}
    model = f"{wh}/churn_model"
    if args.stage in ("training", "all"):
        out["training"] = run_training(spark, panel_t, model, TableTarget(f"{wh}/training_metrics", mode="append"), params)
    if args.stage in ("explanation", "all"):
        out["explanation"] = run_explanation(spark, panel_t, model, TableTarget(f"{wh}/shapley_contributions"),
                                             TableTarget(f"{wh}/feature_importance"), params)
    if args.stage in ("scoring", "all"):
        out["scoring"] = run_scoring(spark, clean_t, model, TableTarget(f"{wh}/predictions", mode="append"),
                                     args.as_of or params.test_start_date, params, args.customer)
    if args.stage in ("drift", "all"):
        out["drift"] = run_drift(spark, panel_t, TableTarget(f"{wh}/drift_report"), params)
    release_scratch(spark)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
