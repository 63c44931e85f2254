"""Write PLANS.md: formatted physical plans of the key queries (sf0.01).

For each query: the operator tree and, for every Parquet scan, its pushed
filters and read schema. Regenerate after plan changes:
    python tools/show_plans.py > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlens import queries as Q  # noqa: E402
from churnlens.params import SYNTHETIC_PARAMS as P  # noqa: E402
from churnlens.plans import snapshots as S  # noqa: E402
from churnlens.plans.calendar import calendar_for  # noqa: E402
from churnlens.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.01"


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    tree, _, details = text.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.splitlines()[0]:
            head = block.splitlines()[0].strip()
            keep = [ln for ln in block.splitlines() if ln.startswith(("PartitionFilters", "PushedFilters", "ReadSchema", "Location"))]
            keep = [re.sub(r"InMemoryFileIndex \[file:.*/([^/]+)\]", r"\1", ln) for ln in keep]
            scans.append("\n".join([head, *keep]))
    return tree.strip() + ("\n\n" + "\n\n".join(scans) if scans else "")


def main() -> None:
    spark = get_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    clean = Q._clean_by_month(spark, SF)
    cal = calendar_for(clean, P.snapshot_start_date, P.threshold_days)
    panel = S.snapshot_panel(clean, cal)
    items = [
        ("Source view + cleaning (`clean_transactions`)", Q._clean(spark, SF)),
        ("Validation report (one aggregate over distinct rows + copies)", Q.q_validation_report(spark, SF)),
        ("Features at one date (`customer_features_asof`)", Q.q_customer_features_asof(spark, SF)),
        ("Labels at one date (`churn_labels`)", Q.q_churn_labels(spark, SF)),
        ("Snapshot panel (`customer_snapshots`)", Q.q_customer_snapshots(spark, SF)),
        ("Snapshot panel, range plan (`customer_snapshots_range`, cross-check only)", Q.q_customer_snapshots_range(spark, SF)),
        ("Population parity (no calendar join)", S.population_parity(clean, panel, cal)),
        ("Purchase gap percentile", Q.q_purchase_gap_percentile(spark, SF)),
        ("PR curve (histogram materialized once; range-bucketed running totals)", Q.q_pr_curve(spark, SF)),
    ]
    print("# Physical plans of the key queries\n")
    print("Generated by `tools/show_plans.py` at sf0.01 on local[8] (AQE on; the final plan can differ at")
    print("run time, e.g. a shuffle join turned into a broadcast when a side is measured small).\n")
    for title, df in items:
        print(f"## {title}\n\n```\n{summary(formatted(df))}\n```\n")


if __name__ == "__main__":
    main()
