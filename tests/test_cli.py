"""The three stages end to end through the command-line entry."""

from __future__ import annotations

import tempfile

from churnlens.__main__ import main
from churnlens.params import SYNTHETIC_PARAMS as P
from churnlens.sources.parts import list_parts
from churnlens.sources.retail_view import export_raw_parts


def test_csv_parts_through_every_stage(spark):
    base = tempfile.mkdtemp(prefix="cli-")
    export_raw_parts(spark, "/root/testdata/sf0.001", P.expected_parts, f"{base}/parquet")
    for name, path in list_parts(spark, f"{base}/parquet").items():
        spark.read.parquet(path).write.option("header", True).csv(f"{base}/source/{name}")
    out = main(["all", "--warehouse", f"{base}/wh", "--source", f"{base}/source", "--format", "csv", "--trees", "3",
                "--expected-parts", *P.expected_parts, "--reference-date", P.reference_date, "--test-start", P.test_start_date,
                "--snapshot-start", P.snapshot_start_date, "--threshold-days", str(P.threshold_days)])
    assert all(out[stage]["check"]["matches"] for stage in out)
    assert set(out) == {"ingestion", "validation", "feature_engineering", "training", "explanation", "scoring", "drift"}
    again = main(["scoring", "--warehouse", f"{base}/wh", "--as-of", P.as_of_date, "--threshold-days", str(P.threshold_days)])
    assert again["scoring"]["check"]["matches"]
    assert sorted(r["rank"] for r in out["explanation"]["importance"]) == list(range(1, 8))


def test_all_stages_from_a_parts_folder(spark):
    base = tempfile.mkdtemp(prefix="cli-")
    export_raw_parts(spark, "/root/testdata/sf0.001", P.expected_parts, f"{base}/source")
    assert list(list_parts(spark, f"{base}/source")) == list(P.expected_parts)
    out = main(["all", "--warehouse", f"{base}/wh", "--source", f"{base}/source", "--trees", "2", "--test-start", P.test_start_date,
                "--expected-parts", *P.expected_parts, "--reference-date", P.reference_date,
                "--snapshot-start", P.snapshot_start_date, "--threshold-days", str(P.threshold_days)])
    ing, val, fe = out["ingestion"], out["validation"], out["feature_engineering"]
    assert not ing["used_fallback"] and ing["check"]["matches"]
    assert ing["row_counts"]["total"] == val["report"]["source_rows"]
    assert val["check"]["matches"] and fe["check"]["matches"]
    r = val["report"]
    assert (r["source_rows"] - r["duplicate_rows_dropped"] - r["rows_without_customer_id_excluded"]
            == r["clean_transactions_rows"])
    assert fe["report"]["rows_total"] > 0
