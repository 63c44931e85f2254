"""Plan shapes that the scale design depends on."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from churnlens.operators.clean import validate_and_clean
from churnlens.functions.columns import with_month
from churnlens.operators.features import customer_features
from churnlens.operators.labels import churn_labels
from churnlens.plans import snapshots as S
from churnlens.plans.calendar import calendar_for
from churnlens.queries import QUERIES
from churnlens.session import materialize
from churnlens.sources.retail_view import raw_transactions_from_tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark):
    c, _ = validate_and_clean(raw_transactions_from_tables(spark, SF), "2001-07-01")
    p = tempfile.mkdtemp(prefix="plan-") + "/clean"
    c.write.parquet(p)
    return spark.read.parquet(p)


def test_bucketed_panel_has_no_range_or_cross_join_and_pushes_dates(clean):
    cal = calendar_for(clean, "1996-01-01", 134)
    p = plan(S.snapshot_panel(clean, cal))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "LessThanOrEqual(invoice_date" in p  # horizon filter reaches the scan
    assert p.count("Exchange hashpartitioning(customer_id") >= 1


def test_population_parity_needs_no_calendar_join(clean):
    cal = calendar_for(clean, "1996-01-01", 134)
    p = plan(S.population_parity(clean, S.snapshot_panel(clean, cal), cal))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_no_plan_has_a_nested_loop(clean):
    cal = calendar_for(clean, "1996-01-01", 134)
    p = plan(S.snapshot_panel_range(clean, cal))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_a_table_laid_out_by_month_is_read_up_to_the_date(spark, clean):
    by_month = materialize(with_month(clean), "by-month", partition_by="invoice_month")
    for df, last in ((customer_features(by_month, "1999-01-01"), "1999-01"), (churn_labels(by_month, "1999-01-01", 45), "1999-02")):
        p = plan(df)
        assert "PartitionFilters: [isnotnull(invoice_month" in p and f"<= {last})" in p
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert files(by_month.filter("invoice_month = '1997-05'")) <= 2 < files(by_month)
    assert sorted(map(str, customer_features(by_month, "1999-01-01").collect())) == \
        sorted(map(str, customer_features(clean, "1999-01-01").collect()))


def test_features_do_not_expand_lines(clean):
    assert "Expand" not in plan(customer_features(clean, "1999-01-01"))


def test_point_in_time_filter_reaches_scan(clean):
    assert "LessThan(invoice_date" in plan(customer_features(clean, "1999-01-01"))


def test_fact_tables_joined_by_shuffle(spark):
    p = plan(raw_transactions_from_tables(spark, SF))
    assert "SortMergeJoin" in p and "ShuffledHashJoin" not in p


@pytest.mark.parametrize("name", ["clean_transactions", "customer_features_asof", "customer_snapshots",
                                  "purchase_gap_percentile", "favourite_product", "pr_curve", "feature_drift_psi"])
def test_no_python_udf_in_plans(spark, name):
    p = plan(QUERIES[name](spark, SF))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in p, (name, marker)


def test_range_plan_moves_lines_once(clean, monkeypatch):
    monkeypatch.setattr(S, "RANGE_TASK_LINES", 1000)
    cal = calendar_for(clean, "1996-01-01", 134)
    p = plan(S.snapshot_panel_range(clean, cal))
    assert p.count("Exchange") == p.count("Exchange hashpartitioning(customer_id") == 1
    assert p.index("Exchange hashpartitioning(customer_id") > p.index("Generate")  # plans print from the result down
