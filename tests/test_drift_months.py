"""Drift from stored month counts equals the drift report of the panel rows, and reads no panel."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from churnlens.operators.drift import drift_report
from churnlens.plans.drift_months import MonthHistograms, _any_of
from churnlens.schemas import SNAPSHOT_SCHEMA

MONTHS = [datetime(2011, m, 1) for m in range(1, 7)]


def panel(spark, seed=0, months=MONTHS):
    rows = []
    for j, month in enumerate(months):
        for i in range(120):
            x = (i * 37 + j * 11 + seed) % 101
            rate = None if x == 3 else float("inf") if x == 5 else float("nan") if x == 7 else x / 101
            rows.append((str(i), month, x, x % 7, x * 1.25, 1e4 + x / 64, i, x % 13, rate, x % 2 == 0))
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def same(got, want):
    got, want = ({r["feature"]: r.asDict() for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys() and len(got) == 7
    for f in want:
        assert got[f].keys() == want[f].keys()
        for c, v in want[f].items():
            assert (got[f][c] == v) or (isinstance(v, float) and math.isclose(got[f][c], v, rel_tol=1e-9, abs_tol=1e-12)), (f, c)


@pytest.mark.parametrize("base, cur", [(MONTHS[:1], MONTHS[5:]), (MONTHS[:4], MONTHS[4:]), (MONTHS[:2], MONTHS[1:3])])
def test_equals_the_report_of_the_rows(spark, tmp_path, base, cur):
    df = panel(spark)
    store = MonthHistograms(f"{tmp_path}/h")
    store.update(df)
    side = lambda months: df.filter(F.col("snapshot_date").isin(months))
    same(store.report(spark, base, cur), drift_report(side(base), side(cur)))


def test_small_deviations_about_a_large_mean(spark, tmp_path):
    """Against exact fractions: running moments of the rows lose some of these digits, the counts do not."""
    from fractions import Fraction
    df = panel(spark, months=MONTHS[:2]).withColumn("monetary_total", F.lit(1e9) + F.col("monetary_total") / 128)
    store = MonthHistograms(f"{tmp_path}/h")
    store.update(df)
    got = {r["feature"]: r for r in store.report(spark, MONTHS[:1], MONTHS[1:2]).collect()}["monetary_total"]
    for side, month in (("baseline", MONTHS[0]), ("current", MONTHS[1])):
        x = [Fraction(r[0]) for r in df.filter(F.col("snapshot_date") == month).select("monetary_total").collect()]
        mean = sum(x) / len(x)
        assert got[f"std_{side}"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in x) / (len(x) - 1)), rel=1e-11)


def test_changed_and_new_months_only_are_written(spark, tmp_path):
    store = MonthHistograms(f"{tmp_path}/h")
    store.update(panel(spark, months=MONTHS[:4]))
    files = lambda: {f for f in store.table.read(spark).inputFiles()}
    before = files()
    changed = panel(spark, seed=9, months=MONTHS[3:5])
    store.update(changed)
    kept = {f for f in before if "2011-04" not in f}
    assert len(kept) < len(before) and kept < files() and not files() & (before - kept)
    assert sorted(r[0] for r in store.months(spark).collect()) == MONTHS[:5]
    now = panel(spark, months=MONTHS[:3]).unionByName(changed)
    same(store.report(spark, MONTHS[:2], MONTHS[3:5]),
         drift_report(now.filter(F.col("snapshot_date") < MONTHS[2]), now.filter(F.col("snapshot_date") > MONTHS[2])))


def test_repeated_update_missing_months_and_empty_panel(spark, tmp_path):
    df = panel(spark, months=MONTHS[:2])
    store = MonthHistograms(f"{tmp_path}/h")
    store.update(df.limit(0))
    assert store.months(spark).collect() == [] and store.report(spark, MONTHS[:1], MONTHS[1:2]).collect() == []
    for _ in range(2):
        store.update(df.unionByName(df.limit(1).withColumn("snapshot_date", F.lit(None).cast("timestamp_ntz"))))
    same(store.report(spark, MONTHS[:1], [*MONTHS[1:2], datetime(2031, 1, 1)]),
         drift_report(df.filter(F.col("snapshot_date") == MONTHS[0]), df.filter(F.col("snapshot_date") == MONTHS[1])))


def test_the_report_reads_only_the_asked_months_counts(spark, tmp_path):
    store = MonthHistograms(f"{tmp_path}/h")
    store.update(panel(spark))
    kept = store.table.read(spark).filter(_any_of([MONTHS[0]]) | _any_of([MONTHS[5]]))
    scan, = [line for line in kept._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in line]
    assert "PartitionFilters: []" not in scan and "DataFilters: []" in scan
    assert all("month_counts" in f or "psi_edges" in f for f in store.report(spark, MONTHS[:1], MONTHS[5:]).inputFiles())
