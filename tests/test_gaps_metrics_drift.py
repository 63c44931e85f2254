"""Gaps, favourite product, running totals, PR metrics, drift: vs brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.functions.running import running_totals
from churnlens.operators.drift import drift_report, ks_from, psi_from, value_histogram, ks_statistic, psi
from churnlens.operators.gaps import favourite_product, gap_histogram, gap_percentiles
from churnlens.operators.metrics import pr_curve, pr_summary
from churnlens.operators.split import split_counts, temporal_split
from churnlens.schemas import FEATURE_COLUMNS, SNAPSHOT_SCHEMA


def test_gap_histogram_matches_consecutive_distinct_times(make_clean):
    rows = [("1", "A", 1, "2010-01-01 10:00:00", 1.0, "9"), ("2", "A", 1, "2010-01-01 23:00:00", 1.0, "9"),
            ("2", "B", 1, "2010-01-01 23:00:00", 1.0, "9"),  # same time: one purchase
            ("3", "A", 1, "2010-01-03 09:00:00", 1.0, "9"),  # 1 whole day after 01-01 23:00
            ("C4", "A", 1, "2010-01-20", 1.0, "9"),          # cancellation: ignored
            ("5", "A", 1, "2010-02-03 09:00:00", 1.0, "9"),  # 31 days
            ("6", "A", 1, "2010-01-05", 1.0, "8"), ("7", "A", 1, "2010-01-05", 1.0, "8"),
            ("8", "A", 1, None, 1.0, "8")]
    hist = {r["gap_days"]: r["n_gaps"] for r in gap_histogram(make_clean(rows)).collect()}
    assert hist == {0: 1, 1: 1, 31: 1}
    r = gap_percentiles(gap_histogram(make_clean(rows))).first()
    assert r["n_gaps"] == 3
    assert r["p90_gap_days"] == pytest.approx(np.percentile([0, 1, 31], 90))
    assert r["median_gap_days"] == 1.0


def test_favourite_product_ties_to_smallest_code(make_clean):
    rows = [("1", "B", 1, "2010-01-01", 1.0, "9"), ("2", "A", 1, "2010-01-02", 1.0, "9"),
            ("3", "B", 1, "2010-01-03", 1.0, "8"), ("4", "B", 1, "2010-01-04", 1.0, "8"),
            ("5", "A", 1, "2010-01-05", 1.0, "8"), ("C6", "A", 1, "2010-01-06", 1.0, "8"),
            ("C7", "A", 1, "2010-01-06", 1.0, "8")]
    got = {r["customer_id"]: (r["favourite_stock_code"], r["favourite_lines"])
           for r in favourite_product(make_clean(rows)).collect()}
    assert got == {"9": ("A", 1), "8": ("B", 2)}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_exact(spark, descending):
    rnd = random.Random(7)
    data = [(g, float(v), rnd.randint(0, 5)) for g in ["x", "y"] for v in rnd.sample(range(10000), 700)]
    df = spark.createDataFrame(data, "g string, v double, w long")
    out = running_totals(df, "v", ["w"], group_cols=["g"], descending=descending, levels=4).toPandas()
    pdf = pd.DataFrame(data, columns=["g", "v", "w"]).sort_values(["g", "v"], ascending=[True, not descending])
    pdf["want"] = pdf.groupby("g")["w"].cumsum()
    m = out.merge(pdf, on=["g", "v", "w"])
    assert len(m) == len(pdf) and (m["cum_w"] == m["want"]).all()


def test_pr_curve_and_summary_vs_brute_force(spark):
    rnd = random.Random(3)
    data = [(round(rnd.random(), 2), rnd.random() < 0.3) for _ in range(2000)]
    df = spark.createDataFrame(data, "score double, is_churned boolean")
    curve = pr_curve(df).toPandas().sort_values("score", ascending=False)
    pdf = pd.DataFrame(data, columns=["score", "y"])
    P = pdf["y"].sum()
    ap, best = 0.0, 0.0
    for _, r in curve.iterrows():
        sel = pdf[pdf["score"] >= r["score"]]
        tp = sel["y"].sum()
        assert r["tp"] == tp and r["fp"] == len(sel) - tp
        assert r["precision"] == pytest.approx(tp / len(sel)) and r["recall"] == pytest.approx(tp / P)
        ap += r["pos"] / P * r["precision"]
        if r["precision"] >= 0.3:
            best = max(best, r["recall"])
    s = pr_summary(pr_curve(df), 0.3).first()
    assert s["average_precision"] == pytest.approx(ap) and s["recall_at_precision"] == pytest.approx(best)


def _panel_frame(spark, rows):
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def _rand_panel(spark, seed, shift):
    from datetime import datetime
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        rows.append((str(i), datetime(2010, 1, 1), rnd.randint(0, 300) + shift, rnd.randint(1, 20),
                     round(rnd.random() * 1000, 2), rnd.random() * 50, rnd.randint(0, 900), rnd.randint(1, 30),
                     rnd.random(), rnd.random() < 0.5))
    return _panel_frame(spark, rows)


def test_ks_vs_brute_force(spark):
    a, b = _rand_panel(spark, 1, 0), _rand_panel(spark, 2, 40)
    got = {r["feature"]: r["ks_statistic"] for r in ks_statistic(a, b).collect()}
    pa, pb = a.toPandas(), b.toPandas()
    for c in FEATURE_COLUMNS:
        xa, xb = np.sort(pa[c].astype(float)), np.sort(pb[c].astype(float))
        grid = np.union1d(xa, xb)
        fa = np.searchsorted(xa, grid, side="right") / len(xa)
        fb = np.searchsorted(xb, grid, side="right") / len(xb)
        assert got[c] == pytest.approx(np.max(np.abs(fa - fb))), c


def test_psi_vs_brute_force(spark):
    a, b = _rand_panel(spark, 1, 0), _rand_panel(spark, 2, 40)
    got = {r["feature"]: r["psi"] for r in psi(a, b, 10).collect()}
    pa, pb = a.toPandas(), b.toPandas()
    for c in FEATURE_COLUMNS:
        xa, xb = np.sort(pa[c].astype(float)), pb[c].astype(float).to_numpy()
        n = len(xa)
        edges = sorted({xa[math.ceil(q * n / 10) - 1] for q in range(1, 10)})
        ba = np.searchsorted(edges, xa, side="left")
        bb = np.searchsorted(edges, xb, side="left")
        total = 0.0
        for k in set(ba) | set(bb):
            p1 = max(np.mean(ba == k), 0) or 1e-4
            p2 = max(np.mean(bb == k), 0) or 1e-4
            total += (p2 - p1) * math.log(p2 / p1)
        assert got[c] == pytest.approx(total, abs=1e-8), c


def test_temporal_split_embargo(spark):
    from datetime import datetime
    rows = [(str(i), datetime(2010, m, 1), 1, 1, 1.0, 1.0, 1, 1, 0.0, m % 2 == 0) for i in range(3)
            for m in range(1, 13)]
    sp = temporal_split(_panel_frame(spark, rows), "2010-09-01", 60)
    got = {r["split"]: (r["n_rows"], r["n_snapshots"]) for r in split_counts(sp).collect()}
    # train: T + 60 days <= 09-01 -> T <= 07-03 -> Jan..Jul; embargo: Aug; test: Sep..Dec
    assert got == {"train": (21, 7), "embargo": (3, 1), "test": (12, 4)}


def test_one_rule_for_missing_and_infinite_values(spark):
    base, cur = _rand_panel(spark, 1, 0), _rand_panel(spark, 2, 40)
    odd = cur.withColumn("return_rate", F.when(F.col("customer_id") == "0", float("nan")).when(F.col("customer_id") == "1", float("inf"))
                         .when(F.col("customer_id") == "2", None).otherwise(F.col("return_rate")))
    r = {x["feature"]: x for x in drift_report(base, odd, 10).collect()}["return_rate"]
    assert (r["n_current"], r["n_non_finite_current"]) == (397, 1) and r["null_rate_current"] == pytest.approx(2 / 400)
    rest = cur.filter("customer_id NOT IN ('0', '1', '2')")
    want = {x["feature"]: x for x in drift_report(base, rest, 10).collect()}["return_rate"]
    for c in ("ks_statistic", "psi", "mean_current", "std_current"):
        assert r[c] == pytest.approx(want[c]), c
    assert {x["feature"]: x["psi"] for x in psi(base, odd, 10).collect()}["return_rate"] == r["psi"]


@pytest.mark.parametrize("levels", [2, 6, 9, None])
def test_the_number_of_ranges_does_not_matter(spark, levels):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).cast("double").alias("v"), (F.col("id") % 5).alias("w"))
    got = [r["cum_w"] for r in running_totals(df, "v", ["w"], levels=levels).orderBy("v").collect()]
    w = [r["w"] for r in df.orderBy("v").collect()]
    assert got == [sum(w[: i + 1]) for i in range(len(w))][: len(got)] and len(got) == 3000


def test_each_side_is_read_once_for_ks_and_psi(spark, tmp_path):
    _rand_panel(spark, 1, 0).write.parquet(f"{tmp_path}/b")
    _rand_panel(spark, 2, 9).write.parquet(f"{tmp_path}/c")
    hist = value_histogram(spark.read.parquet(f"{tmp_path}/b"), spark.read.parquet(f"{tmp_path}/c"))
    for df in (ks_from(hist), psi_from(hist, 10)):  # both read the histogram, not the batches
        assert all("value_histogram" in f or "psi_edges" in f for f in df.inputFiles())
