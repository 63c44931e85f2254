"""One customer holding most of the lines: same answers, no special path."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from churnlens.functions.columns import ntz
from churnlens.operators.features import customer_features
from churnlens.operators.gaps import gap_histogram
from churnlens.operators.labels import churn_labels
from churnlens.plans import snapshots as S
from churnlens.plans.calendar import calendar_for


def _rows():
    rnd = random.Random(17)
    start = datetime(2010, 1, 1)
    rows = []
    for i in range(2700):  # the hot customer: 90% of all lines
        ts = start + timedelta(minutes=rnd.randint(0, 60 * 24 * 300))
        inv = f"{'C' if rnd.random() < 0.05 else ''}{1000 + i // 3}"
        rows.append((inv, f"P{rnd.randint(1, 60)}", rnd.randint(-2, 6), ts.isoformat(sep=" "), 1.25, "77"))
        if rnd.random() < 0.1:  # same instant again (same purchase time)
            rows.append((inv, f"P{rnd.randint(1, 60)}", 1, ts.isoformat(sep=" "), 2.5, "77"))
    for c in range(30):
        for k in range(10):
            ts = start + timedelta(days=rnd.randint(0, 300), hours=rnd.randint(0, 23))
            rows.append((f"{9000 + c * 10 + k}", f"P{k}", 1, ts.isoformat(sep=" "), 3.0, f"{500 + c}"))
    return rows


def test_hot_customer_panel_matches_both_references(make_clean):
    clean = make_clean(_rows()).cache()
    cal = calendar_for(clean, "2010-02-01", 45)
    panel = S.snapshot_panel(clean, cal)
    rng = S.snapshot_panel_range(clean, cal)
    assert panel.exceptAll(rng).count() == 0 and rng.exceptAll(panel).count() == 0
    for t in cal.usable()[::3]:
        want = customer_features(clean, t).join(churn_labels(clean, t, 45), "customer_id")
        got = panel.filter(F.col("snapshot_date") == ntz(t)).drop("snapshot_date")
        assert got.exceptAll(want.select(*got.columns)).count() == 0
        assert want.select(*got.columns).exceptAll(got).count() == 0


def test_hot_customer_gaps_match_brute_force(make_clean):
    rows = _rows()
    clean = make_clean(rows)
    got = {r["gap_days"]: r["n_gaps"] for r in gap_histogram(clean).collect()}
    want = {}
    by_customer = {}
    for inv, _, _, ts, _, cust in rows:
        if not inv.upper().strip().startswith("C"):
            by_customer.setdefault(cust, set()).add(datetime.fromisoformat(ts))
    for times in by_customer.values():
        t = sorted(times)
        for a, b in zip(t, t[1:]):
            d = (b - a).days
            want[d] = want.get(d, 0) + 1
    assert got == want
    assert sum(got.values()) == sum(len(t) - 1 for t in by_customer.values())
    assert np.isclose(sum(k * v for k, v in got.items()) / sum(got.values()),
                      np.mean([k for k, v in want.items() for _ in range(v)]))
