"""Churn label at one date: who counts, and the edges of the window (T, T + N]."""

from __future__ import annotations

import pytest

from churnlens.operators.features import customer_features
from churnlens.operators.labels import churn_labels
from tests import plain

T, N = "2012-04-01", 45
EDGES = [
    ("r1", "S", 1, "2012-01-09", 2.0, "61"), ("r2", "S", 1, "2012-05-16", 2.0, "61"),               # on T + 45
    ("r3", "S", 1, "2012-01-09", 2.0, "62"), ("r4", "S", 1, "2012-05-16 00:00:01", 2.0, "62"),      # a second late
    ("r5", "S", 1, "2012-03-31 23:59:59", 2.0, "63"), ("r6", "S", 1, "2012-04-01", 2.0, "63"),      # on T itself
    ("r7", "S", 4, "2012-02-02", 2.0, "64"), ("r8", "S", -4, "2012-04-02", 2.0, "64"),              # a return is a purchase line
    ("r9", "S", 4, "2012-02-02", 2.0, "65"), ("c10", "S", -4, "2012-04-02", 2.0, "65"),             # a cancellation is not
    ("r11", "S", 1, "2012-04-20", 2.0, "66"),                                                        # first seen after T
    ("C12", "S", -1, "2012-03-01", 2.0, "67"), ("r13", "S", 1, "2012-04-20", 2.0, "67"),             # only cancelled before T
]


def labels(df):
    return {r["customer_id"]: r["is_churned"] for r in df.collect()}


def test_edges_of_the_window(make_clean):
    assert labels(churn_labels(make_clean(EDGES), T, N)) == {"61": False, "62": True, "63": True, "64": False, "65": True}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_plain_rule_and_the_feature_population(make_clean, seed):
    lines = plain.some_lines(seed)
    clean = make_clean(lines)
    got = labels(churn_labels(clean, "2012-09-15 08:30:00", N))
    assert got == plain.churned(lines, "2012-09-15 08:30:00", N)
    assert set(got) == {r["customer_id"] for r in customer_features(clean, "2012-09-15 08:30:00").collect()}
