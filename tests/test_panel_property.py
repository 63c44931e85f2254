"""Property: the bucketed panel equals the range-join panel on random data.

Dates are drawn around snapshot instants (exactly on, one second either
side, times of day) where the feature side (strict <) and the label side
((T, T+N]) disagree, with cancellations, returns, null invoices and dates.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlens.plans import snapshots as S
from churnlens.plans.calendar import calendar_for

BASE_DATES = [datetime(2010, m, 1) for m in range(1, 9)] + [datetime(2010, 3, 15, 10, 30)]
OFFSETS = [timedelta(0), timedelta(seconds=1), timedelta(seconds=-1), timedelta(hours=13),
           timedelta(days=10), timedelta(days=-20), timedelta(days=30), timedelta(days=29, hours=23)]

line = st.tuples(
    st.sampled_from(["1", "2", "3", "C4", " c5", None]),                     # invoice
    st.sampled_from(["A", "B", "C", None]),                                 # stock code
    st.integers(min_value=-3, max_value=5),                                 # quantity
    st.one_of(st.none(), st.tuples(st.sampled_from(BASE_DATES), st.sampled_from(OFFSETS))),
    st.sampled_from([0.0, 1.5, 2.25]),                                      # price
    st.sampled_from(["7001", "7002", "7003"]),                              # customer
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(line, min_size=1, max_size=40),
       start=st.sampled_from(["2010-01-01", "2010-02-01 00:00:01", "2010-01-20"]),
       n=st.sampled_from([10, 29, 31]))
def test_bucketed_equals_range(make_clean, rows, start, n):
    data = []
    for inv, code, q, d, price, cust in rows:
        ts = None if d is None else (d[0] + d[1]).isoformat(sep=" ")
        data.append((inv, code, q, ts, price, cust))
    clean = make_clean(data)
    if all(r[3] is None for r in data):
        return
    cal = calendar_for(clean, start, n)
    a, b = S.snapshot_panel(clean, cal), S.snapshot_panel_range(clean, cal)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
