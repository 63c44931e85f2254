"""The panel kept up to date by increments equals the panel of all lines, and leaves other months alone."""

from __future__ import annotations

import os
import random
import tempfile

import pytest

from churnlens.plans.increments import PanelStore
from churnlens.plans.snapshots import build_customer_snapshots

START, DAYS = "2010-01-15", 60


def lines(rng: random.Random, n: int, months: range):
    out = []
    for _ in range(n):
        m = rng.choice(months)
        day = rng.choice((1, 1, rng.randint(1, 28)))
        clock = "00:00:00" if rng.random() < 0.4 else f"{rng.randint(0, 23):02d}:30:00"
        cancelled = rng.random() < 0.15
        out.append((f"{'C' if cancelled else ''}{rng.randint(100, 130)}", f"s{rng.randint(1, 9)}", rng.choice((-1, 1, 3)),
                    f"{2010 + m // 12}-{m % 12 + 1:02d}-{day:02d} {clock}", rng.choice((0.5, 2.0, 3.25)), rng.randint(1, 12)))
    return out


def rows(panel):
    return sorted(map(tuple, panel.collect()), key=repr)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_equal_a_full_rebuild(spark, make_clean, seed):
    rng = random.Random(seed)
    batches = [lines(rng, 120, range(0, 8)), lines(rng, 60, range(7, 11)), lines(rng, 15, range(2, 12))]  # the last one holds late lines
    path = tempfile.mkdtemp(prefix="store-")
    store = PanelStore(path, START, DAYS)
    seen: list = []
    for i, batch in enumerate(batches):
        before, seen = files(f"{path}/panel"), seen + batch
        report = store.update(make_clean(batch), f"b{i}")
        full, _, cal = build_customer_snapshots(make_clean(seen), START, DAYS)
        assert rows(store.panel(spark)) == rows(full) and report["calendar"].usable() == cal.usable()
        after = files(f"{path}/panel")
        untouched = [f for f in before if f"{report['written_from']:%Y-%m-%d}" > f.split("snapshot_date=")[1][:10]]
        assert all(after.get(f) == before[f] for f in untouched)
        if i == 1:
            assert untouched
    # the same batch again, as after a job that died, counts nothing twice
    store.update(make_clean(batches[2]), "b2")
    assert rows(store.panel(spark)) == rows(full)


def test_first_batch_again_undated_lines_and_an_early_end(spark, make_clean):
    path = tempfile.mkdtemp(prefix="store-")
    store = PanelStore(path, START, DAYS)
    short = [("1", "a", 1, "2010-01-20 00:00:00", 1.0, 1)]
    assert store.update(make_clean(short), "b0")["calendar"].n_usable == 0 and store.panel(spark).collect() == []
    more = [("2", "a", 1, "2010-06-01 00:00:00", 1.0, 2), ("3", "b", 2, None, 1.0, 1)]
    store.update(make_clean(more), "b1")
    store.update(make_clean(more), "b1")
    assert store.update(make_clean([("4", "b", 2, None, 1.0, 1)]), "b2")["written_from"] is None
    assert rows(store.panel(spark)) == rows(build_customer_snapshots(make_clean(short + more), START, DAYS)[0])
