"""Plain Python forms of the feature and label rules, and random lines to try them on.

A line is (invoice, stock code, quantity, date text, price, customer)."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta


def when(text):
    return None if text is None else datetime.fromisoformat(text)


def is_cancelled(invoice):
    return (invoice or "").strip().upper().startswith("C")


def some_lines(seed, n=120, customers=7, first="2012-01-03", days=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        day = when(first) + timedelta(days=rng.randrange(days), hours=rng.choice((0, 0, 9, 23)))
        number = f"{rng.choice(('', '', '', 'C', ' c'))}{4000 + rng.randrange(n // 2)}"
        out.append((None if rng.random() < 0.03 else number, rng.choice("STUVWXYZ"), rng.choice((-4, -1, 1, 2, 3, 12)),
                    None if rng.random() < 0.03 else str(day), rng.choice((0.0, 0.25, 1.5, 8.0)), str(61 + rng.randrange(customers))))
    return out


def features(lines, as_of):
    at = when(as_of)
    mine = defaultdict(list)
    for line in lines:
        if when(line[3]) is not None and when(line[3]) < at:
            mine[line[5]].append(line)
    out = {}
    for customer, rows in mine.items():
        real = [r for r in rows if not is_cancelled(r[0])]
        if not real:
            continue
        invoices = {r[0] for r in real if r[0] is not None}
        total = sum(r[2] * r[4] for r in rows)
        ratio = lambda a, b: a / b if b else float("inf") if a > 0 else float("-inf") if a < 0 else float("nan")
        out[customer] = {
            "recency_days": (at - max(when(r[3]) for r in real)).days, "frequency": len(invoices), "monetary_total": total,
            "monetary_avg_order": ratio(total, len(invoices)), "customer_tenure_days": (at - min(when(r[3]) for r in real)).days,
            "n_distinct_products": len({r[1] for r in real}), "return_rate": sum(r[2] <= 0 for r in rows) / len(rows)}
    return out


def churned(lines, as_of, n):
    at = when(as_of)
    back = {r[5] for r in lines if not is_cancelled(r[0]) and when(r[3]) is not None and at < when(r[3]) <= at + timedelta(days=n)}
    return {c: c not in back for c in features(lines, as_of)}
