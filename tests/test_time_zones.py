"""Naive timestamps stay naive whatever the session time zone is."""

from __future__ import annotations

from datetime import datetime

from churnlens.functions.columns import iso_format, ntz, whole_days_between
from churnlens.operators.features import customer_features


def test_literals_and_features_do_not_depend_on_session_zone(spark, make_clean):
    rows = [("1", "A", 1, "2010-02-28 10:00:00", 1.0, "9"), ("2", "B", 1, "2010-01-31 23:30:00", 1.0, "9")]
    before = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = spark.range(1).select(
                ntz("2001-07-01").alias("a"), iso_format(ntz(datetime(2010, 3, 1, 10, 0, 0, 5))).alias("b"),
                whole_days_between(ntz("2010-02-28 10:00:00"), ntz("2010-03-01")).alias("c")).first()
            f = customer_features(make_clean(rows), "2010-03-01").first()
            got.append((r["a"], r["b"], r["c"], f["recency_days"], f["customer_tenure_days"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == (datetime(2001, 7, 1), "2010-03-01T10:00:00.000005", 0, 0, 28)
    assert got[0] == got[1] == got[2]
