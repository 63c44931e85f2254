"""Point-in-time features at one date."""

from __future__ import annotations

import math

import pytest

from churnlens.operators.features import Money, customer_features, single_customer_features
from churnlens.schemas import FEATURE_COLUMNS
from tests import plain

AS_OF = "2012-08-01"


def as_dict(df):
    return {r["customer_id"]: {k: v for k, v in r.asDict().items() if k != "customer_id"} for r in df.collect()}


@pytest.mark.parametrize("seed", [3, 4, 5])
@pytest.mark.parametrize("as_of", [AS_OF, "2012-05-20 09:00:00"])
def test_equals_the_plain_rule(make_clean, seed, as_of):
    lines = plain.some_lines(seed)
    got, want = as_dict(customer_features(make_clean(lines), as_of)), plain.features(lines, as_of)
    assert set(got) == set(want)
    for customer, row in want.items():
        assert got[customer] == pytest.approx(row, nan_ok=True), customer


def test_who_has_features(make_clean):
    lines = [("7", "S", 1, "2012-08-01", 1.0, "71"),               # on the date itself: too late
             ("8", "S", 1, "2012-07-31 23:59:59", 1.0, "72"),      # the second before
             (" c9", "S", 1, "2012-07-01", 1.0, "73"),             # cancelled
             ("10", "S", 1, None, 1.0, "74")]                      # undated
    assert set(as_dict(customer_features(make_clean(lines), AS_OF))) == {"72"}


def test_single_customer_equals_batch(make_clean):
    clean = make_clean(plain.some_lines(6))
    batch = as_dict(customer_features(clean, AS_OF))
    for customer in sorted(batch)[:3]:
        assert as_dict(single_customer_features(clean, customer, AS_OF)) == {customer: batch[customer]}


def test_columns_and_key_type(make_clean):
    df = customer_features(make_clean(plain.some_lines(7)), AS_OF)
    assert df.columns == ["customer_id", *FEATURE_COLUMNS]
    assert dict(df.dtypes)["customer_id"] == "string"


def test_elapsed_days_are_whole_days(make_clean):
    r = customer_features(make_clean([("7", "S", 1, "2012-07-30 00:00:01", 1.0, "71")]), AS_OF).first()
    assert r["recency_days"] == r["customer_tenure_days"] == 1


def test_lines_without_invoice_give_frequency_zero(make_clean):
    r = customer_features(make_clean([(None, "S", 3, "2012-05-05", 2.5, "71")]), AS_OF).first()
    assert r["frequency"] == 0 and r["monetary_total"] == 7.5 and math.isinf(r["monetary_avg_order"])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_sum_beyond_a_long_raises_whatever_the_session_says(spark, ansi):
    lines = spark.sql("SELECT id AS customer_id, CAST(quantity AS BIGINT) AS quantity, CAST(price AS DECIMAL(18, 6)) AS price "
                      "FROM VALUES (1, 9000000, 900000.5), (1, 9000000, 900000.5), (2, 3, 0.000001) AS t(id, quantity, price)")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        money = Money(lines)
        total = lambda df: df.agg(money.to_double(money.total(money.line_value())).alias("t")).first()["t"]
        assert total(lines.filter("customer_id = 2")) == 0.000003
        assert total(lines.filter("customer_id = 1").limit(1)) == 9000000 * 900000.5
        with pytest.raises(Exception, match="beyond a long"):
            total(lines)
        assert total(lines.limit(0)) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
