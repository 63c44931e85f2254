"""Cleaning rules and validation report."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from churnlens.operators import clean as C
from churnlens.schemas import CLEAN_COLUMNS, FLAG_COLUMNS, RAW_SCHEMA
from pyspark.sql import types as T

D = datetime.fromisoformat
REF = "2012-12-31"


def raw_rows():
    """Own export: (invoice, code, text, quantity, date, price, customer, country)."""
    tea = ("g1", "TEA", "Tea", 3, D("2012-03-03"), 1.25, 61.0, "Chile")
    return [
        tea, tea, tea,                                                              # two copies go
        tea[:3] + (4,) + tea[4:],                                                   # differs in one column: stays
        ("g2", "CUP", "Cup", 1, D("2012-03-04"), 6.0, 62.0, "Peru"),
        (" C3", "CUP", "Cup", -1, D("2012-03-05"), 6.0, 62.0, "Peru"),              # cancelled, quantity below 0
        ("g4", "CUP", "Cup", 0, D("2012-03-06"), 6.0, 62.0, "Peru"),                # quantity 0
        ("g5", "JAR", "Jar", 2, D("2012-03-07"), 0.0, 63.0, "Peru"),                # price 0
        ("g6", "JAR", "Jar", 2, D("2012-03-08"), -0.5, 63.0, "Peru"),               # price below 0
        ("g7", "JAR", None, 2, None, 0.001, 63.0, "Peru"),                          # no date
        ("g8", "JAR", "Jar", 2, D("2013-01-01"), 1.0, 63.0, None),                  # after the reference date
        ("g9", "JAR", "Jar", 2, D("2012-12-31"), 1.0, 63.0, "Peru"),                # on it
        (None, "JAR", "Jar", 2, D("2012-03-09"), 1.0, 63.0, "Peru"),                # no invoice: kept, not cancelled
        ("C10", "JAR", "Jar", -2, None, 0.0, None, "Peru"),                         # no customer: out, in no flag
        ("g11", "JAR", "Jar", 2, D("2012-03-09"), 1.0, float("nan"), "Peru"),       # no customer either
    ]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(raw_rows(), RAW_SCHEMA)


def test_report_counts_and_invariant(raw):
    clean, report = C.validate_and_clean(raw, REF)
    r = report.first().asDict()
    assert (r["source_rows"], r["duplicate_rows_dropped"], r["rows_without_customer_id_excluded"],
            r["clean_transactions_rows"]) == (15, 2, 2, 11)
    assert [r[f] for f in ("is_cancellation", "has_non_positive_quantity", "has_non_positive_price", "has_null_invoice_date",
                           "has_future_invoice_date")] == [1, 2, 2, 1, 1]
    assert r["reference_date_used"] == "2012-12-31T00:00:00"
    assert clean.count() == r["clean_transactions_rows"]


def test_contract_columns_types_and_keys(raw):
    clean, _ = C.validate_and_clean(raw, REF)
    kinds = dict(clean.dtypes)
    assert clean.columns == CLEAN_COLUMNS and kinds["customer_id"] == "string"
    assert all(kinds[f] == "boolean" for f in FLAG_COLUMNS)
    rows = clean.collect()
    assert {r["customer_id"] for r in rows} == {"61", "62", "63"}
    assert all(r[f] is not None for r in rows for f in FLAG_COLUMNS)
    assert sorted(r["quantity"] for r in rows if r["invoice"] == "g1") == [3, 4]
    assert [r["price"] for r in rows if r["invoice"] == "g7"] == [0.001]


def test_a_float_column_keeps_its_type(spark):
    raw = spark.createDataFrame(raw_rows(), RAW_SCHEMA).withColumn("Price", F.col("Price").cast("float"))
    clean, _ = C.validate_and_clean(raw, REF)
    assert dict(clean.dtypes)["price"] == "float"


def test_clock_fallback(spark):
    future = datetime.now() + timedelta(days=3650)
    rows = [("1", "A", 1, future, 1.0, 1.0, "X"), ("2", "A", 1, D("2000-01-01"), 1.0, 1.0, "X")]
    raw = spark.createDataFrame([(r[0], r[1], "d", r[2], r[3], r[4], r[5], r[6]) for r in rows], RAW_SCHEMA)
    _, report = C.validate_and_clean(raw, None)
    r = report.first()
    assert r["has_future_invoice_date"] == 1
    used = datetime.fromisoformat(r["reference_date_used"])
    assert abs((used - datetime.now()).total_seconds()) < 600


def test_padded_lowercase_cancellation(spark):
    rows = [("\tc1", "A", "d", 1, D("2000-01-01"), 1.0, 1.0, "X"),
            (" C2", "A", "d", 1, D("2000-01-01"), 1.0, 1.0, "X"),
            ("3C", "A", "d", 1, D("2000-01-01"), 1.0, 1.0, "X"),
            (None, "A", "d", 1, D("2000-01-01"), 1.0, 1.0, "X")]
    clean, _ = C.validate_and_clean(spark.createDataFrame(rows, RAW_SCHEMA), "2001-01-01")
    got = {r["invoice"]: r["is_cancellation"] for r in clean.collect()}
    assert got == {"\tc1": True, " C2": True, "3C": False, None: False}


def test_fractional_customer_id_raises(spark):
    rows = [("1", "A", "d", 1, D("2000-01-01"), 1.0, 17850.5, "X")]
    clean, _ = C.validate_and_clean(spark.createDataFrame(rows, RAW_SCHEMA), "2001-01-01")
    with pytest.raises(Exception, match="not integral"):
        clean.collect()


def test_nan_and_null_customer_are_one_missing_value(spark):
    rows = [("1", "A", "d", 1, D("2000-01-01"), 1.0, float("nan"), "X"),
            ("1", "A", "d", 1, D("2000-01-01"), 1.0, None, "X"),
            ("2", "A", "d", 1, D("2000-01-01"), 1.0, 5.0, "X")]
    _, report = C.validate_and_clean(spark.createDataFrame(rows, RAW_SCHEMA), "2001-01-01")
    r = report.first()
    assert (r["source_rows"], r["duplicate_rows_dropped"], r["rows_without_customer_id_excluded"],
            r["clean_transactions_rows"]) == (3, 1, 1, 1)


def test_unknown_columns_kept_and_missing_contract_column_fails(spark):
    rows = [("1", "A", "d", 1, D("2000-01-01"), 1.0, 5.0, "X", "extra")]
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField("Extra", T.StringType())])
    clean, _ = C.validate_and_clean(spark.createDataFrame(rows, schema), "2001-01-01")
    assert "Extra" in clean.columns
    with pytest.raises(KeyError):
        C.validate_and_clean(spark.createDataFrame(rows, schema).drop("Quantity"), "2001-01-01")
