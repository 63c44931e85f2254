"""Declared schemas of the four tables (raw, clean, panel, predictions)."""

from __future__ import annotations

from pyspark.sql import types as T

# The column, flag and report field names below are the output contract.
RAW_COLUMNS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
               "Customer ID", "Country"]

RAW_SCHEMA = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", T.DoubleType()),  # as in the source: any number of digits
    T.StructField("Customer ID", T.DoubleType()),
    T.StructField("Country", T.StringType()),
])

FLAG_COLUMNS = [
    "is_cancellation",
    "has_non_positive_quantity",
    "has_non_positive_price",
    "has_null_invoice_date",
    "has_future_invoice_date",
]

CLEAN_COLUMNS = ["invoice", "stock_code", "description", "quantity", "invoice_date", "price",
                 "customer_id", "country", *FLAG_COLUMNS]

FEATURE_COLUMNS = [
    "recency_days",
    "frequency",
    "monetary_total",
    "monetary_avg_order",
    "customer_tenure_days",
    "n_distinct_products",
    "return_rate",
]

CLEAN_SCHEMA = T.StructType([
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
    *[T.StructField(f, T.BooleanType()) for f in FLAG_COLUMNS],
])

SNAPSHOT_COLUMNS = ["customer_id", "snapshot_date", *FEATURE_COLUMNS, "is_churned"]

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("snapshot_date", T.TimestampNTZType()),
    T.StructField("recency_days", T.LongType()),
    T.StructField("frequency", T.LongType()),
    T.StructField("monetary_total", T.DoubleType()),
    T.StructField("monetary_avg_order", T.DoubleType()),
    T.StructField("customer_tenure_days", T.LongType()),
    T.StructField("n_distinct_products", T.LongType()),
    T.StructField("return_rate", T.DoubleType()),
    T.StructField("is_churned", T.BooleanType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("as_of_date", T.TimestampNTZType()),
    T.StructField("churn_probability", T.DoubleType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("scored_at", T.TimestampNTZType()),
])

VALIDATION_REPORT_SCHEMA = T.StructType([
    T.StructField("source_rows", T.LongType()),
    T.StructField("duplicate_rows_dropped", T.LongType()),
    T.StructField("rows_without_customer_id_excluded", T.LongType()),
    T.StructField("clean_transactions_rows", T.LongType()),
    T.StructField("reference_date_used", T.StringType()),
    T.StructField("flags", T.StructType([T.StructField(f, T.LongType()) for f in FLAG_COLUMNS])),
])

PER_SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("snapshot_date", T.StringType()),
    T.StructField("n_customers", T.LongType()),
    T.StructField("n_churned", T.LongType()),
    T.StructField("churn_rate", T.DoubleType()),
])

PANEL_REPORT_SCHEMA = T.StructType([
    T.StructField("threshold_days", T.LongType()),
    T.StructField("max_invoice_date_observed", T.StringType()),
    T.StructField("last_labelable_cutoff", T.StringType()),
    T.StructField("snapshot_start_date", T.StringType()),
    T.StructField("candidate_snapshot_dates", T.LongType()),
    T.StructField("usable_snapshot_dates", T.LongType()),
    T.StructField("rows_total", T.LongType()),
    T.StructField("churn_rate_overall", T.DoubleType()),
    T.StructField("per_snapshot", T.ArrayType(PER_SNAPSHOT_SCHEMA)),
])


def require_columns(df, columns, what: str) -> None:
    """Fail early, with the missing names, when a contract column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{what}: missing required columns {missing}; got {df.columns}")
