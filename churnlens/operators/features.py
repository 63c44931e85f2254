"""Point-in-time customer features.

One implementation of the feature maths: ``feature_partials`` says what
is aggregated over the lines strictly before a date, ``finish_features``
turns those aggregates into the seven features. The one-date path below
and the snapshot panel (plans.snapshots) both end in ``finish_features``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.window import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions.columns import guarded_ratio, ntz, parse_timestamp, up_to_month, whole_days_between
from churnlens.schemas import FEATURE_COLUMNS, require_columns

NEEDED = ["customer_id", "invoice", "stock_code", "quantity", "invoice_date", "price",
          "is_cancellation", "has_non_positive_quantity"]


def is_real() -> Column:
    """A "real" line: anything that is not a cancellation (returns count)."""
    return ~F.col("is_cancellation")


class Money:
    """How line values (quantity * price) are summed.

    A decimal price (scale s, unscaled value fitting a long) is summed as
    integer minor units in bigint -- exact, order-independent and on the
    fast long path instead of 38-digit decimal arithmetic -- and turned into
    a double once, at the end: the same correctly rounded double as the
    exact decimal sum. A product or total beyond a long raises, whatever the
    session's ANSI setting. Any other price type is summed as its plain product.
    """

    def __init__(self, df: DataFrame):
        t = df.schema["price"].dataType
        self.scale = t.scale if isinstance(t, T.DecimalType) and t.precision <= 18 and t.scale <= 6 else None

    def line_value(self) -> Column:
        quantity, price = F.col("quantity"), F.col("price")
        if self.scale is None:
            return quantity * price
        units = (price * F.lit(10 ** self.scale)).cast("bigint")  # exact: scale digits only
        product = F.try_multiply(quantity.cast("bigint"), units)
        return F.when(quantity.isNull() | price.isNull(), F.lit(None)).otherwise(
            F.coalesce(product, F.raise_error(F.lit("line value beyond a long")).cast("bigint")))

    def total(self, value: Column, over: WindowSpec | None = None) -> Column:
        """Sum of line values or of partial sums, as an aggregate or over a window."""
        total, n = (F.sum(value), None) if self.scale is None else (F.try_sum(value), F.count(value))
        if over is not None:
            total, n = total.over(over), None if n is None else n.over(over)
        if n is None:
            return total
        return F.when(n > 0, F.coalesce(total, F.raise_error(F.lit("sum of line values beyond a long")).cast("bigint")))

    def to_double(self, total: Column) -> Column:
        if self.scale is None:
            return total.cast("double")
        return total.cast("double") / F.lit(float(10 ** self.scale))


def finish_features(df: DataFrame, as_of: Column, money: Money | None = None) -> DataFrame:
    """Aggregates -> features. Expects the columns
    last_real_ts, first_real_ts, n_invoices, n_products, value_sum, n_lines, n_nonpos.
    ``value_sum`` is in the units of ``money`` (plain value when None).
    """
    total = F.col("value_sum")
    total = F.coalesce(money.to_double(total) if money else total.cast("double"), F.lit(0.0))
    return df.withColumns({
        "recency_days": whole_days_between(F.col("last_real_ts"), as_of),
        "frequency": F.col("n_invoices").cast("bigint"),
        "monetary_total": total,
        "monetary_avg_order": guarded_ratio(total, F.col("n_invoices")),
        "customer_tenure_days": whole_days_between(F.col("first_real_ts"), as_of),
        "n_distinct_products": F.col("n_products").cast("bigint"),
        "return_rate": guarded_ratio(F.col("n_nonpos"), F.col("n_lines")),
    })


def customer_features(clean: DataFrame, as_of_date) -> DataFrame:
    """Features for every customer with a real purchase before the date.

    Lines strictly before ``as_of_date`` only (the filter reaches the
    Parquet scan, and skips later months of a table laid out by month).
    Distinct invoices and products are counted in two steps, on (customer,
    key) pairs, so no line is expanded and a hot customer spreads; the
    joins are of one row per customer.
    """
    require_columns(clean, NEEDED, "clean transactions")
    as_of = ntz(as_of_date)
    real = is_real()
    money = Money(clean)
    before = up_to_month(clean, parse_timestamp(as_of_date)).filter(F.col("invoice_date") < as_of)
    lines = before.select("customer_id", "invoice", "stock_code", "invoice_date", real.alias("real"),
                          money.line_value().alias("value"), "has_non_positive_quantity")
    real = F.col("real")
    sums = lines.groupBy("customer_id").agg(
        F.count_if(real).alias("n_real"),
        F.max(F.when(real, F.col("invoice_date"))).alias("last_real_ts"),
        F.min(F.when(real, F.col("invoice_date"))).alias("first_real_ts"),
        money.total(F.col("value")).alias("value_sum"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("has_non_positive_quantity")).alias("n_nonpos"))

    def distinct(key: str, out: str) -> DataFrame:
        pairs = lines.filter(real & F.col(key).isNotNull()).groupBy("customer_id", key).agg(F.lit(1).alias("_one"))
        return pairs.groupBy("customer_id").agg(F.count("_one").alias(out))

    agg = (sums.filter(F.col("n_real") > 0).join(distinct("invoice", "n_invoices"), "customer_id", "left")
           .join(distinct("stock_code", "n_products"), "customer_id", "left")
           .fillna(0, ["n_invoices", "n_products"]))
    return finish_features(agg, as_of, money).select("customer_id", *FEATURE_COLUMNS)


def single_customer_features(clean: DataFrame, customer_id: str | Column | DataFrame,
                             as_of_date) -> DataFrame:
    """The same function on one customer's rows.

    ``customer_id`` may be a literal id or a one-column frame of ids (kept
    with a semi join, so the id can be derived by Spark from the data).
    """
    if isinstance(customer_id, DataFrame):
        rows = clean.join(customer_id.select("customer_id"), "customer_id", "left_semi")
    else:
        rows = clean.filter(F.col("customer_id") == customer_id)
    return customer_features(rows, as_of_date)
