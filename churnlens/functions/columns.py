"""Column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: Python's str.strip() whitespace set beyond Unicode White_Space
# (the four information separators U+001C..U+001F). With (?U), Java's \s is
# Unicode White_Space, which covers the rest.
_LEADING_SPACE_THEN_C = r"(?U)^[\s\x{1C}-\x{1F}]*[cC]"


def ntz(value) -> Column:
    """A timezone-naive timestamp literal from a datetime or ISO string.

    Built from ISO text, so no time zone (the Python process's or the
    session's) takes part in the conversion.
    """
    return F.lit(parse_timestamp(value).isoformat(sep=" ")).cast("timestamp_ntz")


def parse_timestamp(value) -> datetime:
    if isinstance(value, datetime):
        return value
    return datetime.fromisoformat(str(value).strip())


def cancellation_flag(invoice: Column) -> Column:
    """Invoice that, upper-cased and stripped, starts with "C"; null -> False."""
    return F.coalesce(invoice.rlike(_LEADING_SPACE_THEN_C), F.lit(False))


def nan_to_null(c: Column) -> Column:
    """NaN and NULL are one missing value (pandas isna); keep only NULL."""
    return F.when(~F.isnan(c), c)


def canonical_key(c: Column) -> Column:
    """Float customer id -> integral string ("17850.0" -> "17850").

    A fractional id is an error, as in an Int64 cast; it is raised inside
    the plan so no driver pass is needed.
    """
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c != F.floor(c), F.raise_error(F.concat(
                F.lit("customer id is not integral: "), c.cast("string"))))
            .otherwise(c.cast("long").cast("string")))


MONTH_COLUMN = "invoice_month"


def with_month(df: DataFrame) -> DataFrame:
    """Adds the month of ``invoice_date`` as text ("2010-03"), the folder a line is kept in;
    undated lines have none."""
    return df.withColumn(MONTH_COLUMN, F.date_format("invoice_date", "yyyy-MM"))


def up_to_month(df: DataFrame, last: datetime) -> DataFrame:
    """Only folders of months up to that of ``last``, where the table is laid out by month.
    Undated lines are left out: every caller compares dates."""
    if MONTH_COLUMN not in df.columns:
        return df
    return df.filter(F.col(MONTH_COLUMN) <= f"{last:%Y-%m}")


def whole_days_between(start: Column, end: Column) -> Column:
    """Whole elapsed days from ``start`` to ``end`` (floor of the interval).

    Not ``datediff``: 02-28 10:00 to 03-01 00:00 is 0 whole days.
    """
    return F.timestamp_diff("DAY", start, end)


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den as double with IEEE results on a zero denominator.

    ANSI mode raises on division by zero; pandas yields +-inf or NaN.
    """
    n = num.cast("double")
    d = den.cast("double")
    return (F.when(d != 0, n / d)
            .when(n > 0, F.lit(float("inf")))
            .when(n < 0, F.lit(float("-inf")))
            .when(n.isNotNull() & d.isNotNull(), F.lit(float("nan")))
            .otherwise(F.lit(None).cast("double")))


def iso_format(ts: Column) -> Column:
    """ISO-8601 text of a naive timestamp; micros shown only when non-zero."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros))


def round_significant(c: Column, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (0 and NULL kept).

    For float moments whose last bits depend on summation order: scale to
    [1, 10), round, scale back. An exponent off by one at an exact power of
    ten gives the same result, so engines agree.
    """
    x = c.cast("double")
    e = F.floor(F.log10(F.abs(x)))
    p = F.pow(F.lit(10.0), e)
    return F.when(x.isNull() | (x == 0) | F.isnan(x), x).otherwise(F.round(x / p, digits - 1) * p)
