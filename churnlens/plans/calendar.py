"""Snapshot calendar (U15): month starts from the start date to the data's end.

Candidates are the first day of each month, rolled forward from the
start date (a mid-month start gives the next month start; the time of
day is kept), up to and including the latest invoice date. Usable
candidates are those on or before ``max - threshold_days``, so every
usable snapshot has a complete label window. The calendar holds one
entry per month, so it is tiny whatever the data size.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions.columns import parse_timestamp

log = logging.getLogger(__name__)


def add_months(ts: datetime, months: int) -> datetime:
    """Month arithmetic on a first-of-month timestamp (no day clamping needed)."""
    total = ts.year * 12 + (ts.month - 1) + months
    return ts.replace(year=total // 12, month=total % 12 + 1)


def first_month_start(start: datetime) -> datetime:
    if start.day == 1:
        return start
    return add_months(start.replace(day=1), 1)


@dataclass(frozen=True)
class Calendar:
    start: datetime
    first: datetime
    max_invoice_date: datetime
    cutoff: datetime
    threshold_days: int
    n_candidates: int
    n_usable: int

    def candidate(self, j: int) -> datetime:
        return add_months(self.first, j)

    def candidates(self) -> list[datetime]:
        return [self.candidate(j) for j in range(self.n_candidates)]

    def usable(self) -> list[datetime]:
        return [self.candidate(j) for j in range(self.n_usable)]

    @property
    def last_usable(self) -> datetime | None:
        return self.candidate(self.n_usable - 1) if self.n_usable else None


def make_calendar(start_date, max_invoice_date: datetime | None, threshold_days: int) -> Calendar:
    if max_invoice_date is None:
        raise ValueError("no invoice date in the clean transactions: cannot build a snapshot calendar")
    start = parse_timestamp(start_date)
    first = first_month_start(start)
    cutoff = max_invoice_date - timedelta(days=int(threshold_days))
    n_cand = 0
    while add_months(first, n_cand) <= max_invoice_date:
        n_cand += 1
    n_usable = 0
    while n_usable < n_cand and add_months(first, n_usable) <= cutoff:
        n_usable += 1
    cal = Calendar(start, first, max_invoice_date, cutoff, int(threshold_days), n_cand, n_usable)
    log.info("Snapshot calendar: %d candidate dates, %d usable (cutoff %s).",
             n_cand, n_usable, cutoff.isoformat())
    return cal


def max_invoice_date(clean: DataFrame) -> datetime | None:
    """Global latest invoice date over all clean rows (one small aggregate)."""
    return clean.agg(F.max("invoice_date").alias("m")).first()["m"]


def calendar_for(clean: DataFrame, start_date, threshold_days: int) -> Calendar:
    return make_calendar(start_date, max_invoice_date(clean), threshold_days)


def calendar_frame(spark: SparkSession, cal: Calendar, usable_only: bool = False) -> DataFrame:
    """(snapshot_index, snapshot_date, is_usable); one row per month."""
    n = cal.n_usable if usable_only else cal.n_candidates
    rows = [(j, cal.candidate(j), j < cal.n_usable) for j in range(n)]
    schema = T.StructType([
        T.StructField("snapshot_index", T.IntegerType(), False),
        T.StructField("snapshot_date", T.TimestampNTZType(), False),
        T.StructField("is_usable", T.BooleanType(), False),
    ])
    return spark.createDataFrame(rows, schema)
