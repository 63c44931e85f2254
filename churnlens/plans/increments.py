"""The snapshot panel kept up to date by increments.

What the panel is made of is kept as a table: per customer and month bucket the sums, counts and times of its lines, and for each
(customer, invoice) and (customer, stock code) the first bucket it was met in. All of it merges (sums, minima, maxima), so
an increment only appends what its own lines say; the lines themselves are not read again. The panel's months that the new lines can
change are then written anew, from the first snapshot whose label window holds the earliest of them; folders of
earlier months are not touched. Late lines are lines like others, they only reach further back.
"""

from __future__ import annotations

import logging
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.columns import ntz, parse_timestamp
from churnlens.operators.features import Money, is_real
from churnlens.plans.calendar import Calendar, calendar_for, first_month_start
from churnlens.plans.snapshots import panel_of_partials
from churnlens.schemas import SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA
from churnlens.session import materialize
from churnlens.sources.tables import TableTarget, hadoop_path

log = logging.getLogger(__name__)

_STATE = ["n_real", "value_sum", "n_lines", "n_nonpos", "max_real", "min_real", "min_real_strict", "first_ts", "last_ts"]


class PanelStore:
    """A panel under ``path`` (``state`` and ``panel``), for snapshots on the first of each month from ``start`` on and a label window
    of ``threshold_days``. Increments are distinct clean lines that the store has not had; they must not run at the same time.

    The state of an increment is one batch, noted in its folder name: an increment that died half-way and is
    given again under the same ``batch`` replaces what it had left, so nothing counts twice.
    """

    def __init__(self, path: str, start, threshold_days: int):
        self.path, self.start, self.threshold_days = path.rstrip("/"), start, int(threshold_days)

    def update(self, lines: DataFrame, batch: str) -> dict:
        """Take in an increment; returns the calendar, and the first month written (None without new dated lines)."""
        spark = lines.sparkSession
        money = Money(lines)
        state = materialize(self._state_of(lines, money), "increment")
        span = state.filter("kind = 'lines'").agg(F.min("first_ts").alias("first")).first()
        before = self._state(spark)
        if before is not None and before.schema["value_sum"].dataType != state.schema["value_sum"].dataType:
            raise ValueError("the price of these lines is of another type than that of the lines before")
        earlier = None if before is None else before.filter((F.col("batch") != batch) & (F.col("kind") == "lines"))
        known = None if earlier is None or earlier.isEmpty() else self._calendar(earlier)
        state.write.mode("overwrite").parquet(f"{self.path}/state/batch={batch}")
        if span["first"] is None:
            return {"calendar": known, "written_from": None}
        merged = self._state(spark)
        cal = self._calendar(merged)
        # a line counts in the label of snapshots up to N days before it; the calendar may also reach further now
        least = span["first"] - timedelta(days=self.threshold_days)
        least = min(least, known.last_usable) if known is not None and known.n_usable else cal.first
        panel = panel_of_partials(self._partials(merged, cal), cal, money) if cal.n_usable else spark.createDataFrame([], SNAPSHOT_SCHEMA)
        panel = panel.filter(F.col("snapshot_date") >= ntz(least)).hint("rebalance", "snapshot_date")  # a large month goes to several tasks
        writer = panel.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date")
        writer.parquet(f"{self.path}/panel")
        log.info("batch %s: months from %s on are written.", batch, least)
        return {"calendar": cal, "written_from": least}

    def panel(self, spark: SparkSession) -> DataFrame:
        return TableTarget(f"{self.path}/panel", schema=SNAPSHOT_SCHEMA).read(spark).select(SNAPSHOT_COLUMNS)

    def _state(self, spark: SparkSession) -> DataFrame | None:
        fs, root = hadoop_path(spark, f"{self.path}/state")
        return spark.read.option("basePath", f"{self.path}/state").parquet(f"{self.path}/state") if fs.exists(root) else None

    def _calendar(self, state: DataFrame) -> Calendar:
        """The calendar of all lines so far, from the latest time that the state has met."""
        return calendar_for(state.filter("kind = 'lines'").select(F.col("last_ts").alias("invoice_date")), self.start, self.threshold_days)

    def _bucket(self):
        """g = number of snapshots, of a calendar without end, at or before a line; whether it stands exactly on the last of them."""
        first = first_month_start(parse_timestamp(self.start))
        ts = F.col("invoice_date")
        idx = (F.year(ts) - first.year) * 12 + (F.month(ts) - first.month)
        month_start = ntz(first) + F.make_ym_interval(F.lit(0), idx.cast("int"))
        g = F.when(ts < ntz(first), F.lit(0)).when(ts < month_start, idx).otherwise(idx + 1)
        return g.cast("int"), (ts == month_start) & (idx >= 0)

    def _state_of(self, lines: DataFrame, money: Money) -> DataFrame:
        ts, real = F.col("invoice_date"), is_real()
        g, on_boundary = self._bucket()
        dated = lines.filter(ts.isNotNull()).withColumns({"g": g, "_edge": on_boundary, "_real": real, "_value": money.line_value()})
        real = F.col("_real")
        sums = dated.groupBy("customer_id", "g").agg(
            F.count_if(real).alias("n_real"), money.total(F.col("_value")).alias("value_sum"), F.count(F.lit(1)).alias("n_lines"),
            F.count_if("has_non_positive_quantity").alias("n_nonpos"), F.max(F.when(real, ts)).alias("max_real"),
            F.min(F.when(real, ts)).alias("min_real"), F.min(F.when(real & ~F.col("_edge"), ts)).alias("min_real_strict"),
            F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")).withColumn("kind", F.lit("lines"))

        def first_seen(key: str) -> DataFrame:
            return (dated.filter(real & F.col(key).isNotNull()).groupBy("customer_id", F.col(key).cast("string").alias("key"))
                    .agg(F.min("g").alias("g")).withColumn("kind", F.lit(key)))

        out = sums
        for key in ("invoice", "stock_code"):
            out = out.unionByName(first_seen(key), allowMissingColumns=True)
        return out.select("kind", "customer_id", "key", "g", *_STATE)

    def _partials(self, state: DataFrame, cal: Calendar) -> DataFrame:
        """The state merged into what the panel's last step reads, its buckets cut at the calendar's end."""
        k = F.lit(cal.n_usable)
        capped = F.least("g", k).alias("g")
        # beyond the last snapshot a line on a month's first instant is no longer on an edge
        strict = F.when(F.col("g") > k, F.col("min_real")).otherwise(F.col("min_real_strict"))
        sums = state.filter("kind = 'lines'").withColumn("min_real_strict", strict)
        total = F.try_sum("value_sum") if dict(state.dtypes)["value_sum"] == "bigint" else F.sum("value_sum")
        held = F.when(F.count("value_sum") > 0, F.coalesce(total, F.raise_error(F.lit("sum of line values beyond a long")).cast(
            state.schema["value_sum"].dataType)))
        held = held.alias("value_sum")
        firsts = state.filter("kind <> 'lines'").groupBy("kind", "customer_id", "key").agg(F.min("g").alias("g"))
        one = lambda kind, out: F.when(F.col("kind") == kind, F.lit(1)).cast("bigint").alias(out)
        firsts = firsts.select("customer_id", "g", one("invoice", "n_new_invoices"), one("stock_code", "n_new_products"))
        # each pair's bucket holds lines of its customer, so the pairs add no bucket
        return sums.unionByName(firsts, allowMissingColumns=True).groupBy("customer_id", capped).agg(
            F.sum("n_real").alias("n_real"), held, F.sum("n_lines").alias("n_lines"), F.sum("n_nonpos").alias("n_nonpos"),
            F.max("max_real").alias("max_real"), F.min("min_real").alias("min_real"), F.min("min_real_strict").alias("min_real_strict"),
            F.sum("n_new_invoices").alias("n_new_invoices"), F.sum("n_new_products").alias("n_new_products"))
