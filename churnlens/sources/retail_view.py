"""Raw transaction log derived from the generated star-schema tables.

Maps lineitem x orders x part x customer x nation onto the source schema
of a retail transaction export (Invoice, StockCode, ..., Customer ID,
Country) and plants the defects the cleaning rules exist for: cancellation
prefixes (with case and padding variants), negative quantities on returns,
zero prices, missing dates, missing customers, times of day and exact
duplicate rows. The planting rules are fixed so a SQL engine can rebuild
the same rows from the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import bound_tasks, freed_shuffles, table_path
from churnlens.sources.tables import file_bytes

# Fixed planting rules (keyed on order key / part key / customer key).
CANCEL_EVERY = 17        # o_orderkey % 17 == 0 -> cancellation invoice
RETURN_EVERY = 5         # returned line and o_orderkey % 5 == 0 -> negative quantity
NULL_DATE_EVERY = 97     # o_orderkey % 97 == 0 -> missing invoice date
ZERO_PRICE_EVERY = 101   # l_partkey % 101 == 0 -> zero price
NO_CUSTOMER_EVERY = 4    # o_custkey % 4 == 0 -> missing customer id
DUPLICATE_EVERY = 50     # o_orderkey % 50 == 0 -> row exported twice
MINUTES_PER_DAY = 1440   # time of day = o_orderkey % 1440 minutes


# The columns of each source table this view reads (declared: no schema
# inference pass, and only these columns are read).
SOURCE_COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_returnflag string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_COLUMNS[name]).parquet(table_path(sf_dir, name))


def _raw_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_tasks(spark, sum(file_bytes(spark, table_path(sf_dir, name)) for name in ("orders", "lineitem")))
    orders = _read(spark, sf_dir, "orders")
    customer = _read(spark, sf_dir, "customer")
    # Join strategies are left to the planner: it broadcasts a side only when
    # its measured size is under spark.sql.autoBroadcastJoinThreshold, and
    # AQE re-decides from runtime sizes (and splits skewed partitions).
    nation = _read(spark, sf_dir, "nation")
    lineitem = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part")

    # Order-level attributes first (orders is ~1/4 of lineitem), then the
    # line-level joins. lineitem x orders is fact-to-fact: it is always a
    # sort-merge join, never a broadcast of either side: it spills, and AQE
    # splits its skewed partitions.
    order_side = (orders
                  .join(customer, orders.o_custkey == customer.c_custkey)
                  .join(nation, F.col("c_nationkey") == nation.n_nationkey)
                  .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    lines = (lineitem
             .join(order_side.hint("merge"), lineitem.l_orderkey == order_side.o_orderkey)
             .join(part, lineitem.l_partkey == part.p_partkey))

    k = F.col("o_orderkey")
    k_str = k.cast("string")
    invoice = (F.when(k % CANCEL_EVERY != 0, k_str)
               .when(k % 2 == 0, F.concat(F.lit("C"), k_str))
               .otherwise(F.concat(F.lit(" c"), k_str)))
    quantity = F.when((F.col("l_returnflag") == "R") & (k % RETURN_EVERY == 0),
                      -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint")
    minutes = (k % MINUTES_PER_DAY).cast("int")
    invoice_date = F.when(k % NULL_DATE_EVERY == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes))
    price = F.when(F.col("l_partkey") % ZERO_PRICE_EVERY == 0, F.lit(0)).otherwise(
        F.col("p_retailprice")).cast("decimal(12,2)")
    customer_id = F.when(F.col("o_custkey") % NO_CUSTOMER_EVERY == 0, F.lit(None).cast("double")).otherwise(
        F.col("o_custkey").cast("double"))
    return lines.select(
        invoice.alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        quantity.alias("Quantity"),
        invoice_date.alias("InvoiceDate"),
        price.alias("Price"),
        customer_id.alias("Customer ID"),
        F.col("n_name").alias("Country"),
        k.alias("_order_key"),
        F.col("o_orderdate").alias("_order_date"),
    )


def _with_planted_copies(base: DataFrame) -> DataFrame:
    # Every DUPLICATE_EVERY-th order is exported twice. One generator pass
    # instead of a second scan+join of the same inputs.
    copies = F.when(F.col("_order_key") % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return base.withColumn("_copy", F.explode(copies)).drop("_copy")


def raw_transactions_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole raw log in source column names and types."""
    return _with_planted_copies(_raw_base(spark, sf_dir)).drop("_order_key", "_order_date")


def _part_name(names: tuple[str, str], split_year: int):
    return F.when(F.year("_order_date") < split_year, F.lit(names[0])).otherwise(F.lit(names[1]))


def raw_by_part(spark: SparkSession, sf_dir: str, names: tuple[str, str], split_year: int = 1998) -> DataFrame:
    """The whole raw log with the ``part`` that each line is exported in."""
    rows = _with_planted_copies(_raw_base(spark, sf_dir)).withColumn("part", _part_name(names, split_year))
    return rows.drop("_order_key", "_order_date")


def export_raw_parts(spark: SparkSession, sf_dir: str, names: tuple[str, str], root: str,
                     split_year: int = 1998) -> str:
    """Write the raw log once as a folder of named parts (``part=<name>``
    sub-folders), the layout a source export arrives in. Returns ``root``."""
    rows = raw_by_part(spark, sf_dir, names, split_year)
    with freed_shuffles(spark):
        rows.write.mode("overwrite").partitionBy("part").parquet(root)
    return root
