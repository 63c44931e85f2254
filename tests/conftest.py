from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from churnlens.schemas import CLEAN_COLUMNS  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="churnlens-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def make_clean(spark):
    """Lines (invoice, stock code, quantity, date text, price, customer) through the cleaning
    steps that add columns; no line is dropped."""
    from churnlens.operators import clean as C

    raw = T.StructType([T.StructField("Invoice", T.StringType()), T.StructField("StockCode", T.StringType()),
                        T.StructField("Quantity", T.LongType()), T.StructField("When", T.StringType()),
                        T.StructField("Price", T.DoubleType()), T.StructField("Customer ID", T.DoubleType())])

    def build(lines):
        df = spark.createDataFrame([(*line[:5], float(line[5])) for line in lines], raw)
        df = (df.withColumn("InvoiceDate", F.col("When").cast("timestamp_ntz")).drop("When")
              .withColumn("Description", F.lit("thing")).withColumn("Country", F.lit("Somewhere")))
        clean = C.cast_customer_key(C.add_quality_flags(C.rename_to_contract(df), "2999-01-01"))
        return clean.select(CLEAN_COLUMNS)
    return build
