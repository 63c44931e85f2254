"""Append-only prediction log fed by a stream of feature batches.

Feature rows (customer_id, as_of_date, seven features) land as files in a
folder; a Structured Streaming query scores each new micro-batch with the
trained model and writes it under ``stream=<id>/batch_id=<n>`` of the
prediction log. A stream's id is made with its checkpoint and kept there, so
a batch replayed after a failure (same stream, same number) replaces itself
instead of being appended twice, while another stream, or one started anew
from a fresh checkpoint, writes beside it: the log is exactly-once and
history is never rewritten.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnlens.functions.columns import ntz
from churnlens.operators.model import churn_probability, risk_level
from churnlens.schemas import FEATURE_COLUMNS
from churnlens.sources.tables import hadoop_path

FEATURE_BATCH_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("as_of_date", T.TimestampNTZType()),
    T.StructField("recency_days", T.LongType()),
    T.StructField("frequency", T.LongType()),
    T.StructField("monetary_total", T.DoubleType()),
    T.StructField("monetary_avg_order", T.DoubleType()),
    T.StructField("customer_tenure_days", T.LongType()),
    T.StructField("n_distinct_products", T.LongType()),
    T.StructField("return_rate", T.DoubleType()),
])


def score_batch(model: PipelineModel, features: DataFrame, bands, scored_at: datetime) -> DataFrame:
    scored = churn_probability(model, features.select("customer_id", "as_of_date", *FEATURE_COLUMNS))
    return scored.select(
        "customer_id", "as_of_date", "churn_probability",
        risk_level(F.col("churn_probability"), bands).alias("risk_level"),
        ntz(scored_at).alias("scored_at"))


def start_prediction_stream(spark: SparkSession, model: PipelineModel, source_dir: str, log_dir: str,
                            checkpoint_dir: str, bands, available_now: bool = True,
                            max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Score feature files as they arrive; one log folder per stream and micro-batch."""
    stream_id = _stream_id(spark, checkpoint_dir)
    reader = spark.readStream.schema(FEATURE_BATCH_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        preds = score_batch(model, batch, bands, datetime.now())
        preds.write.mode("overwrite").parquet(f"{log_dir.rstrip('/')}/stream={stream_id}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that the checkpoint holds, made when there is none."""
    fs, folder = hadoop_path(spark, checkpoint_dir)
    jvm = spark.sparkContext._jvm.org.apache
    path = jvm.hadoop.fs.Path(folder, "stream_id")
    if not fs.exists(path):
        out = fs.create(path, False)
        out.write(bytearray(uuid.uuid4().hex.encode()))
        out.close()
    stream = fs.open(path)
    try:
        return jvm.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def read_prediction_log(spark: SparkSession, log_dir: str) -> DataFrame:
    return spark.read.parquet(log_dir).drop("stream")
