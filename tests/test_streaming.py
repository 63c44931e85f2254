"""Streaming prediction log: new files only, exactly once across restarts."""

from __future__ import annotations

import random
import tempfile
from datetime import datetime

from churnlens.operators.model import train_churn_model
from churnlens.schemas import SNAPSHOT_SCHEMA
from churnlens.streaming import FEATURE_BATCH_SCHEMA, read_prediction_log, start_prediction_stream

BANDS = (("high", 0.7), ("medium", 0.4), ("low", 0.0))


def _features(spark, n, day, seed):
    rnd = random.Random(seed)
    rows = [(f"{seed}-{i}", day, rnd.randint(0, 400), rnd.randint(1, 9), rnd.random() * 100, rnd.random() * 20,
             rnd.randint(0, 800), rnd.randint(1, 9), rnd.random()) for i in range(n)]
    return spark.createDataFrame(rows, FEATURE_BATCH_SCHEMA)


def test_stream_scores_each_file_once(spark):
    rnd = random.Random(5)
    train = spark.createDataFrame(
        [(str(i), datetime(2010, 1, 1), r, 2, 10.0, 5.0, r + 10, 2, 0.1, r > 200)
         for i, r in enumerate(rnd.randint(0, 400) for _ in range(200))], SNAPSHOT_SCHEMA)
    model = train_churn_model(train, {"random_state": 1}, max_iter=3)
    base = tempfile.mkdtemp(prefix="stream-")
    src, log, ck = f"{base}/src", f"{base}/log", f"{base}/ck"
    _features(spark, 30, datetime(2011, 1, 1), 1).write.parquet(f"{src}/a")

    start_prediction_stream(spark, model, f"{src}/*", log, ck, BANDS).awaitTermination()
    assert read_prediction_log(spark, log).count() == 30

    _features(spark, 20, datetime(2011, 2, 1), 2).write.parquet(f"{src}/b")
    start_prediction_stream(spark, model, f"{src}/*", log, ck, BANDS).awaitTermination()
    # restart with nothing new: no batch, no duplicate
    start_prediction_stream(spark, model, f"{src}/*", log, ck, BANDS).awaitTermination()
    out = read_prediction_log(spark, log)
    assert out.count() == 50
    assert out.select("customer_id", "as_of_date").distinct().count() == 50
    assert {r["risk_level"] for r in out.collect()} <= {"high", "medium", "low"}


def test_history_survives_a_second_stream(spark):
    """Two streams with checkpoints of their own write beside each other."""
    train = spark.createDataFrame([(str(i), datetime(2010, 1, 1), i, 2, 10.0, 5.0, i + 10, 2, 0.1, i > 50) for i in range(100)],
                                  SNAPSHOT_SCHEMA)
    model = train_churn_model(train, {"random_state": 1}, max_iter=2)
    base = tempfile.mkdtemp(prefix="stream-")
    for n, seed in ((30, 1), (7, 2)):
        _features(spark, n, datetime(2011, seed, 1), seed).write.parquet(f"{base}/src{seed}/a")
        start_prediction_stream(spark, model, f"{base}/src{seed}/*", f"{base}/log", f"{base}/ck{seed}", BANDS).awaitTermination()
    assert read_prediction_log(spark, f"{base}/log").count() == 37
