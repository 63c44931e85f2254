from churnlens.streaming.scoring import (
    FEATURE_BATCH_SCHEMA,
    read_prediction_log,
    score_batch,
    start_prediction_stream,
)

__all__ = ["FEATURE_BATCH_SCHEMA", "read_prediction_log", "score_batch", "start_prediction_stream"]
