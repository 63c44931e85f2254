"""Churn model training and batch scoring on MLlib.

The declared model is a gradient-boosted tree ensemble; MLlib's
``GBTClassifier`` trains it distributed (per-iteration histogram
aggregation across executors). Parameters are mapped where MLlib has a
peer: n_estimators -> maxIter, learning_rate -> stepSize,
random_state -> seed; a leaf budget has no peer, so num_leaves becomes
the depth whose full tree has at least that many leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import ntz
from churnlens.operators.cuts import BINS, counted_rows, feature_cuts, value_counts, with_cuts
from churnlens.operators.leaves import leaf_boxes
from churnlens.operators.metrics import confusion_at, pr_curve, pr_summary
from churnlens.schemas import FEATURE_COLUMNS
from churnlens.session import materialize, ship_package
from churnlens.sources.tables import TableTarget

TASK_ROWS = 1_000_000     # distinct rows of a task of the fit at most
SMALL_TASK_ROWS = 20_000  # and at least, where that leaves cores idle
NON_FINITE_FILL = -1.0  # monetary_avg_order is +-inf/NaN when frequency is 0


def gbt_settings(model_params: dict, max_iter: int | None = None) -> dict:
    leaves = int(model_params.get("num_leaves", 31))
    return {
        "maxIter": int(max_iter if max_iter is not None else model_params.get("n_estimators", 100)),
        "stepSize": float(model_params.get("learning_rate", 0.1)),
        "seed": int(model_params.get("random_state", 42)),
        "maxDepth": max(1, math.ceil(math.log2(leaves))) if leaves > 1 else 1,
        "lossType": "logistic",
    }


def model_features() -> list[Column]:
    """The features as the model sees them: finite doubles."""
    values = [F.col(c).cast("double") for c in FEATURE_COLUMNS]
    return [F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), v).otherwise(F.lit(NON_FINITE_FILL)) for v in values]


def model_input(df: DataFrame) -> DataFrame:
    """Features as finite doubles, label as double."""
    cols = dict(zip(FEATURE_COLUMNS, model_features(), strict=True))
    if "is_churned" in df.columns:
        cols["label"] = F.col("is_churned").cast("double")
    return df.withColumns(cols)


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features")


def fit_sample(train: DataFrame, max_fit_rows: int, key_cols=("customer_id", "snapshot_date")) -> DataFrame:
    """At most ``max_fit_rows`` labelled rows, those of smallest key hash: the same at every run. For trials by hand; no
    job or query fits on it."""
    return train.orderBy(F.xxhash64(*key_cols), *key_cols).limit(int(max_fit_rows))


def train_churn_model(train: DataFrame, model_params: dict, max_iter: int | None = None,
                      balance_classes: bool = True) -> PipelineModel:
    """D3: fit assembler + GBT (balanced class weights) on every row of the train split.

    The cuts come from all values, and rows that differ in no cut are fitted as one of their common weight
    (:mod:`churnlens.operators.cuts`). What is fitted is written once, and read by every pass over it."""
    spark = train.sparkSession
    data = materialize(model_input(train).select(*FEATURE_COLUMNS, "label"), "labelled_rows")
    counts = data.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
    n, pos = float(counts["n"]), float(counts["pos"] or 0.0)
    balanced = balance_classes and 0 < pos < n
    w_neg, w_pos = (n / (2.0 * (n - pos)), n / (2.0 * pos)) if balanced else (1.0, 1.0)
    cuts = feature_cuts(value_counts(data, FEATURE_COLUMNS), FEATURE_COLUMNS, (w_neg, w_pos))
    rows = counted_rows(data, FEATURE_COLUMNS, cuts).withColumn(
        "weight", F.col("n") * F.when(F.col("label") == 1.0, w_pos).otherwise(w_neg))
    distinct = rows.count()
    # with so many bins allowed MLlib looks at every row for its cuts, which are those between the bins
    gbt = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                        maxBins=max(BINS, math.isqrt(distinct) + 1), **gbt_settings(model_params, max_iter))
    # every tree passes over the rows a few times: as many tasks as there are cores, unless the rows are few or very many
    tasks = max(-(-distinct // TASK_ROWS), min(-(-distinct // SMALL_TASK_ROWS), spark.sparkContext.defaultParallelism), 1)
    assembler = _assembler()
    # sorted, so that neighbouring rows take the same ways down the trees
    model = gbt.fit(assembler.transform(rows.repartition(tasks).sortWithinPartitions(*FEATURE_COLUMNS)))
    return PipelineModel([assembler, with_cuts(model, cuts, spark)])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluate_model(model: PipelineModel, test: DataFrame, model_params: dict, min_precision: float,
                   threshold: float = 0.5) -> DataFrame:
    """The model's ranking and confusion figures on a labelled split, with its parameters:
    one row of the training metrics table. The split is scored once and written."""
    scored = materialize(churn_probability(model, test).select("churn_probability", "is_churned"), "scored")
    curve = pr_summary(pr_curve(scored, "churn_probability"), min_precision)
    counts = confusion_at(scored, threshold, "churn_probability")
    settings = gbt_settings(model_params)
    # both are single rows; the key makes it an equi-join
    return (curve.withColumn("_k", F.lit(0)).join(counts.withColumn("_k", F.lit(0)), "_k").drop("_k")
            .withColumns({"threshold": F.lit(float(threshold)), "max_iter": F.lit(settings["maxIter"]),
                          "step_size": F.lit(settings["stepSize"]), "max_depth": F.lit(settings["maxDepth"]),
                          "seed": F.lit(settings["seed"])}))


def churn_probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``churn_probability`` (P(label = 1)), from the model's leaves: a batch of rows is looked up at once, where MLlib's
    own ``transform`` walks every tree for every row."""
    spark = df.sparkSession
    ship_package(spark)
    boxes = spark.sparkContext.broadcast(leaf_boxes(model, spark))  # bounded by the number of trees and leaves

    @F.pandas_udf("double")
    def probability(values: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in values:
            margins = boxes.value.margins(np.stack([c.to_numpy(float) for c in columns], axis=1))
            yield pd.Series(1.0 / (1.0 + np.exp(-2.0 * margins)))

    return df.select(*[F.col(f"`{c}`") for c in df.columns], probability(*model_features()).alias("churn_probability"))


def churn_margin(model: PipelineModel, df: DataFrame) -> DataFrame:
    """As :func:`churn_probability`, but the column holds the model's margin, the sum over its trees (half the log-odds)."""
    scored = model.transform(model_input(df))
    return scored.select(*df.columns, vector_to_array(F.col("rawPrediction"))[1].alias("churn_probability"))


def risk_level(p: Column, bands) -> Column:
    """First band whose lower bound the probability reaches (bands high->low)."""
    expr = None
    for name, lower in bands:
        cond = p >= F.lit(float(lower))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def batch_predictions(model: PipelineModel, features: DataFrame, as_of_date, bands,
                      scored_at: datetime | None = None, customers: DataFrame | None = None) -> DataFrame:
    """One prediction row per customer of a feature batch, or only for
    the ``customers`` given as a frame of ids (kept with a semi join)."""
    scored_at = scored_at or datetime.now()
    if customers is not None:
        features = features.join(customers.select("customer_id"), "customer_id", "left_semi")
    scored = churn_probability(model, features)
    return scored.select(
        "customer_id",
        ntz(as_of_date).alias("as_of_date"),
        F.col("churn_probability"),
        risk_level(F.col("churn_probability"), bands).alias("risk_level"),
        ntz(scored_at).alias("scored_at"),
    )


def append_predictions(predictions: DataFrame, target: TableTarget) -> None:
    """Predictions are a history: the target must be append-only."""
    if target.mode != "append":
        raise ValueError("a prediction log keeps its history: its table needs mode 'append'")
    target.write(predictions)
