"""The model is fitted on every labelled row (D3)."""

from __future__ import annotations

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnlens.operators.cuts import cut_ranks
from churnlens.operators.model import churn_probability, gbt_settings, model_input, save_model, train_churn_model
from churnlens.schemas import FEATURE_COLUMNS

PARAMS = {"n_estimators": 500, "learning_rate": 0.05, "num_leaves": 31, "random_state": 42}


def _rows(spark, n: int):
    """Labelled rows of many distinct values and a few very common ones."""
    i = F.col("id")
    spread = lambda k: F.pmod(F.xxhash64(i, F.lit(k)), F.lit(100_000)).cast("double") / 1000
    cols = [F.when(i % 3 == 0, 0.0).otherwise(spread(k)) if k % 2 else F.floor(spread(k) / 4) for k in range(len(FEATURE_COLUMNS))]
    return spark.range(n).select(
        i.cast("string").alias("customer_id"), F.lit("2010-01-01").cast("timestamp_ntz").alias("snapshot_date"),
        *[c.cast("double").alias(f) for c, f in zip(cols, FEATURE_COLUMNS)],
        ((cols[0] + cols[1] > 30) | (i % 11 == 0)).alias("is_churned"))


def _root_weight(spark, model, path: str) -> float:
    """The weights of all rows that the first tree was grown on."""
    save_model(model, path)
    return spark.read.parquet(f"{path}/stages/1_*/data").filter("treeID = 0 AND nodeData.id = 0").select(
        "nodeData.impurityStats").first()[0][0]


@pytest.mark.parametrize("n", [300, 24_000])
def test_every_row_is_fitted(spark, tmp_path, n):
    model = train_churn_model(_rows(spark, n), PARAMS, max_iter=1)
    assert _root_weight(spark, model, f"{tmp_path}/m") == pytest.approx(n)  # balanced weights add up to the rows


def _mllib(rows, max_iter: int, **settings):
    """MLlib's own fit: below 10,000 rows it takes its cuts from all of them."""
    gbt = GBTClassifier(featuresCol="features", labelCol="label", **gbt_settings(PARAMS, max_iter), **settings)
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features"), gbt]).fit(model_input(rows))


def _nodes(spark, model, path: str) -> list:
    save_model(model, path)
    rows = spark.read.parquet(f"{path}/stages/1_*/data").select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.split").collect()
    return sorted((r["treeID"], r["id"], r["prediction"], r["split"]["featureIndex"], *r["split"]["leftCategoriesOrThreshold"]) for r in rows)


def test_the_fit_is_that_of_mllib_where_this_samples_nothing(spark, tmp_path):
    rows = _rows(spark, 4_000).cache()
    mine, theirs = train_churn_model(rows, PARAMS, max_iter=4, balance_classes=False), _mllib(rows, 4)
    first = [[n for n in _nodes(spark, m, f"{tmp_path}/{i}") if n[0] == 0] for i, m in enumerate((mine, theirs))]
    assert [x[:2] + x[3:] for x in first[0]] == [x[:2] + x[3:] for x in first[1]] and len(first[0]) > 15
    assert [x[2] for x in first[0]] == pytest.approx([x[2] for x in first[1]], abs=1e-12)
    # later trees may split a node of equal gradients or not, which moves no score
    scores = lambda m: [r[0] for r in churn_probability(m, rows).orderBy("customer_id").select("churn_probability").collect()]
    assert scores(mine) == pytest.approx(scores(theirs), abs=1e-9) and len(set(scores(mine))) > 10


def test_cuts_come_from_every_value(spark, tmp_path):
    """Three rows of 30,000 hold a value of their own and decide the label: a sample of 10,000 may miss them."""
    rows = _rows(spark, 30_000).withColumns({c: F.lit(1.0) for c in FEATURE_COLUMNS[1:]}).withColumn(
        FEATURE_COLUMNS[0], F.when(F.col("customer_id").isin("7", "8", "9"), 2.5).otherwise(1.0))
    rows = rows.withColumn("is_churned", F.col(FEATURE_COLUMNS[0]) > 2)
    nodes = _nodes(spark, train_churn_model(rows, PARAMS, max_iter=1), f"{tmp_path}/m")
    assert [(n[3], n[4]) for n in nodes if n[1] == 0] == [(0, 1.75)] and len(nodes) == 3


def test_rows_without_differences_make_one_leaf(spark):
    rows = _rows(spark, 50).withColumns({c: F.lit(1.0) for c in FEATURE_COLUMNS})
    scores = {round(r[0], 9) for r in churn_probability(train_churn_model(rows, PARAMS, max_iter=2), rows).select("churn_probability").collect()}
    assert len(scores) == 1


def test_cut_ranks_follow_the_counts():
    def walked(counts, bins):
        """The rule step by step, with one target at a time."""
        share, total, target, out = sum(counts) / bins, counts[0], sum(counts) / bins, []
        for i, n in enumerate(counts[1:], 2):
            before, total = total, total + n
            if abs(before - target) < abs(total - target):
                out.append(i)
                target += share
        return out

    rnd = random.Random(5)
    for _ in range(200):
        counts = [rnd.choice([1, 1, 2, 9, 700]) for _ in range(rnd.randint(33, 300))]
        below = [sum(counts[:i]) + counts[i] / 2 for i in range(len(counts))]
        reached = [next((i + 1 for i, m in enumerate(below) if i and m > k * sum(counts) / 32), None) for k in range(1, 32)]
        assert cut_ranks(len(counts), reached) == walked(counts, 32)
    assert cut_ranks(3, [2, None]) == [2, 3] and cut_ranks(1, [None] * 31) == []
