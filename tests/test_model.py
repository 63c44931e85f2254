"""Model training, scoring, Shapley and prediction log."""

from __future__ import annotations

import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from churnlens.operators.model import (
    append_predictions,
    batch_predictions,
    churn_margin,
    churn_probability,
    evaluate_model,
    fit_sample,
    gbt_settings,
    load_model,
    risk_level,
    save_model,
    train_churn_model,
)
from churnlens.operators.shapley import baseline_point, global_importance, shapley_contributions
from churnlens.operators.tree_paths import path_contributions
from churnlens.schemas import FEATURE_COLUMNS, SNAPSHOT_SCHEMA
from churnlens.sources.tables import TableTarget


@pytest.fixture(scope="module")
def panel(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        rec = rnd.randint(0, 400)
        rows.append((str(i), datetime(2010, 1 + i % 12, 1), rec, rnd.randint(1, 20), rnd.random() * 500,
                     rnd.random() * 50, rec + rnd.randint(0, 400), rnd.randint(1, 30), rnd.random(),
                     rec > 150 or rnd.random() < 0.1))
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA).cache()


@pytest.fixture(scope="module")
def model(panel):
    return train_churn_model(panel, {"n_estimators": 500, "learning_rate": 0.05, "num_leaves": 31,
                                     "random_state": 42}, max_iter=5)


def test_param_mapping():
    s = gbt_settings({"n_estimators": 500, "learning_rate": 0.05, "num_leaves": 31, "random_state": 42})
    assert s == {"maxIter": 500, "stepSize": 0.05, "seed": 42, "maxDepth": 5, "lossType": "logistic"}


def test_scores_are_probabilities(panel, model):
    s = churn_probability(model, panel).agg(F.min("churn_probability"), F.max("churn_probability"),
                                            F.count("*")).first()
    assert 0.0 <= s[0] <= s[1] <= 1.0 and s[2] == 300


def test_shapley_efficiency(panel, model):
    sh = shapley_contributions(model, panel.limit(40), baseline_point(panel))
    tot = sum(F.col(f"phi_{c}") for c in FEATURE_COLUMNS)
    err = sh.agg(F.max(F.abs(tot - (F.col("prediction") - F.col("base_value"))))).first()[0]
    assert err < 1e-9
    imp = global_importance(sh).orderBy("rank").collect()
    assert [r["rank"] for r in imp] == list(range(1, 8))
    assert imp[0]["mean_abs_contribution"] >= imp[-1]["mean_abs_contribution"]


def test_tree_paths_equal_all_coalitions(panel, model):
    base = baseline_point(panel)
    want = {r["customer_id"]: r for r in shapley_contributions(lambda df: churn_margin(model, df), panel, base).collect()}
    out = path_contributions(model, panel, base)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan
    got = out.collect()
    assert len(got) == len(want) == 300
    for r in got:
        assert all(abs(r[c] - want[r["customer_id"]][c]) < 1e-9 for c in out.columns[2:])
    assert any(abs(r["phi_recency_days"]) > 0.01 for r in got)
    margins = {r["customer_id"]: r["churn_probability"] for r in churn_margin(model, panel).collect()}
    assert all(abs(r["prediction"] - margins[r["customer_id"]]) < 1e-12 for r in got)


def test_tree_paths_take_empty_and_unusual_rows(spark, panel, model):
    base = baseline_point(panel)
    assert path_contributions(model, panel.limit(0), base).collect() == []
    odd = panel.limit(3).withColumn("monetary_avg_order", F.lit(float("nan"))).withColumn("return_rate", F.lit(None).cast("double"))
    rows = path_contributions(model, odd.union(odd), base, ["customer_id"]).collect()
    assert len(rows) == 6 and all(abs(sum(r[f"phi_{c}"] for c in FEATURE_COLUMNS) - (r["prediction"] - r["base_value"])) < 1e-9 for r in rows)


def test_the_model_ranks_better_than_recency(panel, model):
    from churnlens.operators.metrics import pr_curve, pr_summary, recency_baseline_score

    figures = lambda df, c: pr_summary(pr_curve(df, c), 0.7).first()
    own = figures(churn_probability(model, panel), "churn_probability")
    plain = figures(recency_baseline_score(panel, 134), "score")
    assert own["average_precision"] > plain["average_precision"] and own["recall_at_precision"] >= plain["recall_at_precision"]
    constant = figures(panel.withColumn("c", F.lit(0.5)), "c")
    assert own["average_precision"] > constant["average_precision"] + 0.2


def test_risk_bands(spark):
    df = spark.createDataFrame([(0.9,), (0.5,), (0.1,)], "p double")
    bands = (("high", 0.7), ("medium", 0.4), ("low", 0.0))
    assert [r[0] for r in df.select(risk_level(F.col("p"), bands)).collect()] == ["high", "medium", "low"]


def test_predictions_are_appended(spark, panel, model):
    feats = panel.select("customer_id", *FEATURE_COLUMNS)
    preds = batch_predictions(model, feats, "2011-01-01", (("high", 0.7), ("low", 0.0)))
    target = TableTarget(tempfile.mkdtemp(prefix="pred-") + "/p", mode="append")
    append_predictions(preds, target)
    append_predictions(preds, target)
    back = target.read(spark)
    assert back.count() == 600
    assert set(back.columns) == {"customer_id", "as_of_date", "churn_probability", "risk_level", "scored_at"}
    with pytest.raises(ValueError):
        append_predictions(preds, TableTarget("/tmp/x", mode="replace"))


def test_predictions_for_selected_customers(spark, panel, model):
    feats = panel.select("customer_id", *FEATURE_COLUMNS)
    chosen = spark.createDataFrame([("3",), ("7",), ("no-such-id",)], "customer_id string")
    preds = batch_predictions(model, feats, "2011-01-01", (("high", 0.7), ("low", 0.0)), customers=chosen)
    assert sorted(r["customer_id"] for r in preds.collect()) == ["3", "7"]


def test_a_saved_model_scores_alike(panel, model):
    path = tempfile.mkdtemp(prefix="model-") + "/m"
    save_model(model, path)
    save_model(model, path)  # again: replaced
    scores = lambda m: sorted(map(tuple, churn_probability(m, panel).select("customer_id", "churn_probability").collect()))
    assert scores(load_model(path)) == scores(model)


def test_evaluation_equals_plain_figures(panel, model):
    r = evaluate_model(model, panel, {"n_estimators": 500}, 0.5).first()
    rows = [(x["churn_probability"], x["is_churned"]) for x in churn_probability(model, panel).collect()]
    assert (r["n_rows"], r["n_positive"]) == (300, sum(y for _, y in rows))
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (sum(p >= 0.5 and y for p, y in rows), sum(p >= 0.5 and not y for p, y in rows),
                                                   sum(p < 0.5 and y for p, y in rows), sum(p < 0.5 and not y for p, y in rows))
    ap = sum(sum(y for q, y in rows if q == p) / r["n_positive"] * (sum(y for q, y in rows if q >= p) / sum(q >= p for q, _ in rows))
             for p in {p for p, _ in rows})
    assert r["average_precision"] == pytest.approx(ap) and r["max_iter"] == 500


def test_the_fit_is_bounded_by_its_parameter_only(panel):
    picked = fit_sample(panel, 40).collect()
    assert len(picked) == 40 and picked == fit_sample(panel.repartition(7), 40).collect()
    assert fit_sample(panel, 10_000).count() == panel.count()
