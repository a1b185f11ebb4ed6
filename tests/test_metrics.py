"""Metrics, gates and the published evaluation pairs."""

import math
import os

import pytest

from wearline.operators import metrics as M

FIXTURE = os.path.join(os.path.dirname(__file__), "fixtures", "published_pairs.csv")

# The published evaluation over 100 test engines.
PUBLISHED_RMSE = 15.792954357886297
PUBLISHED_MAE = 11.055716171264649
PUBLISHED_SCORE = 673.5187789793798


def test_asymmetric_pair(spark):
    df = spark.createDataFrame([(60.0, 50.0), (40.0, 50.0)], "predicted_rul double, actual_rul double")
    late = M.forecast_metrics(df.filter("predicted_rul > 50")).first()["score"]
    early = M.forecast_metrics(df.filter("predicted_rul < 50")).first()["score"]
    assert late > early


def test_published_pairs_reproduce_headline(spark):
    df = spark.read.option("header", True).schema(
        "engine_id long, predicted_rul double, actual_rul double").csv(FIXTURE)
    m = M.forecast_metrics(df).first()
    assert m["n"] == 100
    assert math.isclose(m["rmse"], PUBLISHED_RMSE, rel_tol=1e-12)
    assert math.isclose(m["mae"], PUBLISHED_MAE, rel_tol=1e-12)
    assert math.isclose(m["score"], PUBLISHED_SCORE, rel_tol=1e-12)
    gates = {r.gate: r.passed for r in M.quality_gate(M.forecast_metrics(df)).collect()}
    assert gates == {"rmse": True, "score": True, "engines": True}


def test_early_stop_series(spark):
    losses = [5.0, 4.0, 4.5, 3.0, 3.2, 3.1, 3.3, 3.4, 2.0]
    df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(losses)], "step long, loss double")
    got = M.early_stop_series(df, patience=3).orderBy("step").collect()
    assert [r.best for r in got] == [5.0, 4.0, 4.0, 3.0, 3.0, 3.0, 3.0, 3.0, 2.0]
    assert [r.since_improvement for r in got] == [0, 0, 1, 0, 1, 2, 3, 4, 0]
    assert [r.step for r in got if r.stop] == [7]


def test_weighted_loss(spark):
    df = spark.createDataFrame([(1, 2.0, 10), (1, 4.0, 30), (2, 1.0, 0)], "step long, loss double, n long")
    got = {r.step: r.loss for r in M.weighted_loss(df).collect()}
    assert got[1] == pytest.approx(3.5) and got[2] == 0.0


def test_early_stop_keeps_runs_and_metrics_apart(spark):
    curves = {("r1", "a"): [5.0, 4.0, 4.0, 4.5, 3.0, 9.0, 9.0, 9.0, 1.0], ("r1", "b"): [1.0, 2.0, 3.0, 4.0], ("r2", "a"): [float("nan"), None, 2.0, 2.0],
              ("r2", "b"): [3.0, 2.0, 1.0]}
    rows = [(r, s * 10, m, v) for (r, m), vs in curves.items() for s, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "run_id string, step long, metric string, value double").repartition(3)
    got = {(r.run_id, r.metric): (r.n_steps, r.stop_step, r.best_step, r.best_value) for r in M.early_stop_points(df, patience=3).collect()}
    assert got == {("r1", "a"): (9, 70, 40, 3.0), ("r1", "b"): (4, 30, 0, 1.0), ("r2", "a"): (4, None, 20, 2.0), ("r2", "b"): (3, None, 20, 1.0)}
    series = M.early_stop_series(df.filter("run_id = 'r1' AND metric = 'a'"), 3, value="value").orderBy("step").collect()
    assert [r.since_improvement for r in series] == [0, 0, 1, 2, 0, 1, 2, 3, 0] and [r.step for r in series if r.stop] == [70]
