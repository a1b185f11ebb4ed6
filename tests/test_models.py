"""Fitted forecasters: fit, early stop, training curve, save/load, scorer hook."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearline.config import FleetSpec
from wearline.operators import models as ML
from wearline.operators import windows as W
from wearline.sources.artefacts import window_requests

SPEC = FleetSpec(name="t", features=("a", "b"), window=30, weights={"a": 2.0, "b": -1.0}, bias=50.0)


@pytest.fixture(scope="module")
def wins(spark):
    rng = np.random.default_rng(0)
    rows = []
    for e in range(1, 9):
        for c in range(1, 61):
            rul = float(min(60 - c, 125))
            rows.append((e, c, rul + rng.normal(scale=0.5), float(c % 4), rul))
    df = spark.createDataFrame(rows, "engine_id long, cycle long, a double, b double, rul double")
    return W.window_features(df, SPEC).withColumn("is_val", F.col("engine_id") > 6)


def test_linear_fit_save_load(spark, wins, tmp_path):
    model = ML.fit_forecaster(wins, SPEC, kind="linear")
    pred = ML.predict(model, wins, SPEC)
    assert ML.rmse(pred) < 2.0
    p = str(tmp_path / "m")
    ML.save_forecaster(model, p)
    again = ML.predict(ML.load_forecaster(p), wins, SPEC)
    a = sorted((r.engine_id, r.cycle, r.predicted_rul) for r in pred.collect())
    b = sorted((r.engine_id, r.cycle, r.predicted_rul) for r in again.collect())
    assert a == b
    assert ML.training_curve(model, wins, SPEC)


def test_missing_artefact_is_typed(tmp_path):
    with pytest.raises(ML.ModelNotFoundError):
        ML.load_forecaster(str(tmp_path / "nothing"))


def test_gbt_with_validation_curve(spark, wins):
    model = ML.fit_forecaster(wins, SPEC, kind="gbt", max_iter=15)
    curve = ML.training_curve(model, wins.filter("is_val"), SPEC)
    assert 1 <= len(curve) <= 15
    assert all(np.isfinite(v) for _, v in curve)


def test_guarded_scorer_equals_linear_expression(spark, wins):
    rows = [(e, c, float(c * e % 7), float(c % 5)) for e in (1, 2) for c in range(1, 41)] + \
           [(3, c, 1.0, 2.0) for c in range(1, 11)]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, a double, b double")
    lw = W.last_window(df, SPEC, policy="partial", arrays=True)
    req = window_requests(lw, SPEC.features)
    got = {r.engine_id: r for r in ML.guarded_score(req, ML.linear_scorer(SPEC), 30, 2).collect()}
    means = {r.engine_id: r for r in W.last_window(df, SPEC, policy="partial").collect()}
    for e in (1, 2):
        want = SPEC.bias + 2.0 * means[e].a_mean - 1.0 * means[e].b_mean
        assert got[e].reason is None and abs(got[e].predicted_rul - want) < 1e-9
    assert got[3].reason == "shape mismatch" and got[3].predicted_rul is None


def test_gbt_waits_for_its_patience(spark, wins):
    from wearline.plans import queries

    assert (queries.MODEL_ROUNDS, queries.MODEL_PATIENCE) == (50, 10)
    assert ML.best_round([(1, 5.0), (2, 6.0), (3, 4.0), (4, 4.5), (5, 4.0), (6, 1.0)], 2) == 3
    whole = ML.fit_forecaster(wins.filter("NOT is_val"), SPEC, kind="gbt", validation=None, max_iter=12)
    curve = ML.training_curve(whole, wins.filter("is_val"), SPEC)
    model = ML.fit_forecaster(wins, SPEC, kind="gbt", max_iter=12, patience=4)
    assert len(curve) == 12 and model.stages[-1].getNumTrees == ML.best_round(curve, 4)
    assert ML.training_curve(model, wins.filter("is_val"), SPEC) == curve[:model.stages[-1].getNumTrees]
    assert ML.predict(model, wins, SPEC).filter("predicted_rul IS NULL").isEmpty()


def test_curve_of_all_rounds_in_one_pass(spark, wins):
    val = wins.filter("is_val").persist()
    model = ML.fit_forecaster(wins.filter("NOT is_val"), SPEC, kind="gbt", validation=None, max_iter=12)
    want = model.stages[-1].evaluateEachIteration(model.stages[0].transform(val), "squared")
    sc = spark.sparkContext
    sc.setJobGroup("curve", "curve")
    try:
        got = ML.training_curve(model, val, SPEC)
        jobs = len(sc.statusTracker().getJobIdsForGroup("curve"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        val.unpersist()
    assert [i for i, _ in got] == list(range(1, 13)) and np.allclose([v for _, v in got], want, rtol=1e-9)
    assert jobs < 6  # was a job per round
    with pytest.raises(ValueError, match="no row"):
        ML.training_curve(model, val.limit(0), SPEC)
