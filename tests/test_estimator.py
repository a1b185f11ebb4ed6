"""The forecaster as a stage of a pipeline: fit, save, load, equal forecasts."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer

from wearline.operators.estimator import WindowForecaster, WindowForecasterModel
from wearline.operators.models import ModelNotFoundError

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = [(i, float(rng.normal()), float(rng.normal()), i % 5 == 0) for i in range(300)]
    data = [(i, a, b, v, 3.0 * a - 2.0 * b * b + float(rng.normal(scale=0.5))) for i, a, b, v in data]
    data += [(1000, float("nan"), 1.0, False, 5.0), (1001, None, 1.0, False, 5.0), (1002, 1.0, 1.0, False, None)]
    return spark.createDataFrame(data, "id long, a double, b double, is_val boolean, rul double")


def forecasts(model, rows):
    return {r["id"]: (r["predicted_rul"], r["reason"]) for r in model.transform(rows).select("id", "predicted_rul", "reason").collect()}


@pytest.mark.parametrize("kind", ["linear", "gbt"])
def test_pipeline_save_and_load(spark, rows, tmp_path, kind):
    stage = WindowForecaster(featureCols=["a", "b2"], kind=kind, validationCol="is_val", maxIter=12, patience=3)
    model = Pipeline(stages=[SQLTransformer(statement="SELECT *, b * b AS b2 FROM __THIS__"), stage]).fit(rows)
    want = forecasts(model, rows)
    assert want[1000] == (None, "reading missing or not finite") and want[1001][0] is None and want[1002][0] is not None
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    assert forecasts(PipelineModel.load(path), rows) == want
    kept = WindowForecaster.load(_saved(stage, tmp_path))
    assert kept.getOrDefault("kind") == kind and kept.getOrDefault("maxIter") == 12 and kept.uid == stage.uid
    assert forecasts(model.copy({model.stages[1].predictionCol: "predicted_rul"}), rows) == want


def _saved(stage, tmp_path):
    path = str(tmp_path / "stage")
    stage.save(path)
    return path


def test_best_round_by_validation_rows(spark, rows):
    stage = WindowForecaster(featureCols=COLS, kind="gbt", validationCol="is_val", maxIter=15, patience=1)
    model = stage.fit(rows)
    n, trees = model.getOrDefault("rounds"), model.regressor
    assert 1 <= n <= 15
    by_hand = {}
    for r in rows.na.drop().filter("NOT isnan(a)").collect():
        x = [r["a"], r["b"]]
        from pyspark.ml.linalg import Vectors

        by_hand[r["id"]] = sum(w * t.predict(Vectors.dense(x)) for t, w in list(zip(trees.trees, trees.treeWeights))[:n])
        if len(by_hand) == 20:
            break
    got = forecasts(model, rows)
    assert all(abs(got[i][0] - p) < 1e-9 for i, p in by_hand.items())
    assert stage.copy({stage.validationCol: ""}).fit(rows).getOrDefault("rounds") == 15  # no validation rows


def test_errors_are_typed(spark, rows, tmp_path):
    with pytest.raises(ModelNotFoundError):
        WindowForecasterModel.load(str(tmp_path / "nothing"))
    with pytest.raises(ModelNotFoundError):
        WindowForecasterModel.load(f"file://{tmp_path}/nothing")
    with pytest.raises(ValueError, match="unknown kind"):
        WindowForecaster(featureCols=COLS, kind="forest").fit(rows)
    with pytest.raises(ValueError, match="no usable"):
        WindowForecaster(featureCols=COLS).fit(rows.limit(0))
    with pytest.raises(ValueError, match="missing feature"):
        WindowForecaster(featureCols=["a", "z"]).fit(rows.filter("a IS NOT NULL").withColumnRenamed("b", "q"))
    with pytest.raises(ValueError, match="already"):
        WindowForecaster(featureCols=COLS).fit(rows.withColumnRenamed("id", "reason"))
