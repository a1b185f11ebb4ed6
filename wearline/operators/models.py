"""Fitted remaining-life forecasters on Spark ML (I1, I4-I6) and the pluggable
scorer hook (L1).

Inputs are the window summary features (I2): for every full window the last
value, mean, population std and slope of each feature, so a fitted model sees
the temporal shape of the window. Fits run distributed in Spark ML; saved
models are Spark ML pipelines (no pickled code).
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BAD_READING, FleetSpec
from ..functions.scalar import any_not_finite
from ..session import ship_package
from .boosting import fit_boosted
from .quality import guard_reason


class ModelNotFoundError(FileNotFoundError):
    """A saved model artefact is missing."""


def summary_columns(spec: FleetSpec) -> list[str]:
    return [f"{f}_{s}" for f in spec.features for s in ("last", "mean", "std", "slope")]


def fit_forecaster(windows: DataFrame, spec: FleetSpec, kind: str = "linear", label: str = "rul",
                   validation: str | None = "is_val", max_iter: int = 20, solver: str = "normal",
                   patience: int | None = None) -> PipelineModel:
    """Fit on train windows; validation windows (``validation`` true) decide when
    a boosted model stops (``validationIndicatorCol``: at the first round without
    improvement; with ``patience``: after so many, back to the best round). Seeded (I1).

    The estimators pass over their input several times (statistics, splits,
    iterations), so the window features are persisted (recomputed from lineage
    if an executor is lost) for the fit only, before they are tested: a test on
    their expressions would compute each several times. Boosting holds its own binned rows
    in memory (``fit_boosted``), so its window features, read a few times, stay on disk.
    """
    cols = summary_columns(spec)
    asm = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    if kind == "linear":
        data = windows.filter(~F.col(validation)) if validation else windows
        # "normal": exact normal equations in one distributed pass; "l-bfgs" iterates
        est = LinearRegression(featuresCol="features", labelCol=label, predictionCol="predicted_rul",
                               maxIter=max_iter, standardization=True, solver=solver)
    elif kind == "gbt":
        data = windows
        params = dict(featuresCol="features", labelCol=label, predictionCol="predicted_rul",
                      maxIter=max_iter, maxDepth=4, seed=spec.seed, stepSize=0.2)
        if validation and patience is None:
            params.update(validationIndicatorCol=validation, validationTol=0.001)
        est = GBTRegressor(**params)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    level = StorageLevel.DISK_ONLY if kind == "gbt" else StorageLevel.MEMORY_AND_DISK
    held = data.select(*dict.fromkeys([*cols, label, *([validation] if validation else [])])).persist(level)
    data = held.filter(~any_not_finite(cols))
    try:
        if kind != "gbt" or (validation and patience is None):
            return Pipeline(stages=[asm, est]).fit(data)
        model = PipelineModel([asm, fit_boosted(est, data.filter(~F.col(validation)) if validation else data, cols)])
        if not validation:
            return model
        if data.filter(F.col(validation)).isEmpty():
            return model
        rounds = best_round(training_curve(model, data.filter(F.col(validation)), spec, label), patience)
        return PipelineModel([model.stages[0], _first_rounds(model.stages[1], rounds)])
    finally:
        held.unpersist()


def best_round(curve: list[tuple[int, float]], patience: int) -> int:
    """The step of the least loss up to where ``patience`` steps in a row brought no strict improvement."""
    at, best = curve[0]
    for step, loss in curve:
        if loss < best:
            at, best = step, loss
        elif step - at >= patience:
            break
    return at


def _first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The boosted model of the first ``rounds`` trees."""
    java, gateway = model._java_obj, SparkSession.getActiveSession().sparkContext._gateway
    ml, had, weighed = gateway.jvm.org.apache.spark.ml.regression, java.trees(), java.treeWeights()
    trees, weights = gateway.new_array(ml.DecisionTreeRegressionModel, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = had[i], weighed[i]
    cut = ml.GBTRegressionModel(java.uid(), trees, weights)
    return GBTRegressionModel(cut.copy(java.extractParamMap()))


def predict(model: PipelineModel, windows: DataFrame, spec: FleetSpec) -> DataFrame:
    """Forecasts; a window with a feature that isn't finite gets none and a ``reason``."""
    cols = summary_columns(spec)
    bad = any_not_finite(cols)
    out = model.transform(windows).drop("features")
    out = out.withColumn("predicted_rul", F.when(~bad, F.col("predicted_rul")))
    return out.withColumn("reason", F.when(bad, F.lit(BAD_READING)))


def training_curve(model: PipelineModel, val: DataFrame, spec: FleetSpec, label: str = "rul") -> list[tuple[int, float]]:
    """(step, loss) per iteration: linear objective history, or the boosted
    model's validation squared error after each tree (I6)."""
    stage = model.stages[-1]
    if hasattr(stage, "summary") and hasattr(stage.summary, "objectiveHistory"):
        return [(i + 1, float(v)) for i, v in enumerate(stage.summary.objectiveHistory)]
    assembled = model.stages[0].transform(val.filter(~any_not_finite(summary_columns(spec))))
    return boosting_curve(stage, assembled, label)


def tree_nodes(node) -> tuple | float:
    """A tree model's node as (feature, threshold or categories on the left, left, right), or a leaf's forecast."""
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    split = node.split()
    by = split.threshold() if split.getClass().getSimpleName() == "ContinuousSplit" else tuple(split.leftCategories())
    return split.featureIndex(), by, tree_nodes(node.leftChild()), tree_nodes(node.rightChild())


def apply_tree(node: tuple | float, x: np.ndarray) -> np.ndarray | float:
    """The forecasts for the rows of ``x`` (features by rows)."""
    if not isinstance(node, tuple):
        return node
    feature, by, left, right = node
    return np.where(np.isin(x[feature], by) if isinstance(by, tuple) else x[feature] <= by, apply_tree(left, x), apply_tree(right, x))


def boosting_curve(model: GBTRegressionModel, rows: DataFrame, label: str) -> list[tuple[int, float]]:
    """(trees, mean squared error of the first so many trees), in one pass over ``rows`` (with the feature vector).

    Each task applies the trees to whole columns and sums up its rows; the sums of the tasks (a row of one number per tree each) are added in their order.
    """
    ship_package(rows.sparkSession)
    weights = np.array(model.treeWeights)
    roots = [tree_nodes(tree._java_obj.rootNode()) for tree in model.trees]
    rows = rows.select(F.col(label).cast("double").alias("_label"), vector_to_array(model.getFeaturesCol()).alias("_x"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        n, total = 0, np.zeros(len(weights))
        for b in (b for b in batches if b.num_rows):
            x = np.ascontiguousarray(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).T)
            trees = np.stack([np.broadcast_to(apply_tree(root, x), b.num_rows) for root in roots], axis=1)
            err = np.cumsum(trees * weights, axis=1) - b.column(0).to_numpy(zero_copy_only=False)[:, None]
            n, total = n + b.num_rows, total + (err * err).sum(axis=0)
        if n:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([n]), pa.array([total.tolist()])], ["task", "n", "total"])

    parts = rows.mapInArrow(run, "task int, n long, total array<double>").collect()
    if not parts:
        raise ValueError("no row to evaluate the rounds on")
    parts = sorted(parts)
    n = sum(r["n"] for r in parts)
    return [(i + 1, float(v) / n) for i, v in enumerate(sum(np.array(r["total"]) for r in parts))]


def save_forecaster(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_forecaster(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing artefact is a typed error (I4)."""
    local = path[len("file:"):] if path.startswith("file:") else path
    if "://" not in path and not os.path.exists(local):
        raise ModelNotFoundError(f"missing model artefact {path}")
    return PipelineModel.load(path)


def rmse(pred: DataFrame, label: str = "rul") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="predicted_rul", metricName="rmse").evaluate(pred)


# --- L1: pluggable scorer ------------------------------------------------------

Scorer = Callable[[np.ndarray], np.ndarray]


def guarded_score(requests: DataFrame, fn: Scorer, length: int, width: int,
                  window: str = "sensor_window") -> DataFrame:
    """Score windows with any vectorised function [n, L, k] -> [n], guarded (L1).

    Shape and finiteness are checked with column expressions first; only valid
    windows reach ``fn``, batch-wise through Arrow (``mapInPandas``), never one
    row at a time. Output adds ``reason`` (input problem), ``predicted_rul`` and
    ``output_reason`` (non-finite output); no row is dropped.
    """
    ship_package(requests.sparkSession)
    tagged = requests.withColumn("reason", guard_reason(F.col(window), length, width))
    schema = T.StructType(tagged.schema.fields + [
        T.StructField("predicted_rul", T.DoubleType()), T.StructField("output_reason", T.StringType())])

    def run(batches):
        for pdf in batches:
            pred = np.full(len(pdf), np.nan)
            ok = pdf["reason"].isna().to_numpy()
            if ok.any():
                arr = np.stack([np.stack(w) for w in pdf.loc[ok, window]]).astype(np.float64)
                pred[ok] = np.asarray(fn(arr), dtype=np.float64).reshape(-1)
            out = pdf.copy()
            out["predicted_rul"] = np.where(ok, pred, np.nan)
            bad_out = ok & ~np.isfinite(pred)
            out["output_reason"] = np.where(bad_out, "model output contains NaN or inf", None)
            out.loc[~ok, "predicted_rul"] = None
            yield out

    return tagged.mapInPandas(run, schema)


def linear_scorer(spec: FleetSpec) -> Scorer:
    """The given linear forecaster as a numpy function (for the hook and tests)."""
    w = np.array([spec.weight(f) for f in spec.features])

    def fn(x: np.ndarray) -> np.ndarray:
        return spec.bias + x.mean(axis=1) @ w

    return fn
