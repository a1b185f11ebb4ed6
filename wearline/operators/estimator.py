"""The forecaster as a Spark ML stage: fit, transform, save and load.

``WindowForecaster`` is an ``Estimator`` over window summary features (I2), ``WindowForecasterModel`` its
``Model``. Both can be stages of a ``Pipeline``, are copied with parameters, and are written and read
by Spark ML's own calls on any file system. The model's folder holds the stage's metadata and the fitted
Spark ML regressor below ``regressor/``; no code is pickled.

Boosted trees with a patience are fitted once. The model keeps ``rounds``, the best round by the validation
rows, and predicts with its first ``rounds`` trees, so going back to the best round needs no second fit.

Defined cases: a window with a null, NaN or infinite feature gets no forecast and a ``reason``; a null label is
not learned from; without validation rows all rounds count; no usable training row is an error; a clash of
the output columns or of ``_features`` with the input is an error; equal validation losses choose the earliest round.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BAD_READING
from ..functions.scalar import any_not_finite, is_missing
from ..sources.store import _exists
from .models import ModelNotFoundError, best_round, boosting_curve

KINDS = {"linear": LinearRegressionModel, "gbt": GBTRegressionModel}
VECTOR = "_features"


class _ForecasterParams(HasLabelCol, HasPredictionCol, HasMaxIter, HasSeed):
    featureCols = Param(Params._dummy(), "featureCols", "columns of the window summary features", typeConverter=TypeConverters.toListString)
    kind = Param(Params._dummy(), "kind", "linear or gbt", typeConverter=TypeConverters.toString)
    validationCol = Param(Params._dummy(), "validationCol", "boolean column of the rows that choose the round, empty for none",
                          typeConverter=TypeConverters.toString)
    patience = Param(Params._dummy(), "patience", "rounds without a strict improvement before boosting counts as done",
                     typeConverter=TypeConverters.toInt)
    rounds = Param(Params._dummy(), "rounds", "trees that a boosted model predicts with", typeConverter=TypeConverters.toInt)
    reasonCol = Param(Params._dummy(), "reasonCol", "why a window has no forecast", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(kind="linear", labelCol="rul", predictionCol="predicted_rul", validationCol="", patience=10, maxIter=50,
                         seed=42, reasonCol="reason")

    def _check(self, windows: DataFrame) -> None:
        taken = {VECTOR, self.getOrDefault("predictionCol"), self.getOrDefault("reasonCol")} & set(windows.columns)
        if taken:
            raise ValueError(f"columns {sorted(taken)} are in the input already")
        cols = self.getOrDefault("featureCols")
        missing = [c for c in cols if c not in windows.columns]
        if missing:
            raise ValueError(f"missing feature columns {missing}")

    def _assembled(self, windows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.getOrDefault("featureCols"), outputCol=VECTOR, handleInvalid="keep").transform(windows)


class WindowForecaster(Estimator, _ForecasterParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, featureCols=None, kind="linear", labelCol="rul", predictionCol="predicted_rul", validationCol="",
                 patience=10, maxIter=50, seed=42, reasonCol="reason"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> WindowForecasterModel:
        kind, val, label = (self.getOrDefault(k) for k in ("kind", "validationCol", "labelCol"))
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}")
        self._check(dataset)
        usable = ~any_not_finite(self.getOrDefault("featureCols")) & ~is_missing(F.col(label).cast("double"))
        held = F.coalesce(F.col(val), F.lit(False)) if val else F.lit(False)
        # persisted before they are tested: a test on the features' expressions would compute each several times
        level = StorageLevel.DISK_ONLY if kind == "gbt" else StorageLevel.MEMORY_AND_DISK
        kept = dataset.withColumn("_held", held).select(*dict.fromkeys([*self.getOrDefault("featureCols"), label]), "_held").persist(level)
        rows = self._assembled(kept.filter(usable)).select(VECTOR, label, "_held")
        try:
            train = rows.filter("NOT _held")
            if train.isEmpty():
                raise ValueError("no usable training row")
            common = dict(featuresCol=VECTOR, labelCol=label, predictionCol=self.getOrDefault("predictionCol"), maxIter=self.getOrDefault("maxIter"))
            if kind == "linear":
                return self._copyValues(WindowForecasterModel(LinearRegression(**common, solver="normal").fit(train)))
            fitted = GBTRegressor(**common, maxDepth=4, stepSize=0.2, seed=self.getOrDefault("seed")).fit(train)
            rounds, chosen_by = fitted.getNumTrees, rows.filter("_held")
            if not chosen_by.isEmpty():
                rounds = best_round(boosting_curve(fitted, chosen_by, label), self.getOrDefault("patience"))
            model = self._copyValues(WindowForecasterModel(fitted))
            model._set(rounds=rounds)
            return model
        finally:
            kept.unpersist()


class WindowForecasterModel(Model, _ForecasterParams, MLReadable, MLWritable):
    def __init__(self, regressor=None):
        super().__init__()
        self.regressor = regressor

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pred, cols = self.getOrDefault("predictionCol"), self.getOrDefault("featureCols")
        self._check(dataset)
        rows = self._assembled(dataset)
        bad = any_not_finite(cols)
        if self.getOrDefault("kind") == "gbt" and self.getOrDefault("rounds") < self.regressor.getNumTrees:
            n, out = self.getOrDefault("rounds"), []
            for i, (tree, weight) in enumerate(zip(self.regressor.trees[:n], self.regressor.treeWeights[:n])):
                rows = tree.setFeaturesCol(VECTOR).setPredictionCol(f"_tree_{i}").transform(rows)
                out.append(F.col(f"_tree_{i}") * F.lit(float(weight)))
            rows = rows.withColumn(pred, reduce(add, out)).drop(*[f"_tree_{i}" for i in range(n)])
        else:
            rows = self.regressor.setFeaturesCol(VECTOR).setPredictionCol(pred).transform(rows)
        return rows.drop(VECTOR).withColumns({pred: F.when(~bad, F.col(pred)),
                                              self.getOrDefault("reasonCol"): F.when(bad, F.lit(BAD_READING))})

    def copy(self, extra=None):
        that = super().copy(extra)
        that.regressor = self.regressor.copy()
        return that

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: WindowForecasterModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.regressor.write().save(f"{path}/regressor")


class _ModelReader(MLReader):
    def load(self, path: str) -> WindowForecasterModel:
        if not _exists(self.sparkSession, f"{path}/metadata"):
            raise ModelNotFoundError(f"no saved forecaster at {path}")
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = WindowForecasterModel()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.regressor = KINDS[model.getOrDefault("kind")].load(f"{path}/regressor")
        return model
