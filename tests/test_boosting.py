"""Boosting over binned blocks: the trees of Spark ML's GBTRegressor, its thresholds, errors and saved form; curves by columns."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from wearline.operators import boosting as B
from wearline.operators import models as ML

COLS = [f"f{i}" for i in range(5)]


def table(spark, n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, 5)), 2)
    x[:, 3], x[:, 4] = 1.5, np.maximum(x[:, 4], 0)  # a constant, and one with many zeros
    y = np.minimum(np.round(10 * x[:, 0] + 5 * x[:, 1] ** 2 + 40 + rng.normal(size=n)), 50)
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{c} double" for c in [*COLS, "rul"])).repartition(3)


def estimator(rounds):
    return GBTRegressor(featuresCol="features", labelCol="rul", predictionCol="p", maxIter=rounds, maxDepth=4, seed=42, stepSize=0.2)


@pytest.mark.parametrize("n", [12_500, 90])  # more rows than the thresholds' sample, and few
def test_the_same_trees_as_spark_ml(spark, n, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 700)
    rows, est = table(spark, n).persist(), estimator(6)
    given = VectorAssembler(inputCols=COLS, outputCol="features").transform(rows)
    want, got = est.fit(given), B.fit_boosted(est, rows, COLS)
    assert got.getNumTrees == 6 and got.getMaxIter() == 6 and got.numFeatures == 5 and got.uid == est.uid
    assert want.treeWeights == got.treeWeights and want.totalNumNodes == got.totalNumNodes
    both = got.transform(want.transform(given).withColumnRenamed("p", "want"))
    assert both.filter(F.abs(F.col("p") - F.col("want")) > 1e-9).isEmpty()
    root = [m.trees[1]._java_obj.rootNode() for m in (want, got)]
    assert np.isclose(root[0].gain(), root[1].gain()) and np.allclose(list(root[0].impurityStats().stats()), list(root[1].impurityStats().stats()))

    def leaves(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return [[node.impurityStats().count(), node.impurity() * node.impurityStats().count()]]
        return leaves(node.leftChild()) + leaves(node.rightChild())

    a, b = (np.sum(leaves(r), axis=0) for r in root)  # what is left in the leaves
    assert np.allclose(a, b, rtol=1e-6)
    got.save(str(tmp_path / "m"))
    assert GBTRegressionModel.load(str(tmp_path / "m")).toDebugString == got.toDebugString
    rows.unpersist()


def test_a_forecaster_is_grown_from_blocks(spark, monkeypatch):
    """The rows that boosting holds are blocks of a byte or so a feature; Spark ML held them one by one."""
    sizes, blocks = [], B._blocks
    monkeypatch.setattr(B, "_blocks", lambda *a: sizes.append(blocks(*a).map(lambda b: (len(b[1]), b[0].nbytes)).collect()) or blocks(*a))
    from wearline.config import FleetSpec

    spec = FleetSpec(name="t", features=("a",), window=3)
    wins = table(spark, 400).select(*[F.col(f"f{i}").alias(c) for i, c in enumerate(("a_last", "a_mean", "a_std", "a_slope"))], "rul",
                                    (F.col("f4") > 1).alias("is_val"))
    model = ML.fit_forecaster(wins, spec, kind="gbt", max_iter=3, patience=2)
    assert 1 <= model.stages[-1].getNumTrees <= 3 and len(sizes) == 1
    assert sum(n for n, _ in sizes[0]) == wins.filter("NOT is_val").count()
    assert all(held <= 4 * n for n, held in sizes[0])


def test_edges(spark):
    rows, est = table(spark, 60), estimator(3)
    with pytest.raises(ValueError, match="no row"):
        B.fit_boosted(est, rows.limit(0), COLS)
    with pytest.raises(ValueError, match="null or not finite"):
        B.fit_boosted(est, rows.withColumn("rul", F.when(F.col("f0") < 0, F.col("rul"))), COLS)
    same = B.fit_boosted(est, rows.withColumn("rul", F.lit(7.0)), COLS)  # nothing to split
    assert same.totalNumNodes == 3 and same.trees[0]._java_obj.rootNode().prediction() == 7.0
    flat = B.fit_boosted(est, rows.select(*[F.lit(1.0).alias(c) for c in COLS], "rul"), COLS)  # nothing to split by
    assert flat.totalNumNodes == 3
    assert B._cuts(np.array([1.0, 1.0, 2.0, 0.0]), 4.0, 31).tolist() == [0.5, 1.5]


def test_curve_applies_trees_to_columns(spark):
    rows = table(spark, 300).withColumn("kind", F.concat(F.lit("k"), F.floor(F.col("f1") * 2) % 4))
    rows = StringIndexer(inputCol="kind", outputCol="k").fit(rows).transform(rows)
    given = VectorAssembler(inputCols=["f0", "k", "f4"], outputCol="features").transform(rows).persist()
    model = estimator(5).fit(given)  # k is a category
    x = np.array([r[0].toArray() for r in given.select("features").collect()]).T
    for tree in model.trees:
        want = [tree.predict(r[0]) for r in given.select("features").collect()]
        assert np.allclose(np.broadcast_to(ML.apply_tree(ML.tree_nodes(tree._java_obj.rootNode()), x), x.shape[1]), want)
    got = ML.boosting_curve(model, given, "rul")
    assert np.allclose([v for _, v in got], model.evaluateEachIteration(given, "squared"), rtol=1e-9)
    given.unpersist()
