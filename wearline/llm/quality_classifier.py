"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

1. Statistics: length, word, line, symbol, case and stop-word measures of the whole text
   (built-in functions), written once; means and deviations come from all documents.
2. Random Fourier features of the standardised statistics approximate a Gaussian kernel.
3. Fit: each partition of the labelled rows sums its normal equations; the sums (a
   ``FEATURES`` x ``FEATURES`` matrix per partition, at most ``PARTITIONS``) meet on the driver and give the
   ridge weights. Labelled rows are a hashed sample of about ``TRAIN_ROWS`` where there are more.
4. Calibration: a fifth of the labelled rows isn't fitted on; pooling adjacent violators
   on their raw scores gives a monotone map to probabilities.

Defined cases: null and empty texts have all counts 0 and are scored like any other; without
labels of both classes every score is the share of label 1 (0.5 without labels); null labels and
null ids aren't learned from; repeated rows are scored alike; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import documents, python_ready, written
from .quality_rules import measures

STATISTICS = 9
FEATURES = 256
RIDGE = 1e-3
TRAIN_ROWS = 20_000
PARTITIONS = 16
FOLDS, HELD_OUT = 3, 1


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (a hash of the id) and x, the array of statistics."""
    m = measures(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "text")

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.col(f"m.{a}") / F.greatest(F.col(f"m.{b}"), F.lit(1)), F.lit(0.0))

    x = [F.log1p("m.n_words"), share("word_chars", "n_words"), F.log1p(share("n_symbols", "n_words")), share("n_dup_lines", "n_lines"),
         share("n_repeat_words", "n_words"), share("n_upper", "n_letters"), share("n_stop_words", "n_words"),
         F.log1p(share("n_words", "n_lines")), share("n_letters", "word_chars")]
    return m.select("doc_id", F.array(*[c.cast("double") for c in x]).alias("x"))


class Kernel:
    """Standardisation and random Fourier features."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = mean, np.where(sd > 0, sd, 1.0)
        self.w = rng.normal(0, len(mean) ** -0.5, (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def features(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2 / FEATURES) * np.cos(np.clip((x - self.mean) / self.sd, -8, 8) @ self.w + self.b)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _equations(kernel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((FEATURES + 1, FEATURES + 2))
        for b in batches:
            if b.num_rows:
                z = np.column_stack([kernel.value.features(_matrix(b.column(0))), np.ones(b.num_rows)])
                a += z.T @ np.column_stack([z, b.column(1).to_numpy()])
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary())], ["sums"])

    return run


def _scorer(kernel, weights, knots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                raw = kernel.value.features(_matrix(b.column(2))) @ weights[:-1] + weights[-1]
                score = raw if knots is None else np.interp(raw, *knots)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score)], ["doc_id", "held_out", "score"])

    return run


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots (mean raw score, share of label 1) of the blocks."""
    blocks: list[list[float]] = []  # weight, sum of scores, sum of labels
    for s, v in sorted(zip(score.tolist(), y.tolist(), strict=True)):
        blocks.append([1.0, s, v])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            w, s2, v2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + s2, blocks[-1][2] + v2]
    return np.array([b[1] / b[0] for b in blocks]), np.array([b[2] / b[0] for b in blocks])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    python_ready(spark)
    stats = written(statistics(docs, id_col, text_col), "statistics")
    n = STATISTICS
    moments = stats.agg(*[f(F.col("x")[i]) for i in range(n) for f in (F.mean, F.stddev_pop)]).first()
    mean = np.array([moments[2 * i] or 0.0 for i in range(n)])
    kernel = spark.sparkContext.broadcast(Kernel(mean, np.array([moments[2 * i + 1] or 0.0 for i in range(n)])))
    given = labels.select(F.col("doc_id").alias("k"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1)")
    given = given.filter(F.crc32(F.col("k").cast("string")) % FOLDS != HELD_OUT)
    total = given.count()
    h = F.pmod(F.xxhash64("k"), F.lit(1 << 20))
    if total > TRAIN_ROWS:
        given = given.filter(h < int((1 << 20) * TRAIN_ROWS / total))
    train = written(stats.join(given, stats["doc_id"] == given["k"]).select(
        "x", F.col("y").cast("double").alias("y"), (F.pmod(F.xxhash64("k", F.lit(2)), F.lit(5)) == 0).alias("calibrate")), "labelled")
    n1, n_all = train.agg(F.sum("y"), F.count(F.lit(1))).first()
    share = (n1 / n_all) if n_all else 0.5
    weights, knots = np.append(np.zeros(FEATURES), share), None
    if n_all and 0 < share < 1:
        fit = train.filter(~F.col("calibrate")).select("x", "y").coalesce(PARTITIONS).mapInArrow(_equations(kernel), "sums binary")
        a = sum(np.frombuffer(r["sums"]).reshape(FEATURES + 1, FEATURES + 2) for r in fit.collect())
        weights = np.linalg.solve(a[:, :-1] + RIDGE * max(1.0, a[-1, -2]) / FEATURES * np.eye(FEATURES + 1), a[:, -1])
        held = train.filter("calibrate").select("x", "y").limit(TRAIN_ROWS).collect()
        if held and 0 < sum(r["y"] for r in held) < len(held):
            raw = kernel.value.features(np.array([r["x"] for r in held])) @ weights[:-1] + weights[-1]
            knots = isotonic(raw, np.array([r["y"] for r in held]))
    rows = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "x")
    types = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "x")
    out = rows.mapInArrow(_scorer(kernel, weights, knots), f"{types}, score double")
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score"))
    return out.withColumn("score", score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir, "doc_id", "text"), read_table(spark, sf_dir, "labels", "doc_id", "quality"))
