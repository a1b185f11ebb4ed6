"""Forecast quality measures and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import asymmetric_penalty, is_missing


def pair_errors(pairs: DataFrame, pred: str = "predicted_rul", actual: str = "actual_rul") -> DataFrame:
    """Signed error (pred - actual) and absolute error."""
    err = F.col(pred) - F.col(actual)
    return pairs.withColumn("error", err).withColumn("abs_error", F.abs(err))


def forecast_metrics(pairs: DataFrame, pred: str = "predicted_rul", actual: str = "actual_rul") -> DataFrame:
    """rmse, mae and asymmetric score of labelled pairs, n = engines with a forecast."""
    err = F.col(pred) - F.col(actual)
    return pairs.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(asymmetric_penalty(err)).alias("score"),
        F.count(pred).cast("bigint").alias("n"),
        F.count(err).cast("bigint").alias("n_labelled"),
    )


def quality_gate(metrics: DataFrame) -> DataFrame:
    """One row per gate: rmse <= 30; score finite and > 0; at least 95 engines."""
    finite = ~F.isnan("score") & (F.abs("score") < F.lit(float("inf")))
    gates = F.array(
        F.struct(F.lit("rmse").alias("gate"), F.col("rmse").alias("value"),
                 F.lit(C.RMSE_GATE).alias("threshold"), F.coalesce(F.col("rmse") <= C.RMSE_GATE, F.lit(False)).alias("passed")),
        F.struct(F.lit("score").alias("gate"), F.col("score").alias("value"),
                 F.lit(0.0).alias("threshold"), F.coalesce(finite & (F.col("score") > 0), F.lit(False)).alias("passed")),
        F.struct(F.lit("engines").alias("gate"), F.col("n").cast("double").alias("value"),
                 F.lit(float(C.MIN_SCORED_ENGINES)).alias("threshold"), (F.col("n") >= C.MIN_SCORED_ENGINES).alias("passed")),
    )
    return metrics.select(F.inline(gates))


def weighted_loss(log: DataFrame, by: str = "step") -> DataFrame:
    """Row-weighted mean of batch losses per ``by``: sum(loss * n) / max(sum(n), 1)."""
    return log.groupBy(by).agg(
        (F.sum(F.col("loss") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("loss"),
        F.sum("n").cast("bigint").alias("n"),
    )


def early_stop_series(losses: DataFrame, patience: int, by: str = "step", value: str = "loss", keys: tuple[str, ...] = ()) -> DataFrame:
    """Best-so-far value, rows since the last strict improvement and the stop flag, per ``keys``.

    Gaps and islands: a strict improvement opens an island, and a row's place in its island is its count
    without improvement. ``stop`` marks the first row whose count reaches ``patience``. Null and NaN
    values improve nothing. Curves of different runs and metrics lie in one log; each is ordered
    by itself, so a task holds single curves, whose rows are the run's iterations.
    """
    curve = Window.partitionBy(*keys).orderBy(by)
    good = F.when(~is_missing(F.col(value)), F.col(value))
    so_far = F.min(good).over(curve.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.min(good).over(curve.rowsBetween(Window.unboundedPreceding, -1))
    d = losses.withColumn("best", so_far).withColumn("improved", F.coalesce(good < before, good.isNotNull() & before.isNull()))
    island = F.sum(F.col("improved").cast("long")).over(curve.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_island", island)
    place = F.row_number().over(Window.partitionBy(*keys, "_island").orderBy(by)).cast("bigint")
    d = d.withColumn("since_improvement", F.when(F.col("_island") > 0, place - 1).otherwise(place))
    reached = F.col("since_improvement") >= patience
    first = F.min(F.when(reached, F.col(by))).over(Window.partitionBy(*keys))
    return d.withColumn("stop", F.coalesce(F.col(by) == first, F.lit(False))).drop("_island")


def early_stop_points(log: DataFrame, patience: int, keys: tuple[str, ...] = ("run_id", "metric")) -> DataFrame:
    """Per curve of a run log: steps, the step that stops it (null: none), and the best step and value up to there."""
    series = early_stop_series(log, patience, value="value", keys=keys)
    ahead = F.max(F.col("stop").cast("int")).over(Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    used = series.withColumn("used", F.coalesce(ahead, F.lit(0)) == 0)
    best = F.max_by(F.struct("step", "best"), F.when(F.col("used") & F.col("improved"), F.col("step")))
    return used.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_steps"), F.min(F.when(F.col("stop"), F.col("step"))).alias("stop_step"),
        best["step"].alias("best_step"), best["best"].alias("best_value"))
