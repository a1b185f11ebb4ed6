"""Remaining-life forecasts for windows.

The given linear forecaster is a column expression (bias + sum of weights times
the window mean of each standardised feature), so batch scoring stays in
whole-stage codegen and is checkable by SQL. Fitted Spark ML models live in
``operators/models.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FleetSpec
from ..functions.scalar import clamp_non_negative


def linear_forecast(spec: FleetSpec, suffix: str = "_mean") -> Column:
    expr = F.lit(float(spec.bias))
    for f in spec.features:
        w = spec.weight(f)
        if w:
            expr = expr + F.lit(w) * F.col(f"{f}{suffix}")
    return expr


def forecast_windows(means: DataFrame, spec: FleetSpec, clamp: bool = False, out: str = "predicted_rul") -> DataFrame:
    """Score rows holding ``<f>_mean`` window means; ``clamp`` = dashboard variant.

    Windows with a ``reason`` not to be scored get a null forecast (B10).
    """
    pred = linear_forecast(spec)
    if "reason" in means.columns:
        pred = F.when(F.col("reason").isNull(), pred)
    return means.withColumn(out, clamp_non_negative(pred) if clamp else pred)
