"""Feature statistics, the train-only scaler and standardisation.

Per-feature tables have one row per feature, so their size is bounded by the
feature list, not by the data: they are collected as driver-side constants and
enter the plans as literals (no join at all).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import not_finite

SCALED_META = "wearline.scaled"


def _long(wide: DataFrame, features: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide aggregate row -> one row per feature (feature, pos, fields...)."""
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(i + 1).cast("bigint").alias("pos"),
            *[F.col(f"{f}__{m}").alias(m) for m in fields],
        )
        for i, f in enumerate(features)
    ]
    return wide.select(F.inline(F.array(*rows)))


def finite(feature: str) -> Column:
    """The reading, or null where it is NaN or infinite: one bad reading must not spoil a statistic."""
    return F.when(~not_finite(F.col(feature).cast("double")), F.col(feature))


def scaler_fit(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, pos, mu, sigma): mean and population std on train rows only.

    A constant feature (std within float noise of 0) gets sigma 1, so it scales
    to 0 instead of dividing by zero. Not ``pyspark.ml.StandardScaler``: that
    uses the sample std and gives 0 for a constant column.
    """
    aggs = []
    for f in features:
        aggs += [F.avg(finite(f)).alias(f"{f}__mu"), F.stddev_pop(finite(f)).alias(f"{f}__sd")]
    long = _long(train.agg(*aggs), features, ["mu", "sd"])
    tiny = F.col("sd") <= F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(F.col("mu")))
    sigma = F.when(F.col("sd").isNull() | tiny, F.lit(1.0)).otherwise(F.col("sd"))
    return long.select("feature", "pos", "mu", sigma.alias("sigma"))


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, pos, mean, std, min, max) with the sample std (ddof 1)."""
    aggs = []
    for f in features:
        aggs += [
            F.avg(finite(f)).alias(f"{f}__mean"),
            F.stddev_samp(finite(f)).alias(f"{f}__std"),
            F.min(finite(f)).alias(f"{f}__min"),
            F.max(finite(f)).alias(f"{f}__max"),
        ]
    return _long(df.agg(*aggs), features, ["mean", "std", "min", "max"])


def as_dict(table: DataFrame, key: str = "feature") -> dict[str, dict]:
    """Collect a per-feature table (bounded by the feature count)."""
    return {r[key]: r.asDict() for r in table.collect()}


def is_scaled(df: DataFrame, feature: str) -> bool:
    return bool(df.schema[feature].metadata.get(SCALED_META))


def standardise(df: DataFrame, scaler: dict[str, dict], features: Sequence[str]) -> DataFrame:
    """(x - mu) / sigma with the stored train values; refuses to scale twice (F1)."""
    cols: list[Column] = []
    for c in df.columns:
        if c in features:
            if is_scaled(df, c):
                raise ValueError(f"feature {c!r} is already standardised")
            s = scaler[c]
            z = (F.col(c) - F.lit(float(s["mu"]))) / F.lit(float(s["sigma"]))
            cols.append(z.alias(c, metadata={SCALED_META: True}))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
