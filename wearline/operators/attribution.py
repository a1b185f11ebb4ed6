"""Attribution and signal ranking.

The forecaster is linear in the window readings: rul = b + sum over steps t and
features f of (w_f / L) * x[t, f]. Its exact additive attribution against a
background set is phi[t, f] = (w_f / L) * (x[t, f] - E_bg[x[t, f]]). The
background expectation per (step, feature) has L x features entries, so it is
collected and enters the plans as literal arrays indexed by step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import FleetSpec
from ..functions.scalar import sample_hash


def background_ends(train_rows: DataFrame, spec: FleetSpec, n: int = C.BACKGROUND_SAMPLES) -> DataFrame:
    """n full train windows (engine_id, end_cycle), seeded, without replacement.

    Every cycle >= L ends one full window. Ordering by an arithmetic hash gives a
    reproducible sample; ``orderBy().limit(n)`` runs as a per-task top-n then a
    merge, so no task holds more than n candidates.
    """
    cands = train_rows.filter(F.col("cycle") >= spec.window).select(
        "engine_id",
        F.col("cycle").alias("end_cycle"),
        sample_hash(F.col("engine_id"), F.col("cycle"), spec.seed).alias("h"),
    )
    return cands.orderBy("h", "engine_id", "end_cycle").limit(n).select("engine_id", "end_cycle")


def rows_of_windows(rows: DataFrame, ends: DataFrame, spec: FleetSpec) -> DataFrame:
    """Readings of the windows ending at ``ends`` (a sample of at most n rows,
    hence broadcast), with ``step`` = 1..L inside the window."""
    e = ends.select(F.col("engine_id").alias("_e"), F.col("end_cycle").alias("_end"))
    j = rows.join(
        F.broadcast(e),
        (rows["engine_id"] == F.col("_e"))
        & rows["cycle"].between(F.col("_end") - (spec.window - 1), F.col("_end")),
    )
    step = (F.col("cycle") - F.col("_end") + F.lit(spec.window)).cast("int")
    return j.withColumn("step", step).withColumnRenamed("_end", "end_cycle").drop("_e")


def step_means(window_rows: DataFrame, spec: FleetSpec) -> dict[str, list[float]]:
    """E_bg[x[t, f]]: feature -> list of L means (step order). Bounded by L x features."""
    got = window_rows.groupBy("step").agg(*[F.avg(f).alias(f) for f in spec.features]).collect()
    by_step = {int(r["step"]): r for r in got}
    out = {}
    for f in spec.features:
        out[f] = [float(by_step[t][f]) if t in by_step and by_step[t][f] is not None else 0.0
                  for t in range(1, spec.window + 1)]
    return out


def _phi(spec: FleetSpec, means: dict[str, list[float]], f: str) -> Column:
    mu = F.element_at(F.array(*[F.lit(v) for v in means[f]]), F.col("step"))
    return F.lit(spec.weight(f) / spec.window) * (F.col(f) - mu)


def importance_baseline(window_rows: DataFrame, spec: FleetSpec, means: dict[str, list[float]]) -> DataFrame:
    """Mean |phi| over background windows and steps, normalised to sum 1."""
    raw = window_rows.agg(*[F.avg(F.abs(_phi(spec, means, f))).alias(f) for f in spec.features])
    total = sum((F.col(f) for f in spec.features), F.lit(0.0))
    denom = F.greatest(total, F.lit(C.ATTRIBUTION_FLOOR))
    rows = [
        F.struct(F.lit(f).alias("feature"), F.lit(i + 1).cast("bigint").alias("pos"),
                 (F.col(f) / denom).alias("importance"))
        for i, f in enumerate(spec.features)
    ]
    return raw.select(F.inline(F.array(*rows)))


def wide_attribution(window_rows: DataFrame, spec: FleetSpec, means: dict[str, list[float]]) -> DataFrame:
    """Per window (engine_id): mean |phi| over steps, normalised per window, a column a feature."""
    per = window_rows.groupBy("engine_id").agg(
        *[F.avg(F.abs(_phi(spec, means, f))).alias(f) for f in spec.features]
    )
    total = sum((F.col(f) for f in spec.features), F.lit(0.0))
    denom = F.greatest(total, F.lit(C.ATTRIBUTION_FLOOR))
    return per.select("engine_id", *[(F.col(f) / denom).alias(f) for f in spec.features])


def window_attribution(window_rows: DataFrame, spec: FleetSpec, means: dict[str, list[float]]) -> DataFrame:
    """``wide_attribution`` as rows: engine_id, feature, pos, attribution."""
    wide = wide_attribution(window_rows, spec, means)
    return long_scores(wide, spec, {f: F.col(f) for f in spec.features}, name="attribution")


def warning_score_columns(spec: FleetSpec, stats: dict, importance: dict, prefix: str = "") -> dict[str, Column]:
    """score_f = |x_f - mean_f| / std_f (std <= 1e-6 counts as 1) * importance_f (G1)."""
    out = {}
    for f in spec.features:
        s = stats[f]
        std = s["std"]
        std = float(std) if std is not None and std > C.SCALE_STD_FLOOR else 1.0
        dev = F.abs(F.col(prefix + f) - F.lit(float(s["mean"]))) / F.lit(std)
        out[f] = dev * F.lit(float(importance.get(f, 0.0)))
    return out


def long_scores(df: DataFrame, spec: FleetSpec, scores: dict[str, Column], name: str = "score") -> DataFrame:
    """Wide per-feature score columns -> (engine_id, feature, pos, score) rows."""
    rows = [
        F.struct(F.lit(f).alias("feature"), F.lit(i + 1).cast("bigint").alias("pos"), scores[f].alias(name))
        for i, f in enumerate(spec.features)
    ]
    return df.select("engine_id", F.inline(F.array(*rows)))


def ranked_features(spec: FleetSpec, scores: dict[str, Column], name: str = "score") -> Column:
    """All features of a row by falling score, ties in feature order: array of (rank, feature, pos, score).

    Sorted within the row, so ranking needs no shuffle. NaN scores come first and nulls last, as in a descending sort.
    """
    items = [F.struct(scores[f].alias("s"), F.lit(-(i + 1)).alias("p"), F.lit(f).alias("f")) for i, f in enumerate(spec.features)]
    return F.transform(F.sort_array(F.array(*items), asc=False), lambda x, i: F.struct(
        (i + 1).cast("bigint").alias("rank"), x["f"].alias("feature"), (-x["p"]).cast("bigint").alias("pos"), x["s"].alias(name)))


def top_feature(spec: FleetSpec, scores: dict[str, Column]) -> Column:
    """Feature with the highest score; ties go to the earlier feature.

    ``array_max`` over struct(score, -pos, name) compares score first, then the
    negated position, without any shuffle.
    """
    items = [
        F.struct(scores[f].alias("s"), F.lit(-(i + 1)).alias("p"), F.lit(f).alias("f"))
        for i, f in enumerate(spec.features)
    ]
    return F.array_max(F.array(*items))["f"]


def display_name(spec: FleetSpec, feature: Column) -> Column:
    """Display-name lookup that falls back to the raw name."""
    if not spec.display:
        return feature
    m = F.create_map(*[x for k, v in spec.display.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[feature], feature)
