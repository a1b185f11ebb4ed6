"""Validation, quarantine, guards and column audits.

Rules are (name, violation predicate) pairs evaluated in one pass: a single
aggregate counts every rule (``count_if``), and ``quarantine`` tags each row
with the names of the rules it breaks, so bad rows are routed, never dropped
silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.scalar import is_missing

Rule = tuple[str, Column]


def raw_rules(features: Sequence[str]) -> list[Rule]:
    """id >= 1, cycle >= 1, no missing (null or NaN) required value."""
    rules: list[Rule] = [
        ("engine_id_missing", F.col("engine_id").isNull()),
        ("engine_id_below_1", F.col("engine_id") < 1),
        ("cycle_missing", F.col("cycle").isNull()),
        ("cycle_below_1", F.col("cycle") < 1),
    ]
    rules += [(f"{f}_missing", is_missing(F.col(f))) for f in features]
    return rules


def processed_rules(features: Sequence[str], cap: float = C.RUL_CAP) -> list[Rule]:
    """Raw rules plus 0 <= rul <= cap and rul present."""
    return raw_rules(features) + [
        ("rul_missing", is_missing(F.col("rul"))),
        ("rul_out_of_range", (F.col("rul") < 0) | (F.col("rul") > F.lit(float(cap)))),
    ]


def schema_issues(df: DataFrame, expected: dict[str, T.DataType], strict: bool = True) -> list[str]:
    """Driver-side schema comparison: missing / extra columns and type mismatches."""
    have = {f.name: f.dataType for f in df.schema.fields}
    issues = [f"missing column {c}" for c in expected if c not in have]
    issues += [f"type of {c}: {have[c].simpleString()} != {t.simpleString()}"
               for c, t in expected.items() if c in have and have[c] != t]
    if strict:
        issues += [f"extra column {c}" for c in have if c not in expected]
    return issues


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, n_violations) for every rule, from one aggregate pass."""
    counts = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"r{i}") for i, (_, p) in enumerate(rules)])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").cast("bigint").alias("n_violations"))
            for i, (name, _) in enumerate(rules)]
    return counts.select(F.inline(F.array(*rows)))


def quarantine(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Tag rows with ``violations`` = names of broken rules (empty when clean)."""
    tags = F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules])
    return df.withColumn("violations", F.filter(tags, lambda x: x.isNotNull()))


def assert_valid(df: DataFrame, rules: list[Rule]) -> None:
    """Strict mode: raise with the per-rule counts if any rule is broken."""
    bad = [(r["rule"], r["n_violations"]) for r in violation_counts(df, rules).collect() if r["n_violations"]]
    if bad:
        raise ValueError(f"validation failed: {bad}")


def uninformative_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Sample std < 1e-6 OR at most two distinct values.

    "At most two values" is decided exactly without distinct counting: all values
    equal the column's min or max. Two light aggregates replace a
    per-feature distinct count (which Spark plans as an Expand of the rows).
    """
    df = df.select(*[F.when(~is_missing(F.col(f)), F.col(f)).alias(f) for f in features])  # missing values don't count
    mm = df.agg(*[x for f in features for x in (F.min(f).alias(f"{f}__lo"), F.max(f).alias(f"{f}__hi"))]).first()
    aggs = []
    for f in features:
        lo, hi = mm[f"{f}__lo"], mm[f"{f}__hi"]
        inner = F.col(f).isNotNull() & (F.col(f) > F.lit(lo)) & (F.col(f) < F.lit(hi)) if lo is not None else F.lit(False)
        aggs += [F.stddev_samp(f).alias(f"{f}__std"), F.count_if(inner).alias(f"{f}__inner")]
    got = df.agg(*aggs)
    rows = []
    for i, f in enumerate(features):
        std, inner = F.col(f"{f}__std"), F.col(f"{f}__inner")
        few = inner == 0
        flag = F.coalesce(std < F.lit(C.NEAR_CONSTANT_STD), F.lit(False)) | few
        rows.append(F.struct(
            F.lit(f).alias("feature"), F.lit(i + 1).cast("bigint").alias("pos"),
            std.alias("std"), few.alias("at_most_two_values"), flag.alias("uninformative"),
        ))
    return got.select(F.inline(F.array(*rows)))


def scaled_signature(scaled_train: DataFrame, features: Sequence[str]) -> DataFrame:
    """Each standardised train feature: |mean| < 1e-2 and (|std - 1| < 0.1 or std < 1e-6)."""
    aggs = [x for f in features for x in (F.avg(f).alias(f"{f}__m"), F.stddev_samp(f).alias(f"{f}__s"))]
    got = scaled_train.agg(*aggs)
    rows = []
    for i, f in enumerate(features):
        m, s = F.col(f"{f}__m"), F.col(f"{f}__s")
        centred = F.abs(m) < 1e-2
        unit = (F.abs(s - 1.0) < 1e-1) | (s < 1e-6)
        rows.append(F.struct(
            F.lit(f).alias("feature"), F.lit(i + 1).cast("bigint").alias("pos"),
            m.alias("mean"), s.alias("std"), centred.alias("centred"), unit.alias("unit_or_constant"),
            (centred & unit).alias("passed"),
        ))
    return got.select(F.inline(F.array(*rows)))


# --- window guards (B9-B11) --------------------------------------------------

def request_reason(window: Column, engine_id: Column, length: int, width: int) -> Column:
    """Why a scoring request is rejected (null when valid)."""
    rows_ok = F.size(window) == length
    cols_ok = F.forall(window, lambda r: F.size(r) == width)
    return (
        F.when(engine_id.isNull() | (engine_id < 1), F.lit("engine_id must be >= 1"))
        .when(window.isNull() | ~rows_ok, F.format_string(f"sensor_window must have {length} rows, got %d", F.coalesce(F.size(window), F.lit(-1))))
        .when(~cols_ok, F.lit(f"each row of sensor_window must have {width} features"))
    )


def finite_array(window: Column) -> Column:
    """Every value of an array<array<double>> is finite (not null, NaN or inf)."""
    return F.forall(window, lambda r: F.forall(r, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))


def guard_reason(window: Column, length: int, width: int) -> Column:
    """Shape first, then finiteness of the input (B10); null when the window may be scored."""
    shape_ok = (F.size(window) == length) & F.forall(window, lambda r: F.size(r) == width)
    return (
        F.when(window.isNull() | ~shape_ok, F.lit("shape mismatch"))
        .when(~finite_array(window), F.lit("input contains NaN or inf"))
    )


def output_reason(pred: Column) -> Column:
    return F.when(pred.isNull() | F.isnan(pred) | (F.abs(pred) == F.lit(float("inf"))), F.lit("model output contains NaN or inf"))


def window_mean_std(window: Column) -> tuple[Column, Column]:
    """Mean and population std of all values of an array<array<double>>.

    One pass with Welford's update inside a single ``aggregate`` (an outer mean
    captured in a second lambda would be re-evaluated for every element).
    """
    init = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("s"))

    def step(acc, x):
        n = acc["n"] + 1.0
        delta = x - acc["m"]
        m = acc["m"] + delta / n
        return F.struct(n.alias("n"), m.alias("m"), (acc["s"] + delta * (x - m)).alias("s"))

    res = F.aggregate(F.flatten(window), init, step)
    return res["m"], F.sqrt(res["s"] / res["n"])
