"""Column functions (JVM-side expressions; no Python per row)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def is_missing(c: Column) -> Column:
    """Null or NaN (``count`` and ``try_cast`` treat the two differently)."""
    return c.isNull() | F.isnan(c)


def not_finite(c: Column) -> Column:
    """Null, NaN or infinite: such a reading must never be scored."""
    return is_missing(c) | (F.abs(c) == F.lit(float("inf")))


def any_not_finite(columns: Iterable[str]) -> Column:
    return reduce(or_, [not_finite(F.col(c).cast("double")) for c in columns], F.lit(False))


def cap_at(c: Column, cap: float) -> Column:
    """min(c, cap) that keeps null and NaN missing (``least`` would return cap)."""
    return F.when(~is_missing(c) & (c > F.lit(cap)), F.lit(float(cap))).otherwise(c)


def clamp_non_negative(c: Column) -> Column:
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def health_band(rul: Column, upper: bool = False) -> Column:
    """>= 80 healthy, >= 40 warning, else critical (title or upper case); null without a forecast.

    Spark orders NaN above all numbers, so a missing forecast must be kept out first.
    """
    names = ("HEALTHY", "WARNING", "CRITICAL") if upper else ("Healthy", "Warning", "Critical")
    return (
        F.when(is_missing(rul), F.lit(None).cast("string"))
        .when(rul >= C.HEALTHY_MIN, F.lit(names[0]))
        .when(rul >= C.WARNING_MIN, F.lit(names[1]))
        .otherwise(F.lit(names[2]))
    )


def life_percent(rul: Column, cap: float = C.RUL_CAP) -> Column:
    pct = rul / F.lit(float(cap)) * F.lit(100.0)
    return F.when(is_missing(rul), F.lit(None).cast("double")).when(pct > 100.0, F.lit(100.0)).otherwise(pct)


def confidence(rul: Column, cap: float = C.RUL_CAP) -> Column:
    """1 - min(|rul| / cap, 1): falls as the forecast rises (kept as specified)."""
    share = F.abs(rul) / F.lit(float(cap))
    return F.when(~is_missing(rul), F.lit(1.0) - F.when(share > 1.0, F.lit(1.0)).otherwise(share))


def action_for(status: Column, upper: bool = False) -> Column:
    """Status -> recommended action (service or dashboard wording)."""
    table = C.DASHBOARD_ACTIONS if upper else C.SERVICE_ACTIONS
    expr = None
    for k, v in table.items():
        expr = (F.when(status == k, F.lit(v)) if expr is None else expr.when(status == k, F.lit(v)))
    return expr


def rul_text(rul: Column) -> Column:
    """RUL printed with 0 decimals, halves to even (as Python's format does)."""
    return F.format_string("%.0f", F.bround(rul, 0))


def maintenance_sentence(
    engine_id: Column, rul: Column, status: Column, action: Column, top: Column | None = None
) -> Column:
    base = F.concat(
        F.lit(C.SUMMARY_PREFIX), engine_id.cast("string"), F.lit(C.SUMMARY_MIDDLE),
        rul_text(rul), F.lit(C.SUMMARY_STATUS), F.upper(status), F.lit(". "), action,
    )
    if top is None:
        return base
    return F.when(top.isNull() | (top == ""), base).otherwise(
        F.concat(base, F.lit(C.SUMMARY_SIGNAL), top, F.lit("."))
    )


def asymmetric_penalty(err: Column) -> Column:
    """exp(-e/13) - 1 for early (e < 0) forecasts, exp(e/10) - 1 otherwise."""
    return F.when(err < 0, F.exp(-err / F.lit(C.EARLY_DIVISOR)) - 1.0).otherwise(
        F.exp(err / F.lit(C.LATE_DIVISOR)) - 1.0
    )


def psi_severity(psi: Column) -> Column:
    return (
        F.when(psi < C.PSI_MODERATE, F.lit("stable"))
        .when(psi <= C.PSI_ALARM, F.lit("moderate"))
        .otherwise(F.lit("significant"))
    )


def floor_share(n: Column, total: Column, eps: float = C.PSI_EPS) -> Column:
    """max(n / max(total, 1), eps)."""
    share = n / F.greatest(total, F.lit(1)).cast("double")
    return F.greatest(share, F.lit(eps))


def sample_hash(engine_id: Column, cycle: Column, seed: int = C.SEED) -> Column:
    """Arithmetic hash shared with the SQL oracle: (id*7919 + cycle*104729 + seed) % 1000003."""
    return (
        engine_id * F.lit(C.HASH_ID) + cycle * F.lit(C.HASH_CYCLE) + F.lit(seed)
    ) % F.lit(C.HASH_MOD)


def round_out(c: Column, bits: int = 20) -> Column:
    """Quantize for presentation to binary steps: 2^-bits below 1e3, 2^-10 below
    1e6, 2^-2 below 1e15; larger, NaN and inf values pass unchanged.

    Engines sum in different orders, so results differ in the last bits. Values
    built from decimal data (prices, averages over n rows) often sit exactly on a
    decimal rounding tie, where such last-bit noise flips a decimal rounding;
    they almost never sit on a binary half-step. Scaling by a power of two is
    exact, so equal inputs quantize equally in any engine. -0.0 becomes 0.0.
    """
    a = F.abs(c)
    scale = (
        F.when(a < 1e3, F.lit(float(2 ** bits)))
        .when(a < 1e6, F.lit(float(2 ** min(bits, 10))))
        .when(a < 1e15, F.lit(4.0))
    )
    r = F.floor(c * scale + F.lit(0.5)).cast("double") / scale
    return F.when(r == 0, F.lit(0.0)).when(r.isNull(), c).otherwise(r)
