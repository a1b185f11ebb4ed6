"""Scalar functions: bands, clamps, text, penalties (edge values from the spec)."""

import math

from pyspark.sql import functions as F

from wearline.functions import scalar as X


def one(spark, expr, value, typ="double"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_health_band_edges(spark):
    got = [one(spark, X.health_band, v) for v in (125.0, 80.0, 79.9, 40.0, 39.9, 0.0)]
    assert got == ["Healthy", "Healthy", "Warning", "Warning", "Critical", "Critical"]
    assert one(spark, lambda c: X.health_band(c, upper=True), 39.9) == "CRITICAL"


def test_cap_keeps_missing(spark):
    assert one(spark, lambda c: X.cap_at(c, 125.0), 200.0) == 125.0
    assert one(spark, lambda c: X.cap_at(c, 125.0), None) is None
    assert math.isnan(one(spark, lambda c: X.cap_at(c, 125.0), float("nan")))


def test_rul_text_rounds_half_to_even(spark):
    assert one(spark, X.rul_text, 2.5) == "2"
    assert one(spark, X.rul_text, 3.5) == "4"
    assert one(spark, X.rul_text, 99.04) == "99"


def test_confidence_and_life_percent(spark):
    assert one(spark, X.confidence, 0.0) == 1.0
    assert one(spark, X.confidence, 250.0) == 0.0
    assert one(spark, X.life_percent, 250.0) == 100.0
    assert abs(one(spark, X.life_percent, 62.5) - 50.0) < 1e-12


def test_asymmetric_penalty_late_worse_than_early(spark):
    late = one(spark, X.asymmetric_penalty, 10.0)
    early = one(spark, X.asymmetric_penalty, -10.0)
    assert late > early > 0
    assert abs(late - (math.exp(1.0) - 1)) < 1e-12
    assert abs(early - (math.exp(10 / 13) - 1)) < 1e-12


def test_severity(spark):
    assert [one(spark, X.psi_severity, v) for v in (0.05, 0.1, 0.2, 0.21)] == [
        "stable", "moderate", "moderate", "significant"]


def test_round_out_is_engine_stable(spark):
    assert one(spark, X.round_out, -1e-18) == 0.0
    assert one(spark, X.round_out, 0.5) == 0.5
    assert one(spark, X.round_out, 123456.789) == round(123456.789 * 1024) / 1024
