"""Windows with bad readings never look healthy; validation and audits treat NaN as missing."""

import math

import pytest

from wearline import config as C
from wearline.functions import scalar as X
from wearline.operators import quality as Q
from wearline.operators import windows as W
from wearline.operators.forecast import forecast_windows


@pytest.mark.parametrize("bad", [float("nan"), None, float("inf"), -float("inf")])
def test_bad_reading_gives_a_reason_and_no_forecast(spark, bad):
    spec = C.LINEITEM_FLEET
    n = spec.window
    rows = [(e, c, *[bad if e == 1 and c == n - 2 and i == 1 else 0.5 for i in range(len(spec.features))], n)
            for e in (1, 2) for c in range(1, n + 1)]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, " + ", ".join(f"{f} double" for f in spec.features) + ", life long")
    win = forecast_windows(W.last_window(df, spec, policy="skip"), spec)
    p = win["predicted_rul"]
    status = X.health_band(p)
    got = {r["engine_id"]: r for r in win.select(
        "engine_id", "reason", "predicted_rul", status.alias("s"), X.life_percent(p).alias("l"), X.confidence(p).alias("c"),
        X.action_for(status).alias("a")).collect()}
    assert got[1]["reason"] == C.BAD_READING and [got[1][k] for k in ("predicted_rul", "s", "l", "c", "a")] == [None] * 5
    assert got[2]["reason"] is None and math.isfinite(got[2]["predicted_rul"]) and got[2]["s"] and got[2]["a"]


def test_nan_breaks_the_raw_rules(spark):
    df = spark.createDataFrame([(1, 1, float("nan")), (2, 2, None), (3, 3, 1.0)], "engine_id long, cycle long, x double")
    assert {r["rule"]: r["n_violations"] for r in Q.violation_counts(df, Q.raw_rules(["x"])).collect()}["x_missing"] == 2


def test_two_values_and_a_nan_are_uninformative(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.0, nan), (2.0, 2.0, nan), (nan, 3.0, nan), (None, nan, None), (1.0, 7.0, nan)],
                               "a double, b double, c double")
    got = {r["feature"]: r["at_most_two_values"] for r in Q.uninformative_features(df, ["a", "b", "c"]).collect()}
    assert got == {"a": True, "b": False, "c": True}
