"""Window semantics: counts, short histories, block splitting, policies."""

from dataclasses import replace

from pyspark.sql import functions as F

from wearline.config import FleetSpec
from wearline.operators import windows as W

SPEC = FleetSpec(name="t", features=("a", "b"), window=30, block=4096)


def history(spark, lives):
    rows = [(e, c, float(c * e), float(c % 3)) for e, n in lives.items() for c in range(1, n + 1)]
    return spark.createDataFrame(rows, "engine_id long, cycle long, a double, b double")


def test_sliding_window_count_and_short_engine(spark):
    lives = {1: 40, 2: 19, 3: 30, 4: 200}
    df = history(spark, lives)
    wins = W.sliding_windows(df, SPEC, target=None)
    assert wins.count() == sum(max(n - 29, 0) for n in lives.values())
    assert wins.filter("engine_id = 2").count() == 0
    r = wins.filter("engine_id = 1 AND cycle = 40").first()
    assert [x["cycle"] for x in r["window"]] == list(range(11, 41))


def test_blocks_and_methods_agree(spark):
    df = history(spark, {1: 300, 2: 75})
    small = replace(SPEC, block=32)
    a = W.window_features(df, SPEC, method="frames").orderBy("engine_id", "cycle").collect()
    for spec, method in ((small, "frames"), (SPEC, "numpy"), (small, "numpy"), (small, "lags"), (SPEC, "sums"), (small, "sums")):
        b = W.window_features(df, spec, method=method).orderBy("engine_id", "cycle").collect()
        assert len(a) == len(b) == (300 - 29) + (75 - 29)
        for x, y in zip(a, b):
            for k in x.asDict():
                assert abs((x[k] or 0) - (y[k] or 0)) <= 1e-9 * max(1.0, abs(x[k] or 0)), (method, k)


def test_last_window_policies(spark):
    df = history(spark, {1: 40, 2: 19})
    skip = W.last_window(df, SPEC, "skip").collect()
    assert [r.engine_id for r in skip] == [1]
    part = {r.engine_id: r for r in W.last_window(df, SPEC, "partial").collect()}
    assert part[2].n_rows == 19 and part[1].n_rows == 30 and part[1].first_cycle == 11
    err = {r.engine_id: r for r in W.last_window(df, SPEC, "error").collect()}
    assert err[2].error == "short history" and err[2].a_mean is None and err[1].error is None


def test_last_rows_without_life_uses_group_limit(spark):
    df = history(spark, {1: 50, 2: 10})
    got = W.last_rows(df, 5).groupBy("engine_id").agg(F.min("cycle").alias("lo")).collect()
    assert {r.engine_id: r.lo for r in got} == {1: 46, 2: 6}
    plan = W.last_rows(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "Window" in plan


def test_running_sums_with_bad_readings_and_levels(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = 1e6 + rng.normal(size=170)
    x[::7] = 1e6
    bad = {40: float("nan"), 41: None, 120: float("inf")}
    rows = [(9, c, bad.get(c, float(x[c - 1])), 0.1) for c in range(1, 171)] + [(8, c, None, 1.0) for c in range(1, 32)]
    spec = replace(SPEC, window=12, block=32)
    df = spark.createDataFrame(rows, "engine_id long, cycle long, a double, b double")
    got = {(r.engine_id, r.cycle): r for r in W.window_features(df, spec, reason=True).collect()}
    assert set(got) == {(9, c) for c in range(12, 171)} | {(8, c) for c in range(12, 32)}
    for (e, c), r in got.items():
        if e == 8 or any(c - 12 < k <= c for k in bad):
            assert r.reason and r.a_mean is None and r.a_std is None and r.a_slope is None and r.b_mean is None and r.a_last is None
            continue
        w, t = x[c - 12:c], np.arange(c - 11, c + 1)
        assert r.reason is None and r.b_std == 0.0 and abs(r.b_mean - 0.1) < 1e-12
        assert abs(r.a_mean - w.mean()) < 1e-8 and abs(r.a_std - w.std()) < 1e-8 and abs(r.a_slope - np.polyfit(t - t.mean(), w - 1e6, 1)[0]) < 1e-9


def test_window_sums_sort_twice_and_are_dealt_by_rows(spark, monkeypatch):
    import contextlib
    import io

    from wearline.config import FleetSpec
    from wearline.operators import windows as W

    spec = FleetSpec(name="t", features=("x",), window=4, weights={"x": 1.0}, block=8)
    rows = spark.range(120).selectExpr("1 + id % 3 AS engine_id", "1 + id DIV 3 AS cycle", "CAST(pmod(id * 7, 11) AS DOUBLE) AS x")
    want = sorted(map(tuple, W.window_features(rows, spec).collect()))
    monkeypatch.setattr(W, "ROWS_PER_TASK", 10)
    got = W.window_features(rows, spec)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 3 * 37
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        W.window_features(rows, spec).explain()
    assert text.getvalue().count("Sort [") == 2 and ", 12), REPARTITION_BY_NUM" in text.getvalue()
