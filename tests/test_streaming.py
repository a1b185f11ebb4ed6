"""Stream result = batch result: out-of-order and repeated delivery (K1, K6)."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wearline.config import FleetSpec
from wearline.streaming import scoring as ST

SPEC = FleetSpec(name="s", features=("value", "k", "hour", "is_error"), window=5,
                 weights={"value": 1.0, "k": 0.5}, bias=3.0)


def write_events(tmp_path, n_users=3, n_events=40, chunks=4, repeat=False):
    rng = np.random.default_rng(5)
    base = pd.Timestamp("2024-01-01")
    rows = []
    for i in range(n_events * n_users):
        rows.append({"event_id": i, "ts": base + pd.Timedelta(minutes=int(i * 3 + rng.integers(0, 2))),
                     "user_id": i % n_users, "event_type": "error" if i % 7 == 0 else "view",
                     "value": float(rng.normal()), "props": f'{{"k": {int(rng.integers(0, 99))}}}'})
    df = pd.DataFrame(rows)
    d = tmp_path / "stream_in"
    d.mkdir()
    # deliver newest chunk first: readings arrive out of order across micro-batches
    parts = np.array_split(df, chunks)[::-1]
    if repeat:
        parts = parts + parts[:1]
    for j, p in enumerate(parts):
        p.to_parquet(d / f"events_{j:03d}.parquet", index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    return str(d), df


def test_stream_scoring_equals_batch_last_window(spark, tmp_path):
    path, df = write_events(tmp_path)
    scaler = {f: {"mu": 0.0, "sigma": 1.0} for f in SPEC.features}
    stream = spark.readStream.schema(ST.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    scored = ST.score_stream(ST.standardise_stream(ST.readings(stream), scaler, SPEC.features), SPEC)
    out = ST.run_available(scored, "test-scoring")
    got = spark.read.parquet(out).groupBy("engine_id").agg(
        F.max_by("predicted_rul", "n_seen").alias("p"), F.max("n_seen").alias("n"))
    got = {r.engine_id: (r.n, r.p) for r in got.collect()}
    df = df.sort_values(["ts", "event_id"])
    for u, g in df.groupby("user_id"):
        last = g.tail(SPEC.window)
        k = last["props"].str.extract(r"(\d+)")[0].astype(float)
        want = SPEC.bias + last["value"].mean() * 1.0 + k.mean() * 0.5
        n, p = got[u + 1]
        assert n == len(g)
        assert abs(p - want) < 1e-9


def test_stream_drops_repeated_deliveries(spark, tmp_path):
    path, df = write_events(tmp_path, repeat=True)
    stream = spark.readStream.schema(ST.EVENTS_SCHEMA).parquet(path)
    out = ST.run_available(ST.drop_repeats(ST.readings(stream), watermark="3 days"), "test-dedup")
    assert spark.read.parquet(out).count() == len(df)


def test_repeats_and_bad_readings_through_the_scoring_state(spark, tmp_path):
    path, df = write_events(tmp_path, repeat=True)
    bad = df["user_id"].eq(1) & df["event_id"].eq(df.loc[df["user_id"].eq(1), "event_id"].max())
    extra = df[bad].assign(event_id=10_000, value=float("nan"))
    extra.to_parquet(f"{path}/events_900.parquet", index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    scaler = {f: {"mu": 0.0, "sigma": 1.0} for f in SPEC.features}
    stream = spark.readStream.schema(ST.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    out = ST.run_available(ST.score_stream(ST.standardise_stream(ST.readings(stream), scaler, SPEC.features), SPEC), "test-repeats")
    got = {}
    for r in spark.read.parquet(out).orderBy("n_seen").collect():
        got[r.engine_id] = r.predicted_rul
    for u, g in df.sort_values(["ts", "event_id"]).groupby("user_id"):
        last = g.tail(SPEC.window)
        k = last["props"].str.extract(r"(\d+)")[0].astype(float)
        if u == 1:
            assert got[u + 1] is None
        else:
            assert abs(got[u + 1] - (SPEC.bias + last["value"].mean() + k.mean() * 0.5)) < 1e-9


def test_event_stream_reads_a_folder_of_part_files(spark, tmp_path):
    import shutil

    path, df = write_events(tmp_path)
    shutil.copytree(path, tmp_path / "sf" / "events.parquet")
    out = ST.run_available(ST.readings(ST.event_stream(spark, str(tmp_path / "sf"), max_files=1)), "test-folder")
    assert spark.read.parquet(out).count() == len(df)


def test_quarantine_epochs_overwrite(spark, tmp_path):
    rules = [("value_missing", F.col("value").isNull() | F.isnan("value"))]
    write = ST.quarantine_to(rules, str(tmp_path / "good"), str(tmp_path / "bad"))
    batch = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "engine_id long, value double")
    for epoch in (0, 1, 1):  # the last batch is retried
        write(batch, epoch)
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 4


def test_a_retried_drift_batch_counts_once(spark, tmp_path):
    ref = {"value": {"edges": [0.0, 1.0], "ref_pct": [1.0]}}  # fewer than 2 shares: psi 0
    write = ST.drift_to(ref, ["value"], str(tmp_path / "drift"), 0.2)
    batch = spark.createDataFrame([(1.0,), (2.0,)], "value double")
    for epoch in (0, 1, 1):
        write(batch, epoch)
    got = spark.read.parquet(f"{tmp_path}/drift/batch-*").collect()
    assert sorted((r["epoch"], r["feature"], r["psi"], r["alarm"]) for r in got) == [(0, "value", 0.0, False), (1, "value", 0.0, False)]


class _State:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_engines_share_a_state_row_and_keep_their_own_windows():
    rng, state, step = np.random.default_rng(2), _State(), ST._window_step(SPEC, {f: {"min": -1.0, "max": 1.0} for f in SPEC.features})
    rows = pd.DataFrame({"engine_id": rng.integers(1, 9, 160), "ts_us": rng.integers(0, 60, 160), "event_id": rng.integers(0, 3, 160)})
    for f in SPEC.features:
        rows[f] = rows["ts_us"] * 0.05 + rows["event_id"] - 1.5 + rows["engine_id"] * 0.01
    rows.loc[rows["engine_id"] == 5, "value"] = np.nan
    got = {}
    rows = rows.drop_duplicates(["engine_id", "ts_us", "event_id"])
    for part in np.array_split(rows, 4):  # two chunks a micro-batch, out of order, every reading twice
        for out in step((0,), (pd.concat([x, x]) for x in np.array_split(part, 2)), state):
            got.update({int(r["engine_id"]): r for r in out.to_dict("records")})
    once = rows.sort_values(["engine_id", "ts_us", "event_id"])
    for e, g in once.groupby("engine_id"):
        last, r = g.tail(SPEC.window), got.get(e)
        assert r["n_seen"] == len(g) and r["last_ts_us"] == last["ts_us"].iloc[-1]
        want = SPEC.bias + last["value"].mean() + 0.5 * last["k"].mean()
        assert pd.isna(r["predicted_rul"]) if e == 5 else abs(r["predicted_rul"] - want) < 1e-9
        assert r["any_flag"] == any(abs(last[f].iloc[-1]) > 1 for f in SPEC.features)
    assert len(state.get[0]) == 8 * len(got) * SPEC.window  # eight bytes a reading held
