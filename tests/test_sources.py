"""File round trips on written fixtures (text, truth, sidecars, JSON, requests)."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from wearline.config import RAW_COLUMNS
from wearline.operators import quality as Q
from wearline.sources import artefacts as AR
from wearline.sources import telemetry as TX


def write_raw(path, engines, cycles, trailing_nan=True, width=26):
    with open(path, "w") as fh:
        for e in range(1, engines + 1):
            for c in range(1, cycles + 1):
                vals = [str(e), str(c)] + [f"{(e * 31 + c * 7 + i) % 97 / 7:.4f}" for i in range(width - 2)]
                line = " ".join(vals)
                if trailing_nan:
                    line += " NaN NaN"
                fh.write(line + " \n")


def test_telemetry_text_drops_trailing_nan_columns(spark, tmp_path):
    p = str(tmp_path / "train.txt")
    write_raw(p, 2, 40)
    df = TX.read_telemetry_text(spark, p)
    assert df.columns == ["source", *RAW_COLUMNS]
    assert df.count() == 80
    assert dict(df.dtypes)["engine_id"] == "bigint" and dict(df.dtypes)["sensor_21"] == "double"
    counts = {r.rule: r.n_violations for r in Q.violation_counts(df, Q.raw_rules(RAW_COLUMNS[2:])).collect()}
    assert sum(counts.values()) == 0


def test_telemetry_text_wrong_width_fails(spark, tmp_path):
    p = str(tmp_path / "bad.txt")
    write_raw(p, 1, 5, width=25)
    with pytest.raises(TX.DataLoadError):
        TX.read_telemetry_text(spark, p)


def test_truth_is_positional(spark, tmp_path):
    p = str(tmp_path / "RUL.txt")
    with open(p, "w") as fh:
        fh.write("112\n98\n\n69\n")
    got = [(r.engine_id, r.final_rul) for r in TX.read_truth_text(spark, p).orderBy("engine_id").collect()]
    assert got == [(1, 112.0), (2, 98.0), (3, 69.0)]


def test_checksum_manifest_statuses(spark, tmp_path):
    files = {}
    for name, body in (("a.txt", b"alpha\n"), ("b.txt", b"beta\n"), ("c.txt", b"gamma\n")):
        p = tmp_path / name
        p.write_bytes(body)
        files[name] = str(p)
    (tmp_path / "a.txt.sha256").write_text(hashlib.sha256(b"alpha\n").hexdigest() + "  a.txt\n")
    (tmp_path / "b.txt.sha256").write_text("0" * 64 + "\n")
    got = {os.path.basename(r.path): r.status for r in TX.checksum_manifest(spark, list(files.values())).collect()}
    assert got == {"a.txt": "ok", "b.txt": "mismatch", "c.txt": "missing"}
    with pytest.raises(TX.ChecksumError):
        TX.verify_checksums(spark, [files["a.txt"], files["b.txt"]])
    with pytest.raises(TX.DataLoadError):
        TX.verify_checksums(spark, [files["c.txt"]])


def test_stats_roundtrip_and_object_form(spark, tmp_path):
    stats = spark.createDataFrame([("f1", 0.0, 1.0, -2.0, 2.0), ("f2", 1.0, 0.5, 0.0, 3.0)], AR.STATS_SCHEMA)
    AR.write_stats(stats, str(tmp_path / "stats"))
    back = AR.read_stats(spark, str(tmp_path / "stats"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, stats.collect()))
    obj = tmp_path / "stats.json"
    obj.write_text(json.dumps({"f1": {"mean": 0.0, "std": 1.0, "min": -2.0, "max": 2.0}}))
    o = AR.read_stats_object(spark, str(obj)).first()
    assert o.feature == "f1" and o["max"] == 2.0


def test_report_roundtrip_and_nested_reader(spark, tmp_path):
    per = spark.createDataFrame([(1, 99.0, 112.0, 13.0), (2, 40.0, 38.0, 2.0)], AR.REPORT_ROW_SCHEMA)
    met = spark.createDataFrame([(7.0, 7.5, 3.1, 2)], "rmse double, mae double, nasa_score double, test_set_size long")
    AR.write_report(met, per, str(tmp_path / "rep"))
    m, rows = AR.read_report(spark, str(tmp_path / "rep"))
    assert m.first()["test_set_size"] == 2 and rows.count() == 2
    doc = {"rmse": 1.0, "mae": 1.0, "nasa_score": 1.0, "test_set_size": 1,
           "per_engine_predictions": [{"engine_id": 1, "predicted_rul": 5.0, "actual_rul": 6.0, "abs_error": 1.0}]}
    (tmp_path / "results.json").write_text(json.dumps(doc, indent=2))
    m2, rows2 = AR.read_nested_report(spark, str(tmp_path / "results.json"))
    assert rows2.first()["actual_rul"] == 6.0 and m2.first()["rmse"] == 1.0


def test_requests_validation_and_guard(spark, tmp_path):
    good = [[0.0] * 17 for _ in range(30)]
    reqs = [
        {"engine_id": 1, "sensor_window": good},
        {"engine_id": 2, "sensor_window": good[:29]},
        {"engine_id": 3, "sensor_window": [r[:16] for r in good]},
        {"engine_id": 0, "sensor_window": good},
    ]
    p = tmp_path / "req.json"
    p.write_text("\n".join(json.dumps(r) for r in reqs))
    df = AR.read_requests(spark, str(p))
    reasons = {r.engine_id: r.reason for r in df.select(
        "engine_id", Q.request_reason(F.col("sensor_window"), F.col("engine_id"), 30, 17).alias("reason")).collect()}
    assert reasons[1] is None
    assert reasons[2] == "sensor_window must have 30 rows, got 29"
    assert reasons[3] == "each row of sensor_window must have 17 features"
    assert reasons[0] == "engine_id must be >= 1"
    nan_win = spark.createDataFrame([([[1.0, float("nan")], [1.0, 2.0]],), ([[1.0, 2.0, 3.0], [1.0, 2.0, 3.0]],)],
                                    "w array<array<double>>")
    got = [r.g for r in nan_win.select(Q.guard_reason(F.col("w"), 2, 2).alias("g")).collect()]
    assert got == ["input contains NaN or inf", "shape mismatch"]


def test_run_log_append(spark, tmp_path):
    p = str(tmp_path / "runs")
    AR.append_run_log(spark, [("r1", 1, "val_loss", 3.0)], p)
    AR.append_run_log(spark, [("r1", 2, "val_loss", 2.0)], p)
    assert AR.read_run_log(spark, p).count() == 2


def test_short_rows_pad_with_null_and_fail_validation(spark, tmp_path):
    p = str(tmp_path / "short.txt")
    write_raw(p, 1, 3, trailing_nan=False)
    with open(p, "a") as fh:
        fh.write("1 4 0.5\n")
    df = TX.read_telemetry_text(spark, p)
    counts = {r.rule: r.n_violations for r in Q.violation_counts(df, Q.raw_rules(RAW_COLUMNS[2:])).collect()}
    assert counts["sensor_21_missing"] == 1 and counts["cycle_missing"] == 0


def test_changed_source_or_spec_gives_a_new_table(spark, tmp_path):
    from wearline.sources.store import written_path

    folder = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(folder)
    built = []

    def path(spec):
        def build():
            built.append(spec)
            return spark.read.parquet(folder)

        return written_path(spark, "keyed", [folder], build, spec=spec)

    first = path(30)
    assert path(30) == first and path(31) != first
    spark.range(5).write.mode("append").parquet(folder)  # one more file in the folder
    again = path(30)
    assert again != first and built == [30, 31, 30] and spark.read.parquet(again).count() == 8


def test_digests_are_read_in_chunks(spark, tmp_path, monkeypatch):
    import hashlib

    names = {"empty.bin": b"", "one chunk+.bin": b"x" * 100, "binary.bin": bytes(range(256)) * 50_000}
    for name, data in names.items():
        (tmp_path / name).write_bytes(data)
    paths = [f"file:{tmp_path}/{n}" for n in names]
    got = {os.path.basename(r.path): (r.actual, r.n_bytes) for r in TX.file_digests(spark, paths).collect()}
    assert got == {n: (hashlib.sha256(x).hexdigest(), len(x)) for n, x in names.items()}
    TX.publish_checksums(spark, paths)
    assert {r.status for r in TX.checksum_manifest(spark, paths).collect()} == {"ok"}
    assert TX.list_files(spark, str(tmp_path), ".bin") == sorted(f"file:{tmp_path}/{n}" for n in names)


def test_sidecars_are_read_and_written_by_the_tasks(spark, tmp_path, monkeypatch):
    from wearline.sources import store

    def driver(*_):
        raise AssertionError("a call of the driver for each file")

    for i in range(5):
        (tmp_path / f"e={i}").mkdir()
        (tmp_path / f"e={i}" / "a b.txt").write_text(str(i))
    paths = TX.list_files(spark, str(tmp_path), suffix=".txt")
    assert paths == [f"file:{tmp_path}/e={i}/a b.txt" for i in range(5)]
    monkeypatch.setattr(store, "_exists", driver)
    monkeypatch.setattr(TX, "write_sidecar", driver)
    (tmp_path / "e=2" / "a b.txt.sha256").write_text("ABC  a b.txt")
    TX.publish_checksums(spark, paths)
    got = {r.path: (r.expected, r.status) for r in TX.checksum_manifest(spark, paths).collect()}
    want = {p: hashlib.sha256(str(i).encode()).hexdigest() for i, p in enumerate(paths)}
    assert got == {p: ("abc", "mismatch") if "e=2" in p else (h, "ok") for p, h in want.items()}
    assert (tmp_path / "e=1" / "a b.txt.sha256").read_text() == f"{want[paths[1]]}  a b.txt\n"


def test_positions_are_decided_by_all_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TX, "FIRST_LINES", 2)
    (tmp_path / "t.txt").write_text("1 1 NaN NaN\n1\t2  NaN\x0bNaN \n1 3 x 5.5\n1 4 NaN NaN 7\n")
    got = TX.read_telemetry_text(spark, str(tmp_path / "t.txt"), names=("engine_id", "cycle", "a", "b")).orderBy("cycle")
    assert [(r["cycle"], None if r["a"] is None or r["a"] != r["a"] else r["a"], r["b"]) for r in got.collect()] == [
        (1, None, None), (2, None, None), (3, 5.5, None), (4, None, 7.0)]


def test_a_line_is_split_once(spark, tmp_path):
    (tmp_path / "t.txt").write_text("\n \t\x0b\f \n 1\t2  3 \n\x0b\n4 x\f6\n")
    toks = TX._tokens(spark.read.text(str(tmp_path / "t.txt")).withColumn("source", F.lit("")))
    assert [list(r["t"]) for r in toks.collect()] == [["1", "2", "3"], ["4", "x", "6"]]
    plan = toks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1  # was once more below, for the test of its size
