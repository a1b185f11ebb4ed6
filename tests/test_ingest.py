"""Strict ingest: both gates, labels from accepted readings, errors; nested report documents."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.config import RAW_COLUMNS, TELEMETRY_FEATURES, TELEMETRY_FLEET
from wearline.sources import artefacts as AR
from wearline.sources import ingest as IN
from wearline.sources.telemetry import DataLoadError


def write(path, engines, cycles, faults=()):
    with open(path, "w") as fh:
        for e in range(1, engines + 1):
            for c in range(1, cycles + 1):
                row = [str(e), str(c)] + [f"{(e * 7 + c * i) % 11 + 0.5}" for i in range(24)]
                for (fe, fc), (col, text) in faults:
                    if (fe, fc) == (e, c):
                        row[RAW_COLUMNS.index(col)] = text
                fh.write(" ".join(row) + " NaN NaN\n")


def test_faults_are_rejected_and_shorten_lives(spark, tmp_path):
    write(tmp_path / "train.txt", 5, 8, [((2, 8), ("sensor_2", "bad")), ((3, 1), ("cycle", "0")), ((5, 4), ("sensor_21", "NaN"))])
    write(tmp_path / "test.txt", 2, 4, [((1, 4), ("engine_id", "-1"))])
    truth = spark.createDataFrame([(1, 10.0), (2, float("nan"))], "engine_id long, final_rul double")
    out = str(tmp_path / "out")
    IN.ingest_fleet(spark, str(tmp_path / "train.txt"), str(tmp_path / "test.txt"), truth, TELEMETRY_FLEET, out)
    splits, rejects = IN.read_ingested(spark, out)
    got = {(r["kind"], r["engine_id"], r["cycle"], tuple(r["violations"])) for r in rejects.collect()}
    assert got == {("train", 2, 8, ("sensor_2_missing",)), ("train", 3, 0, ("cycle_below_1",)), ("train", 5, 4, ("sensor_21_missing",)),
                   ("test", -1, 4, ("engine_id_below_1",))}
    rows = {(r["split"], r["engine_id"], r["cycle"]): r for r in splits.collect()}
    assert len(rows) == 40 - 3 + 8 - 1
    assert rows["train", 2, 7]["rul"] == 0.0 and rows["train", 1, 8]["rul"] == 0.0  # engine 2 ends at cycle 7
    assert {k[1] for k in rows if k[0] == "val"} == {5}
    assert rows["test", 1, 3]["rul"] == 10.0 and rows["test", 2, 4]["rul"] is None
    scaled = splits.filter("split = 'train'").agg(*[F.avg(f).alias(f) for f in TELEMETRY_FEATURES]).first()
    assert all(abs(v) < 1e-9 for v in scaled)


def test_strict_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "a long, b double")
    assert IN.require_schema(df, {"a": T.LongType(), "b": T.DoubleType()}) is df
    for expected in ({"a": T.LongType()}, {"a": T.LongType(), "b": T.StringType()}, {"a": T.LongType(), "b": T.DoubleType(), "c": T.LongType()}):
        with pytest.raises(IN.SchemaError):
            IN.require_schema(df, expected)
    write(tmp_path / "bad.txt", 1, 2, [((1, c), ("cycle", "0")) for c in (1, 2)])
    write(tmp_path / "test.txt", 1, 2)
    truth = spark.createDataFrame([], "engine_id long, final_rul double")
    with pytest.raises(DataLoadError):
        IN.ingest_fleet(spark, str(tmp_path / "bad.txt"), str(tmp_path / "test.txt"), truth, TELEMETRY_FLEET, str(tmp_path / "out"))


def test_report_documents(spark, tmp_path):
    rows = [(e, float(e), None if e == 4 else 2.0, None if e == 4 else abs(e - 2.0)) for e in range(1, 6)]
    per = spark.createDataFrame(rows, AR.REPORT_ROW_SCHEMA)
    head = spark.createDataFrame([(1.5, float("inf"), None, 5)], "rmse double, mae double, nasa_score double, test_set_size long")
    path = str(tmp_path / "report")
    AR.write_nested_report(head, per, path, engines=2)
    assert spark.read.text(path).count() == 3  # documents of at most two engines
    metrics, back = AR.read_report_documents(spark, path)
    assert [tuple(r) for r in metrics.collect()] == [(1.5, float("inf"), None, 5)]
    assert sorted(map(tuple, back.collect())) == rows
    AR.write_nested_report(head, per.limit(0), path)
    metrics, back = AR.read_report_documents(spark, path)
    assert metrics.count() == 1 and back.isEmpty()


def test_stats_object(spark, tmp_path):
    stats = spark.createDataFrame([("b", 0.5, None, -1.0, 2.0), ("a", 1.0, 2.0, 3.0, 4.0)], AR.STATS_SCHEMA)
    AR.write_stats_object(stats, str(tmp_path / "stats"))
    assert sorted(map(tuple, AR.read_stats_object(spark, str(tmp_path / "stats")).collect())) == sorted(map(tuple, stats.collect()))


def test_raw_text_is_compressed_in_small_files(spark, sf_small, monkeypatch, tmp_path):
    from wearline.plans import ingest_queries as IQ
    from wearline.session import SCAN_BYTES

    paths, had, write = [], spark.conf.get(SCAN_BYTES), IQ.written_path
    monkeypatch.setitem(IQ.TEXT, "maxRecordsPerFile", 700)
    monkeypatch.setattr(IQ, "written_path", lambda *a, **k: paths.append(write(*a, **k)) or paths[-1])
    splits, rejects = IQ.ingested(spark, sf_small)
    files = [f for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths[0]).inputFiles() if "/part-" in f]
    assert files and all(f.endswith(".txt.gz") for f in files)
    lines = spark.read.text(paths[0])
    assert all(r["count"] <= 700 for r in lines.groupBy(F.input_file_name()).count().collect())
    assert splits.count() + rejects.count() == lines.count()  # every line is read back
    plain = lines.agg(F.sum(F.length("value") + 1)).first()[0]
    packed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files).agg(F.sum("length")).first()[0]
    assert packed < plain / 2
    assert spark.conf.get(SCAN_BYTES) == had
