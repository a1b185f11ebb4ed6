"""Range flags by versions of a statistics table, counters of scored records (K3, K4)."""

import pytest
from pyspark.sql import functions as F

from wearline.streaming import monitor as MO


def ranges(spark, lo, hi):
    return spark.createDataFrame([("a", lo, hi)], "feature string, min double, max double")


def flags(spark, path):
    return {(r["epoch"], r["id"]): (r["n_flags"], r["flagged_features"], r["any_flag"], r["stats_version"])
            for r in spark.read.parquet(f"{path}/flags").collect()}


def test_a_retried_batch_keeps_its_version(spark, tmp_path):
    versions, out = MO.StatsVersions(spark, f"{tmp_path}/stats"), f"{tmp_path}/out"
    write = MO.flags_to(versions, ["a", "unknown"], out)
    batch = spark.createDataFrame([(1, 0.0, 1.0), (2, 5.0, 1.0), (3, float("nan"), 1.0), (4, None, 1.0), (5, 1.0, 1.0)],
                                  "id long, a double, unknown double")
    with pytest.raises(RuntimeError):
        write(batch, 0)  # nothing is published yet
    assert versions.newest() is None and versions.publish(ranges(spark, 0.0, 1.0)) == 0
    write(batch, 0)
    assert versions.publish(ranges(spark, 0.5, 9.0)) == 1
    write(batch, 0)  # a retry after the second version
    write(batch, 1)
    want = {(0, 1): (0, "", False, 0), (0, 2): (1, "a", True, 0), (0, 3): (0, "", False, 0), (0, 4): (0, "", False, 0), (0, 5): (0, "", False, 0),
            (1, 1): (1, "a", True, 1), (1, 2): (0, "", False, 1), (1, 3): (0, "", False, 1), (1, 4): (0, "", False, 1), (1, 5): (0, "", False, 1)}
    assert flags(spark, out) == want


def test_ranges_leave_bad_readings_out(spark):
    rows = spark.createDataFrame([(1.0, None), (float("nan"), None), (float("inf"), float("nan")), (-2.0, None)], "a double, b double")
    got = {r["feature"]: (r["min"], r["max"]) for r in MO.ranges_of(rows, ["a", "b"]).collect()}
    assert got == {"a": (-2.0, 1.0), "b": (float("-inf"), float("inf"))}


def test_counters_of_a_batch(spark):
    rows = [(1, "2024-01-01 01:00:00", 5.0, False, 0.5), (2, "2024-01-01 02:00:00", None, True, 0.5), (3, "2024-01-01 02:00:00", 7.0, True, 1.0),
            (4, "2024-01-01 02:00:00", 8.0, False, 2.5), (5, "2024-01-02 02:00:00", float("nan"), True, 9.0)]
    df = spark.createDataFrame(rows, "engine_id long, ts string, predicted_rul double, any_flag boolean, latency_s double")
    got = MO.scored_counters(df.withColumn("ts", F.col("ts").cast("timestamp")), bounds=(1.0, 2.0)).orderBy("window").drop("window").collect()
    assert tuple(got[0]) == (3, 1, 1, 8.0, 2, 0, 1, 4.0, 2.5)  # a bound belongs to the bucket below it
    assert tuple(got[1]) == (0, 1, 0, None, 0, 0, 0, None, None)


def test_latest_updates(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("a", 2, 5), ("a", 1, 3), ("b", 0, 9)], "window string, epoch long, n long")
    assert sorted(map(tuple, MO.latest_updates(rows).collect())) == [("a", 5), ("b", 9)]
