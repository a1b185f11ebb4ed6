"""Late and repeated readings are routed, none is lost (K6)."""

import pandas as pd
from pyspark.sql import functions as F

from wearline.streaming import late as LT


def stream(spark, tmp_path, deliveries):
    d = tmp_path / "deliveries"
    d.mkdir()
    for i, rows in enumerate(deliveries):
        pdf = pd.DataFrame(rows, columns=["event_id", "ts", "engine_id"])
        pdf["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf["ts"], unit="min")
        pdf.to_parquet(d / f"part_{i:03d}.parquet", index=False, coerce_timestamps="us")
    raw = spark.readStream.schema("event_id long, ts timestamp_ntz, engine_id long").option("maxFilesPerTrigger", 1).parquet(str(d))
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def routes(spark, tmp_path, deliveries, **how):
    out = LT.run_routed(LT.route_readings(stream(spark, tmp_path, deliveries), **how), "test-late")
    return sorted((r["event_id"], r["route"]) for r in spark.read.parquet(out).collect())


def test_routes_add_up(spark, tmp_path):
    deliveries = [
        [(1, 500, 1), (2, 505, 1), (1, 500, 1)],  # a repeat within the batch; the watermark becomes 445
        [(3, 100, 2), (4, 445, 2), (5, 444, 2), (2, 505, 1)],  # 445 is on time, 444 isn't
        [(6, 2000, 1), (4, 445, 2)],  # the watermark moves on after the batch: still a repeat
        [(1, 500, 1), (7, 1940, 9), (8, 1939, 9)],  # 1 was kept once, but now it is late
    ]
    got = routes(spark, tmp_path, deliveries)
    want = [(1, "kept"), (1, "late"), (1, "repeat"), (2, "kept"), (2, "repeat"), (3, "late"), (4, "kept"), (4, "repeat"), (5, "late"),
            (6, "kept"), (7, "kept"), (8, "late")]
    assert got == want and len(got) == sum(map(len, deliveries))


def test_newest_first_keeps_count(spark, tmp_path):
    rows = [(i, i * 7, i % 3) for i in range(200)]
    parts = [rows[i:i + 50] for i in range(0, 200, 50)][::-1]
    got = routes(spark, tmp_path, [*parts, parts[0]], buckets=3)
    assert len(got) == 250
    kept = [i for i, r in got if r == LT.KEPT]
    assert len(kept) == len(set(kept)) and set(kept) >= {i for i, t, _ in rows if t >= rows[-1][1] - 60}
    assert all(r == LT.LATE for i, r in got if i < 50)
