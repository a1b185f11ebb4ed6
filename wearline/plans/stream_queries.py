"""Registered streams of several micro-batches with planted faults (K1-K5).

The events table is delivered in ``PARTS`` parts of five days each, in order; every part is one
micro-batch. Faults are planted by arithmetic on the event id, which the SQL repeats.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as X
from ..session import scratch_path
from ..sources.tables import read_table
from ..streaming import late as LT
from ..streaming import monitor as MO
from ..streaming import scoring as ST
from .common import finish
from .fleet import FleetRun
from .queries import query

PARTS = 6
PART_FILES = 2
NARROW, WIDE = 5, 50  # statistics of so many engines in the first and the second version


def part_of(ts: Column) -> Column:
    return F.least(F.floor((F.dayofmonth(ts) - 1) / 5), F.lit(PARTS - 1)).cast("int")


def delivered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with planted faults and their ``part``: missing values and keys, a NaN value, an engine id below 1."""
    e = F.col("event_id")
    rows = read_table(spark, sf_dir, "events", *[f.name for f in ST.EVENTS_SCHEMA])
    return rows.withColumns({
        "value": F.when(e % 97 == 5, F.lit(None)).when(e % 89 == 7, F.lit(float("nan"))).otherwise(F.col("value")),
        "props": F.when(e % 103 == 11, F.lit("{}")).otherwise(F.col("props")),
        "part": part_of(F.col("ts")),
    })


def part_stream(spark: SparkSession, path: str) -> DataFrame:
    return (spark.readStream.schema(ST.EVENTS_SCHEMA).option("maxFilesPerTrigger", PART_FILES)
            .option("recursiveFileLookup", "true").parquet(path))


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"streams/{name}/{uuid.uuid4().hex}")


@query("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """Readings per micro-batch and set of broken rules, clean ones with an empty set, counted in the two sinks (K2)."""
    base = _folder(spark, "rejects")
    events = delivered_events(spark, sf_dir)
    events = events.withColumn("user_id", F.when(F.col("event_id") % 101 == 3, F.lit(-1)).otherwise(F.col("user_id")))
    LT.deliver(events, "part", f"{base}/in", PARTS, PART_FILES)
    features = C.EVENTS_FLEET.features
    rules = [("engine_id_below_1", F.col("engine_id") < 1)] + [(f"{f}_missing", X.is_missing(F.col(f))) for f in features]
    ST.run_available(ST.readings(part_stream(spark, f"{base}/in")), "rejects",
                     foreach=ST.quarantine_to(rules, f"{base}/good", f"{base}/bad"))
    good = spark.read.parquet(f"{base}/good").select("epoch", F.lit("").alias("violations"))
    bad = spark.read.parquet(f"{base}/bad").select("epoch", F.array_join("violations", ",").alias("violations"))
    return good.unionByName(bad).groupBy(F.col("epoch").cast("bigint").alias("epoch"), "violations").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_readings"))


@query("stream_range_flags")
def q_stream_range_flags(spark, sf_dir):
    """Range flags per reading against a statistics table that gets a second version half-way, when the stream
    also stops and goes on from its checkpoint (K3)."""
    base = _folder(spark, "flags")
    events = delivered_events(spark, sf_dir)
    run = FleetRun(spark, sf_dir, "events")
    versions = MO.StatsVersions(spark, f"{base}/stats")
    run_id = uuid.uuid4().hex
    for engines, start, end in ((NARROW, 0, PARTS // 2), (WIDE, PARTS // 2, PARTS)):
        versions.publish(MO.ranges_of(run.rows.filter(F.col("engine_id") <= engines), run.features))
        LT.deliver(events, "part", f"{base}/in", end, PART_FILES, start=start)
        ST.run_available(ST.readings(part_stream(spark, f"{base}/in")), "flags", run_id=run_id,
                         foreach=MO.flags_to(versions, run.features, f"{base}/out"))
    return spark.read.parquet(f"{base}/out/flags").select("event_id", "engine_id", "stats_version", "n_flags", "flagged_features", "any_flag")


@query("stream_scored_counters")
def q_stream_scored_counters(spark, sf_dir):
    """Two streams: forecasts of changed windows, and from their records the daily counters of scored, rejected and drifted
    ones, the last forecast and the delay between a reading and the end of its part, in buckets (K1, K4, E11)."""
    base = _folder(spark, "scored")
    LT.deliver(delivered_events(spark, sf_dir), "part", f"{base}/in", PARTS, PART_FILES)
    run = FleetRun(spark, sf_dir, "events")
    narrow = MO.ranges_of(run.scaled(run.rows.filter(F.col("engine_id") <= NARROW)), run.features).collect()  # one row a feature
    ranges = {r["feature"]: {"min": r["min"], "max": r["max"]} for r in narrow}
    scaled = ST.standardise_stream(ST.readings(part_stream(spark, f"{base}/in")), run.scaler, run.features)
    records = ST.run_available(ST.score_stream(scaled, run.spec, ranges), "scored")
    # the files of one part, at most one a state partition, are one micro-batch
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrived = spark.readStream.schema(spark.read.parquet(records).schema).option("maxFilesPerTrigger", files).parquet(records)
    ts = F.timestamp_micros("last_ts_us")
    end = F.date_trunc("month", "ts") + F.make_interval(days=(part_of(F.col("ts")) + 1) * 5 + F.when(part_of(F.col("ts")) == PARTS - 1, 1).otherwise(0))
    arrived = arrived.withColumn("ts", ts).withColumn("latency_s", (F.unix_micros(end) - F.col("last_ts_us")) / F.lit(1e6))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{base}/counters/batch-{epoch}")

    # a micro-batch of records spans one part, so its readings lie up to six days apart
    ST.run_available(MO.scored_counters(arrived, watermark="7 days"), "scored-counters", mode="update", foreach=keep)
    rows = MO.latest_updates(spark.read.parquet(f"{base}/counters/batch-*"))
    return finish(rows.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), *[c for c in rows.columns if c != "window"]))


@query("stream_drift_batches")
def q_stream_drift_batches(spark, sf_dir):
    """PSI of each of six micro-batches against the stored reference, with alarms (K5)."""
    base = _folder(spark, "drift-batches")
    LT.deliver(read_table(spark, sf_dir, "events", *[f.name for f in ST.EVENTS_SCHEMA]).withColumn("part", part_of(F.col("ts"))),
               "part", f"{base}/in", PARTS, PART_FILES)
    run = FleetRun(spark, sf_dir, "events")
    stream = ST.standardise_stream(ST.readings(part_stream(spark, f"{base}/in")), run.scaler, run.features)
    ST.run_available(stream, "drift-batches", foreach=ST.drift_to(run.reference, run.features, f"{base}/out", C.PSI_ALARM))
    return finish(spark.read.parquet(f"{base}/out/batch-*").select("epoch", "feature", "psi", "alarm"))
