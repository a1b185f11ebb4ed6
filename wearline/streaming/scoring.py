"""Structured Streaming over telemetry (K1-K6).

Readings arrive as a file stream (any file source; Kafka is a drop-in where
its connector is installed). Event time must be TIMESTAMP: parquet timestamps
read as TIMESTAMP_NTZ and are cast with the session zone set to UTC.

K1 keeps, per engine, the last L readings in state (ordered by event time and
id, so out-of-order delivery is tolerated) and the count of readings seen; a
record is emitted whenever a full window changes. State per engine is bounded
by L readings, so a hot engine costs its bounded share of a state row, not its history.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import FleetSpec
from ..operators import quality as Q
from ..operators.drift import psi_against_reference
from ..session import scratch_path, ship_package
from ..sources.store import _fs

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def event_stream(spark: SparkSession, sf_dir: str, copies: int = 1, max_files: int | None = None) -> DataFrame:
    """The events table as a file stream, be it one file or a folder of part files;
    ``copies`` > 1 delivers every event several times (to exercise de-duplication).
    ``max_files`` limits the files of a micro-batch, so a backfill is several batches."""
    table = f"{sf_dir.rstrip('/')}/events.parquet"
    fs, path = _fs(spark, table)
    folder = fs.getFileStatus(path).isDirectory()

    def one() -> DataFrame:
        r = spark.readStream.schema(EVENTS_SCHEMA)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        return r.parquet(table) if folder else r.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    s = one()
    for _ in range(copies - 1):
        s = s.unionByName(one())
    return s


def readings(events: DataFrame) -> DataFrame:
    """Events -> readings of the events fleet (engine = user + 1), event time as TIMESTAMP."""
    return events.select(
        (F.col("user_id") + 1).cast("bigint").alias("engine_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("is_error"),
    )


def standardise_stream(df: DataFrame, scaler: dict, features: Sequence[str]) -> DataFrame:
    """F1 on a stream: stored train values as literals (no join, no refit)."""
    return df.select(*[
        ((F.col(c) - F.lit(float(scaler[c]["mu"]))) / F.lit(float(scaler[c]["sigma"]))).alias(c)
        if c in features else F.col(c) for c in df.columns
    ])


# --- K1: last-window scoring with bounded state ---------------------------------

SCORED_SCHEMA = T.StructType([
    T.StructField("engine_id", T.LongType()),
    T.StructField("n_seen", T.LongType()),
    T.StructField("last_ts_us", T.LongType()),
    T.StructField("predicted_rul", T.DoubleType()),
])


GROUP_ENGINES = 64  # engines that share a state row, so a group's call and its state are paid once for all of them

#: Per reading held: engine, time, id and features; per engine: the count of readings seen. Arrays as bytes.
STATE_SCHEMA = T.StructType([T.StructField(c, T.BinaryType()) for c in ("held_by", "at", "vals", "engines", "n")])


def _window_step(spec: FleetSpec, ranges: dict | None = None):
    L = spec.window
    feats = list(spec.features)
    k = len(feats)
    w = np.array([spec.weight(f) for f in feats])
    if ranges is not None:
        low, high = (np.array([ranges[f][x] for f in feats], dtype=float) for x in ("min", "max"))

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        missing = pd.isna(key[0])  # the group of readings without an engine: one window
        if state.exists:
            by, at, held, engines, n = (np.frombuffer(x, t) for x, t in zip(state.get, (np.int64, np.int64, float, np.int64, np.int64), strict=True))
            at, held = at.reshape(-1, 2), held.reshape(-1, k)
            seen = dict(zip(engines.tolist(), n.tolist(), strict=True))
        else:
            by, at, held, seen = np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.zeros((0, k)), {}
        changed = set()
        for new in pdfs:  # chunk by chunk: never more than a chunk and L readings an engine at once
            own = np.zeros(len(new), np.int64) if missing else new["engine_id"].to_numpy(dtype=np.int64)
            before, by = len(by), np.concatenate([by, own])
            at = np.vstack([at, new[["ts_us", "event_id"]].to_numpy(dtype=np.int64)])
            held = np.vstack([held, new[feats].to_numpy(dtype=float)])
            order = np.lexsort((at[:, 1], at[:, 0], by))  # by engine, time, then id; a reading held already wins
            by, at = by[order], at[order]
            fresh = np.ones(len(by), bool)
            fresh[1:] = (by[1:] != by[:-1]) | (at[1:] != at[:-1]).any(axis=1)
            for e, c in zip(*np.unique(by[fresh & (order >= before)], return_counts=True), strict=True):
                seen[int(e)] = seen.get(int(e), 0) + int(c)
            changed.update(own.tolist())
            by, at, held = by[fresh], at[fresh], held[order][fresh]
            left = np.searchsorted(by, by, side="right") - np.arange(len(by))
            by, at, held = by[left <= L], at[left <= L], held[left <= L]
        counts = np.array(list(seen.values()), np.int64)
        state.update((by.tobytes(), at.tobytes(), held.tobytes(), np.array(list(seen), np.int64).tobytes(), counts.tobytes()))
        engines, start, size = np.unique(by, return_index=True, return_counts=True)
        full = (size == L) & np.isin(engines, list(changed))
        if full.any():
            window = held[start[full][:, None] + np.arange(L)]
            ok = np.isfinite(window).all(axis=(1, 2))  # a bad reading gives no forecast
            pred = spec.bias + window.mean(axis=1) @ w
            record = {"engine_id": pd.Series(engines[full] if not missing else [None], dtype="Int64"), "n_seen": [seen[int(e)] for e in engines[full]],
                      "last_ts_us": at[start[full] + L - 1, 0], "predicted_rul": pd.Series(pd.array(np.where(ok, pred, 0.0), "Float64")).mask(~ok)}
            if ranges is not None:  # of the last reading; NaN lies in no order, so it isn't flagged
                last = window[:, -1]
                record["any_flag"] = ((last < low) | (last > high)).any(axis=1)
            yield pd.DataFrame(record)

    return step


def score_stream(scaled_readings: DataFrame, spec: FleetSpec, ranges: dict | None = None) -> DataFrame:
    """Emit (engine_id, n_seen, last_ts_us, predicted_rul) when an engine's full window changes (K1).
    With ``ranges`` (feature -> min, max) also ``any_flag``: the last reading leaves a range.

    ``GROUP_ENGINES`` neighbouring ids share one state row of at most so many windows; each engine has its own window."""
    ship_package(scaled_readings.sparkSession)
    src = scaled_readings.withColumn("ts_us", F.unix_micros("ts")).withColumn("_group", F.floor(F.col("engine_id") / GROUP_ENGINES))
    out = SCORED_SCHEMA if ranges is None else T.StructType([*SCORED_SCHEMA, T.StructField("any_flag", T.BooleanType())])
    return src.groupBy("_group").applyInPandasWithState(_window_step(spec, ranges), out, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


# --- K2 / K3: stateless validation, quarantine and range flags ------------------

def quarantine_to(rules, good_path: str, bad_path: str):
    """foreachBatch writer: clean rows to ``good_path``, tagged rejects to ``bad_path`` (K2).

    Each batch has a folder of its own that a retry overwrites, so nothing is written twice.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        tagged = Q.quarantine(batch, rules).persist()
        try:
            good = tagged.filter(F.size("violations") == 0).drop("violations")
            good.write.mode("overwrite").parquet(f"{good_path}/epoch={epoch}")
            tagged.filter(F.size("violations") > 0).write.mode("overwrite").parquet(f"{bad_path}/epoch={epoch}")
        finally:
            tagged.unpersist()
    return write


def range_flag_columns(stats: dict, features: Sequence[str]) -> dict:
    """Range flags against static train statistics, as literals (K3)."""
    return {f: F.coalesce(~F.isnan(F.col(f)) & ((F.col(f) < F.lit(float(stats[f]["min"])))
                                               | (F.col(f) > F.lit(float(stats[f]["max"])))), F.lit(False))
            for f in features}


# --- K4: windowed counters ----------------------------------------------------------

def hourly_counters(readings_stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Per one-hour tumbling window: readings, errors, max value, last value (K4)."""
    return readings_stream.withWatermark("ts", watermark).groupBy(F.window("ts", "1 hour")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_readings"),
        F.count_if(F.col("is_error") > 0).cast("bigint").alias("n_errors"),
        F.max("value").alias("max_value"),
        F.max_by("value", F.struct("ts", "event_id")).alias("last_value"),
    )


# --- K5: drift per micro-batch -------------------------------------------------------

def drift_to(ref: dict, features: Sequence[str], path: str, threshold: float):
    """foreachBatch writer: PSI of each micro-batch against the stored reference,
    with the batch id and an alarm flag (K5). Each batch has a folder of its own that a
    retry overwrites, so none counts twice."""
    def write(batch: DataFrame, epoch: int) -> None:
        psi = psi_against_reference(batch, ref, features)
        psi.withColumn("epoch", F.lit(epoch).cast("bigint")).withColumn("alarm", F.col("psi") > threshold) \
            .write.mode("overwrite").parquet(f"{path}/batch-{epoch}")
    return write


# --- K6: repeated and late readings --------------------------------------------------

def drop_repeats(readings_stream: DataFrame, keys: Sequence[str] = ("event_id",), watermark: str = "1 hour") -> DataFrame:
    """Drop repeated deliveries within the watermark; later-than-watermark readings are dropped (K6)."""
    return readings_stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(list(keys))


# --- running a stream to completion over what is available ---------------------------

def run_available(stream: DataFrame, name: str, mode: str = "append", sink: str = "parquet",
                  foreach=None, run_id: str | None = None) -> str:
    """Run ``stream`` with trigger(availableNow) into a fresh table in the shared
    folder (checkpointed there too); return the sink path. A ``run_id`` used before goes on from its checkpoint."""
    import uuid

    spark = stream.sparkSession
    run_id = run_id or uuid.uuid4().hex
    out = scratch_path(spark, f"streams/{name}/{run_id}/out")
    ckpt = scratch_path(spark, f"streams/{name}/{run_id}/checkpoint")
    w = stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if foreach is not None:
        q = w.outputMode(mode).foreachBatch(foreach).start()
    else:
        q = w.outputMode(mode).format(sink).option("path", out).start()
    q.awaitTermination()
    return out
