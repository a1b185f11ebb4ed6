"""Late and repeated readings, routed instead of dropped (K6).

``route_readings`` is a stateful operator that knows the stream's watermark. Each delivered reading
leaves with a ``route``: ``kept``, ``late`` (older than the watermark) or ``repeat`` (its key was kept
before and lies still within the watermark), so kept + late + repeat = delivered.

Keys are dealt to ``buckets`` by hash, so a hot engine spreads over all of them. A bucket's
state is the keys and times of kept readings within the watermark; a timer clears what the
watermark has passed, also in buckets that get no more readings.

Spark drops late rows before a stateful operator if their event-time column still carries its
watermark; the operator therefore gets the time as a plain column and asks for the watermark itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..session import scratch_path, ship_package

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT, LATE, REPEAT = "kept", "late", "repeat"


def _router(delay_ms: int):
    class Router(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.held = handle.getValueState("held", T.StructType([
                T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("ts_us", T.ArrayType(T.LongType()))]))

        def _load(self) -> tuple[np.ndarray, np.ndarray]:
            if not self.held.exists():
                return np.empty(0, np.int64), np.empty(0, np.int64)
            keys, ts_us = self.held.get()
            return np.array(keys, np.int64), np.array(ts_us, np.int64)

        def _save(self, keys: np.ndarray, ts_us: np.ndarray, mark_us: int) -> None:
            """Holds what the watermark hasn't passed, and wakes up when it has passed the oldest of it."""
            own = ts_us >= mark_us
            keys, ts_us = keys[own], ts_us[own]
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(int(timer))
            if not len(keys):
                self.held.clear()
                return
            self.held.update((keys.tolist(), ts_us.tolist()))
            self.handle.registerTimer(max(int(ts_us.min() // 1000), mark_us // 1000) + delay_ms + 1)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            mark_us = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
            keys, ts_us = self._load()
            for new in rows:  # chunk by chunk
                own, at = new["key"].to_numpy(np.int64), new["ts_us"].to_numpy(np.int64)
                late = at < mark_us
                first = np.zeros(len(own), bool)
                fresh = np.flatnonzero(~late & ~np.isin(own, keys))
                first[fresh[np.unique(own[fresh], return_index=True)[1]]] = True
                keys, ts_us = np.concatenate([keys, own[first]]), np.concatenate([ts_us, at[first]])
                yield new.assign(route=np.where(late, LATE, np.where(first, KEPT, REPEAT)), watermark_ms=mark_us // 1000).drop(columns=["bucket"])
            self._save(keys, ts_us, mark_us)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            keys, ts_us = self._load()
            self._save(keys, ts_us, max(timerValues.getCurrentWatermarkInMs(), 0) * 1000)
            return iter(())

        def close(self) -> None:
            pass

    return Router()


def route_readings(readings: DataFrame, key: str = "event_id", ts: str = "ts", delay_minutes: int = 60, buckets: int = 64) -> DataFrame:
    """The readings with ``ts_us`` instead of ``ts``, ``route`` and the ``watermark_ms`` that decided it."""
    spark = readings.sparkSession
    ship_package(spark)
    rest = [c for c in readings.columns if c not in (key, ts)]
    marked = readings.withWatermark(ts, f"{delay_minutes} minutes")
    rows = marked.select(F.col(key).cast("long").alias("key"), F.unix_micros(ts).alias("ts_us"), *rest)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    out = T.StructType([f for f in rows.schema if f.name != "bucket"] + [T.StructField("route", T.StringType()), T.StructField("watermark_ms", T.LongType())])
    routed = rows.groupBy("bucket").transformWithStateInPandas(_router(delay_minutes * 60_000), out, "append", "eventTime")
    return routed.withColumnRenamed("key", key)


def run_routed(routed: DataFrame, name: str) -> str:
    """Run over what is available; the sink's folders ``route=kept``, ``route=late`` and ``route=repeat`` are tables of their own."""
    spark = routed.sparkSession
    base = scratch_path(spark, f"streams/{name}/{uuid.uuid4().hex}")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # the state's timers need it
    try:
        q = (routed.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
             .outputMode("append").partitionBy("route").format("parquet").option("path", f"{base}/out").start())
        q.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return f"{base}/out"


def deliver(events: DataFrame, batch: str, path: str, batches: int, files: int = 2, start: int = 0) -> None:
    """Writes rows as deliveries of ``files`` files each, in order of ``batch``: ``start`` first, ``batches`` - 1 last."""
    for i in range(start, batches):
        events.filter(F.col(batch) == i).drop(batch).repartition(files).write.parquet(f"{path}/delivery={i:04d}")
