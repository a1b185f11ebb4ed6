"""Range flags against a statistics table that changes, and counters of scored records (K3, K4).

``StatsVersions`` is a table of per-feature ranges in numbered versions, each a folder that
appears by a rename, so a reader sees whole versions only. ``flags_to`` flags a micro-batch by the newest
version there is when the batch starts and notes it beside the batch's rows; a retried batch uses
the version noted, whatever has been published since, so its rows stay the same.

``scored_counters`` counts scored records in update mode. Its state per window is one row: sums, the
last record and the counts of a fixed set of latency buckets, all of which merge by adding or comparing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import not_finite
from ..sources.store import _exists, _fs
from .scoring import range_flag_columns

RANGES_SCHEMA = "feature string, min double, max double"


class StatsVersions:
    """Versions of a (feature, min, max) table below ``path``: ``version=0``, ``version=1``, ..."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def newest(self) -> int | None:
        fs, jpath = _fs(self.spark, self.path)
        if not fs.exists(jpath):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(jpath)]
        return max((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), default=None)

    def publish(self, ranges: DataFrame) -> int:
        """Write ``ranges`` as the next version and return its number; one publisher at a time."""
        newest = self.newest()
        version = 0 if newest is None else newest + 1
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        ranges.selectExpr("feature", "CAST(min AS DOUBLE) AS min", "CAST(max AS DOUBLE) AS max").coalesce(1).write.parquet(draft)
        fs, jpath = _fs(self.spark, draft)
        if not fs.rename(jpath, _fs(self.spark, f"{self.path}/version={version}")[1]):
            raise RuntimeError(f"version {version} of {self.path} could not be published")
        return version

    def read(self, version: int) -> dict[str, dict]:
        """feature -> {min, max}: one row a feature, so its size is that of the feature list."""
        rows = self.spark.read.schema(RANGES_SCHEMA).parquet(f"{self.path}/version={version}").collect()
        return {r["feature"]: {"min": r["min"], "max": r["max"]} for r in rows}


def ranges_of(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, min, max) of the finite readings, from one aggregate; a feature without any has an open range."""
    inf = float("inf")
    good = {f: F.when(~not_finite(F.col(f).cast("double")), F.col(f).cast("double")) for f in features}
    wide = rows.agg(*[F.struct(F.coalesce(F.min(c), F.lit(-inf)).alias("min"), F.coalesce(F.max(c), F.lit(inf)).alias("max")).alias(f)
                      for f, c in good.items()])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f)["min"].alias("min"), F.col(f)["max"].alias("max"))
                                          for f in features])))


def _noted_version(spark: SparkSession, versions: StatsVersions, note: str) -> int:
    """The version noted for a batch, or the newest, which is noted now."""
    if not _exists(spark, note):
        newest = versions.newest()
        if newest is None:
            raise RuntimeError(f"no version of {versions.path} is published")
        spark.range(1).select(F.lit(newest).cast("long").alias("version")).write.mode("overwrite").parquet(f"{note}.draft")
        fs, jpath = _fs(spark, f"{note}.draft")
        fs.rename(jpath, _fs(spark, note)[1])
    return spark.read.schema("version long").parquet(note).first()["version"]


def flags_to(versions: StatsVersions, features: Sequence[str], path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: the rows with ``n_flags``, ``flagged_features``, ``any_flag`` and the ``stats_version`` used (K3).

    A missing statistic flags nothing, NaN and null readings neither. Each batch has a folder of its own that a retry overwrites.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        version = _noted_version(spark, versions, f"{path}/notes/epoch-{epoch}")
        stats = versions.read(version)
        known = [f for f in features if f in stats]
        flags = range_flag_columns(stats, known)
        names = F.filter(F.array(*[F.when(flags[f], F.lit(f)) for f in known]).cast("array<string>"), lambda x: x.isNotNull())
        out = batch.withColumn("flagged", names).select(
            *batch.columns, F.size("flagged").cast("long").alias("n_flags"), F.array_join("flagged", ",").alias("flagged_features"),
            (F.size("flagged") > 0).alias("any_flag"), F.lit(version).cast("long").alias("stats_version"))
        out.write.mode("overwrite").parquet(f"{path}/flags/epoch={epoch}")
    return write


LATENCY_BUCKETS = (3600.0, 6 * 3600.0, 24 * 3600.0, 48 * 3600.0)  # upper bounds in seconds, the last bucket is open


def bucket_counts(seconds: Column, bounds: Sequence[float]) -> dict[str, Column]:
    """One count a bucket: at most the first bound, above it and at most the second, ..., above the last."""
    edges = [None, *bounds, None]
    out = {}
    for i in range(len(bounds) + 1):
        inside = F.lit(True)
        if edges[i] is not None:
            inside = inside & (seconds > F.lit(float(edges[i])))
        if edges[i + 1] is not None:
            inside = inside & (seconds <= F.lit(float(edges[i + 1])))
        out[f"latency_{i}"] = F.count_if(inside & seconds.isNotNull()).cast("long").alias(f"latency_{i}")
    return out


def scored_counters(records: DataFrame, ts: str = "ts", watermark: str = "2 hours", window: str = "1 day",
                    bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Per window of event time: records scored and rejected (no forecast), drifted ones, the last forecast and
    the latency's histogram, sum and maximum (K4, E11). ``records`` has engine_id, ``ts``, predicted_rul, any_flag, latency_s.

    The last forecast is that of the latest record with one, the largest engine_id among equal times.
    """
    p = F.col("predicted_rul")
    scored = ~not_finite(p)
    return records.withWatermark(ts, watermark).groupBy(F.window(ts, window)).agg(
        F.count_if(scored).cast("long").alias("n_scored"), F.count_if(~scored).cast("long").alias("n_rejected"),
        F.count_if(scored & F.col("any_flag")).cast("long").alias("n_drifted"),
        F.max(F.when(scored, F.struct(F.col(ts).alias("ts"), "engine_id", p.alias("p"))))["p"].alias("last_prediction"),
        *bucket_counts(F.when(scored, F.col("latency_s")), bounds).values(),
        F.sum(F.when(scored, F.col("latency_s"))).alias("latency_sum"), F.max(F.when(scored, F.col("latency_s"))).alias("latency_max"))


def latest_updates(rows: DataFrame, key: str = "window") -> DataFrame:
    """The last update of each window from an update-mode sink that wrote (..., epoch)."""
    rest = [c for c in rows.columns if c not in (key, "epoch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "epoch").alias("r")).select(key, "r.*")
