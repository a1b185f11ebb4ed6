"""Parquet / JSON sinks and sources for processed data and artefacts (A5-A10).

Per-feature artefacts (statistics, drift reference, importance) are long tables
(one row per feature or per bin); the JSON object form keyed by feature is only
produced at the edge, from such a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATS_SCHEMA = "feature string, mean double, std double, min double, max double"

REQUEST_SCHEMA = T.StructType([
    T.StructField("engine_id", T.LongType()),
    T.StructField("sensor_window", T.ArrayType(T.ArrayType(T.DoubleType()))),
])

REPORT_ROW_SCHEMA = "engine_id bigint, predicted_rul double, actual_rul double, abs_error double"

RUN_LOG_SCHEMA = "run_id string, step bigint, metric string, value double"


def write_splits(df: DataFrame, path: str) -> None:
    """One parquet table partitioned by ``split`` (train / val / test) (A5)."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    d = spark.read.parquet(path)
    return d.filter(F.col("split") == split) if split else d


def write_stats(stats: DataFrame, path: str) -> None:
    """Feature statistics as JSON lines, one object per feature."""
    stats.select("feature", "mean", "std", "min", "max").write.mode("overwrite").json(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_SCHEMA).json(path)


def read_stats_object(spark: SparkSession, path: str) -> DataFrame:
    """Read the single-object form {feature: {mean, std, min, max}} into the long table."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string, struct<mean: double, std: double, min: double, max: double>>")
    return raw.select(F.explode(m).alias("feature", "s")).select("feature", "s.*")


def write_stats_object(stats: DataFrame, path: str) -> None:
    """Feature statistics as one JSON object keyed by feature, in order of the names; its size is that of the feature list."""
    values = F.struct("mean", "std", "min", "max")
    entries = F.sort_array(F.collect_list(F.struct("feature", values.alias("s"))))
    stats.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.mode("overwrite").text(path)


def write_report(metrics: DataFrame, per_engine: DataFrame, path: str) -> None:
    """Evaluation report: the metrics row and the per-engine rows as JSON lines.

    The per-engine rows stay a distributed table rather than one nested
    document, so no task has to hold the whole fleet.
    """
    metrics.write.mode("overwrite").json(f"{path}/metrics")
    per_engine.write.mode("overwrite").json(f"{path}/per_engine")


def read_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.json(f"{path}/metrics"),
            spark.read.schema(REPORT_ROW_SCHEMA).json(f"{path}/per_engine"))


METRIC_FIELDS = ("rmse", "mae", "nasa_score")
REPORT_ROWS = "array<struct<engine_id: bigint, predicted_rul: double, actual_rul: double, abs_error: double>>"
REPORT_SCHEMA = f"rmse double, mae double, nasa_score double, test_set_size bigint, per_engine_predictions {REPORT_ROWS}"


def write_nested_report(metrics: DataFrame, per_engine: DataFrame, path: str, engines: int = 1000) -> None:
    """Nested documents, one a line: the metrics and ``per_engine_predictions`` sorted by engine.

    ``metrics`` is one row of ``METRIC_FIELDS`` and test_set_size. A document holds the engines of one range of ``engines`` ids, so a
    fleet of up to that many gives one document and a larger one gives many, each of bounded size and
    written by the task that gathers its range. Every document repeats the metrics; a fleet without rows has one with an empty array.
    """
    fields = [f.split()[0] for f in REPORT_ROW_SCHEMA.split(", ")]
    row = metrics.select(*METRIC_FIELDS, "test_set_size").first()  # one row
    head = [F.lit(row[m]).cast("double").alias(m) for m in METRIC_FIELDS] + [F.lit(row["test_set_size"]).cast("bigint").alias("test_set_size")]
    block = F.floor((F.col("engine_id") - 1) / F.lit(engines))
    docs = per_engine.select(*fields).groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("per_engine_predictions"))
    if docs.isEmpty():
        docs = per_engine.sparkSession.range(1).select(F.lit(0).alias("block"), F.array().cast(REPORT_ROWS).alias("per_engine_predictions"))
    docs.orderBy("block").select(*head, "per_engine_predictions").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_report_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(metrics, per-engine rows) of nested documents, one a line; the metrics are one row a report."""
    docs = spark.read.schema(REPORT_SCHEMA).json(path)
    return docs.drop("per_engine_predictions").distinct(), docs.select(F.inline("per_engine_predictions"))


def read_nested_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read a nested single-document report (metrics + per_engine_predictions array)."""
    doc = spark.read.option("multiLine", True).json(path)
    metrics = doc.drop("per_engine_predictions")
    rows = doc.select(F.inline("per_engine_predictions"))
    return metrics, rows


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests: engine_id and a sensor_window array<array<double>>."""
    return spark.read.schema(REQUEST_SCHEMA).json(path)


def window_requests(last_windows: DataFrame, features) -> DataFrame:
    """Turn last-window arrays (array<struct<cycle, features>>) into request rows."""
    row = lambda r: F.array(*[r[f].cast("double") for f in features])
    return last_windows.select(
        F.col("engine_id").cast("bigint").alias("engine_id"),
        F.transform("window", row).alias("sensor_window"),
    )


def append_run_log(spark: SparkSession, rows: DataFrame | list[tuple], path: str) -> None:
    """Append (run_id, step, metric, value) rows to the run log (A10): a table, or the few rows of one curve."""
    log = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, RUN_LOG_SCHEMA)
    log.select(*[F.col(c).cast(kind).alias(c) for c, kind in (f.split() for f in RUN_LOG_SCHEMA.split(", "))]).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
