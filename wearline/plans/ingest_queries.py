"""Registered queries of the strict ingest: the driver's lines as raw text of the 17-feature fleet, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..sources.ingest import ingest_fleet, read_ingested
from ..sources.store import _exists, written_path
from ..sources.telemetry import read_truth_text
from .common import finish
from .fleet import FleetRun
from .queries import _source, query

# Raw text takes most of the ingest's disk: compressed, in files of few lines each, as a compressed file is read by one task.
TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 200_000}
TRUTH_ENGINES = 32  # engines of one truth file: the n-th line is the n-th of them


def raw_lines(rows: DataFrame, kind: str) -> DataFrame:
    """26 columns and two trailing NaN fields a reading, with planted faults: a text, a NaN, a cycle 0, an engine -1."""
    e, c = F.col("engine_id"), F.col("cycle")
    fields = [F.when((e % 13 == 0) & (c % 90 == 2), F.lit("-1")).otherwise(e.cast("string")),
              F.when((e % 11 == 0) & (c % 80 == 2), F.lit("0")).otherwise(c.cast("string")),
              F.col("tax").cast("string"), F.col("linestatus").cast("string"), F.col("setting").cast("string")]
    for i, name in enumerate(C.RAW_COLUMNS[5:], start=1):
        if name in C.DROP_COLUMNS:
            fields.append(F.lit(str(10.5 * i)))
            continue
        value = ((F.col("quantity") * F.lit(float(i))) % F.lit(17.0) + F.col("discount")).cast("string")
        if name == "sensor_2":
            value = F.when((e % 17 == 0) & (c % 50 == 3), F.lit("bad")).otherwise(value)
        if name == "sensor_9":
            value = F.when((e % 19 == 0) & (c % 40 == 5), F.lit("NaN")).otherwise(value)
        fields.append(value)
    return rows.select(F.concat_ws(" ", *fields, F.lit("NaN"), F.lit("NaN")).alias("value"), F.lit(kind).alias("kind"))


def truth_table(spark: SparkSession, sf_dir: str, run: FleetRun) -> DataFrame:
    """Truth files of 32 lines each, written once and read by position: (engine_id, final_rul), NaN where unknown (A3)."""
    def build():
        engine = F.col("engine_id")
        line = F.when(engine % C.TRUTH_SKIP == 0, F.lit("NaN")).otherwise(((engine * C.TRUTH_MULT) % C.TRUTH_MOD).cast("string"))
        rows = spark.range(1, run.ranges[1][1] + 1).withColumnRenamed("id", "engine_id")
        rows = rows.withColumn("dataset", F.floor((engine - 1) / TRUTH_ENGINES).cast("long"))
        return rows.repartition("dataset").sortWithinPartitions("dataset", "engine_id").select(F.concat(F.lit(" "), line, F.lit("  ")).alias("value"), "dataset")

    folder = written_path(spark, "text-truth", [_source(sf_dir, "lineitem")], build, partition_by=("dataset",), fmt="text", spec=TRUTH_ENGINES)
    lines = read_truth_text(spark, folder)
    dataset = F.regexp_extract("source", r"dataset=(\d+)", 1).cast("bigint")
    return lines.select((dataset * TRUTH_ENGINES + F.col("engine_id")).alias("engine_id"), "final_rul")


def ingested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    run = FleetRun(spark, sf_dir)

    def lines():
        return raw_lines(run.rows, "train").unionByName(raw_lines(run.test, "test"))

    source = [_source(sf_dir, "lineitem")]
    folder = written_path(spark, "text-telemetry", source, lines, partition_by=("kind",), fmt="text", spec=TEXT, options=TEXT)
    out = f"{folder}-ingested"
    if not _exists(spark, f"{out}/splits/_SUCCESS"):
        ingest_fleet(spark, f"{folder}/kind=train", f"{folder}/kind=test", truth_table(spark, sf_dir, run), C.TELEMETRY_FLEET, out, glob="*.txt.gz")
    return read_ingested(spark, out)


@query("truth_positions")
def q_truth_positions(spark, sf_dir):
    """Truth files read by position: line n of file d is engine 32 d + n (A3)."""
    return truth_table(spark, sf_dir, FleetRun(spark, sf_dir))


@query("ingest_splits")
def q_ingest_splits(spark, sf_dir):
    """Raw text with planted faults through both gates to labelled, scaled and written splits."""
    splits, _ = ingested(spark, sf_dir)
    return finish(splits.select("split", "engine_id", "cycle", "rul", *C.TELEMETRY_FEATURES))


@query("ingest_rejects")
def q_ingest_rejects(spark, sf_dir):
    """The readings that the gate turned away and the rules each breaks."""
    _, rejects = ingested(spark, sf_dir)
    return rejects.select("kind", "engine_id", "cycle", F.array_join("violations", ",").alias("violations"))
