"""Strict ingest of raw telemetry text to scaled splits, with a table of rejected readings.

Two gates: the frame must have exactly the expected columns and types (``SchemaError`` otherwise), and every
reading must keep the row rules; a reading that breaks one goes to ``rejects`` with the rules' names. The rest is
labelled, split by engine, scaled by statistics of the train engines only, checked again and written.

Lives count accepted readings only: an engine whose last reading is rejected ends at the one before. Test
engines without a truth keep a null label. A train fleet without an accepted reading is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DROP_COLUMNS, RAW_COLUMNS, FleetSpec
from ..functions.scalar import is_missing
from ..operators import labels as LB
from ..operators import quality as Q
from ..operators import scaling as S
from ..session import scan_bytes
from .artefacts import read_splits, write_splits
from .telemetry import DataLoadError, read_telemetry_text

TASK_BYTES = 32 << 20  # of text, which may be compressed
KEYS = ("engine_id", "cycle")
ACCEPTED, REJECTED = "accepted", "rejected"


class SchemaError(ValueError):
    """A frame has missing, extra or differently typed columns."""


def require_schema(df: DataFrame, expected: dict[str, T.DataType]) -> DataFrame:
    """The frame itself, or ``SchemaError`` with everything that differs."""
    issues = Q.schema_issues(df, expected)
    if issues:
        raise SchemaError("; ".join(issues))
    return df


def _types(values: Sequence[str], **others: T.DataType) -> dict[str, T.DataType]:
    return {k: T.LongType() for k in KEYS} | {v: T.DoubleType() for v in values} | others


def check_raw(spark: SparkSession, fleets: dict[str, str | Sequence[str]], out: str, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) readings of ``fleets`` (kind -> paths), each text scanned once into the written table ``out``."""
    values = RAW_COLUMNS[2:]
    with scan_bytes(spark, TASK_BYTES):
        for i, (kind, paths) in enumerate(fleets.items()):
            raw = require_schema(read_telemetry_text(spark, paths, glob=glob), _types(values, source=T.StringType()))
            tagged = Q.quarantine(raw, Q.raw_rules(values)).withColumn("kind", F.lit(kind)).withColumn(
                "verdict", F.when(F.size("violations") == 0, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)))
            tagged.write.mode("overwrite" if i == 0 else "append").partitionBy("verdict", "kind").parquet(out)
    return read_checked(spark, out, ACCEPTED).drop("violations", "source"), read_checked(spark, out, REJECTED)


def read_checked(spark: SparkSession, out: str, verdict: str) -> DataFrame:
    return spark.read.parquet(out).filter(F.col("verdict") == verdict).drop("verdict")  # reads that verdict's folders only


def ingest_fleet(spark: SparkSession, train: str | Sequence[str], test: str | Sequence[str], truth: DataFrame, spec: FleetSpec, out: str,
                 glob: str | None = None) -> None:
    """Writes ``out/checked`` (readings by verdict) and ``out/splits`` (train, val and test, scaled and labelled).

    ``truth`` has engine_id and final_rul, at most one row an engine.
    """
    accepted, _ = check_raw(spark, {"train": train, "test": test}, f"{out}/checked", glob)
    kept = accepted.drop(*DROP_COLUMNS)
    fleet = kept.filter("kind = 'train'").drop("kind")
    ranges = LB.split_ranges(fleet, spec.train_fraction)
    if not ranges[1][1]:
        raise DataLoadError("no accepted reading in the train fleet")
    labelled = LB.assign_split(LB.label_train_rul(fleet, spec.cap), *ranges)
    scaler = S.as_dict(S.scaler_fit(labelled.filter("split = 'train'"), spec.features))  # one row a feature
    known = truth.filter(~is_missing(F.col("final_rul"))).select("engine_id", F.col("final_rul").cast("double").alias("final_rul"))
    tested = LB.label_test_rul(kept.filter("kind = 'test'").drop("kind"), known, spec.cap).withColumn("split", F.lit("test"))
    expected = _types([*spec.features, "rul"], split=T.StringType())
    rules = Q.processed_rules(spec.features, spec.cap)
    unlabelled_ok = [r for r in rules if r[0] != "rul_missing"]
    scaled = []
    for part, checks in ((labelled, rules), (tested, unlabelled_ok)):
        part = require_schema(part.select(*KEYS, *spec.features, "rul", "split"), expected)
        Q.assert_valid(part, checks)
        scaled.append(S.standardise(part, scaler, spec.features))
    write_splits(scaled[0].unionByName(scaled[1]), f"{out}/splits")


def read_ingested(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(splits, rejects) of an ingest."""
    return read_splits(spark, f"{out}/splits"), read_checked(spark, f"{out}/checked", REJECTED)
