"""Registered queries of artefacts written and read back: report documents, statistics, scoring requests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import scaling as S
from ..session import scratch_path
from ..sources import artefacts as AR
from .common import finish
from .fleet import FleetRun
from .queries import orders_requests, prediction_pairs, query

REPORT_ENGINES = 40  # engines of one report document


def report_path(spark, run: FleetRun) -> str:
    pairs = prediction_pairs(run)
    head = M.forecast_metrics(pairs).select("rmse", "mae", F.col("score").alias("nasa_score"), F.col("n").alias("test_set_size"))
    path = scratch_path(spark, f"reports/{uuid.uuid4().hex}")
    AR.write_nested_report(head, pairs, path, engines=REPORT_ENGINES)
    return path


@query("report_table")
def q_report_table(spark, sf_dir):
    """Per-engine rows of the evaluation report's nested documents, read back."""
    return finish(AR.read_report_documents(spark, report_path(spark, FleetRun(spark, sf_dir)))[1])


@query("model_info")
def q_model_info(spark, sf_dir):
    """The headline metrics read back from the report."""
    return finish(AR.read_report_documents(spark, report_path(spark, FleetRun(spark, sf_dir)))[0])


@query("stats_roundtrip")
def q_stats_roundtrip(spark, sf_dir):
    """Feature statistics written as JSON lines and as one object, and read back from both."""
    run = FleetRun(spark, sf_dir)
    base = scratch_path(spark, f"stats/{uuid.uuid4().hex}")
    stats = S.feature_stats(run.scaled(run.train), run.features)
    AR.write_stats(stats, f"{base}/lines")
    AR.write_stats_object(AR.read_stats(spark, f"{base}/lines"), f"{base}/object")
    forms = {"lines": AR.read_stats(spark, f"{base}/lines"), "object": AR.read_stats_object(spark, f"{base}/object")}
    both = forms["lines"].withColumn("form", F.lit("lines")).unionByName(forms["object"].withColumn("form", F.lit("object")))
    return finish(both)


@query("request_scan")
def q_request_scan(spark, sf_dir):
    """Scoring requests of every customer written as JSON and scanned with their schema."""
    _, requests = orders_requests(spark, sf_dir)
    path = scratch_path(spark, f"requests/{uuid.uuid4().hex}")
    requests.write.json(path)
    got, w = AR.read_requests(spark, path), F.col("sensor_window")
    return finish(got.select("engine_id", F.size(w).cast("bigint").alias("n_rows"), w[0][0].alias("first_value"),
                             F.element_at(w, -1)[0].alias("last_value")))
