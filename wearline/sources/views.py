"""Fleet views over the driver's tables.

Each view yields ``engine_id bigint, cycle bigint, life bigint`` plus the fleet's
feature columns as doubles. ``cycle`` is the 1-based position of the reading in
the engine's history and ``life`` the engine's number of readings (its last
cycle). Cycles are dense, so ``life`` equals ``max(cycle)`` per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EVENTS_FLEET, LINEITEM_FLEET, ORDERS_FLEET, FleetSpec
from ..operators.sequence import number_within
from .store import written_path
from .tables import read_table


def lineitem_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One engine per supplier; one cycle per shipped line, in ship order."""
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
    )
    base = li.select(
        (F.col("l_suppkey") + F.lit(1)).cast("bigint").alias("engine_id"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_extendedprice").cast("double").alias("extendedprice"),
        F.col("l_discount").cast("double").alias("discount"),
        F.col("l_tax").cast("double").alias("tax"),
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("linestatus"),
        F.lit(100.0).alias("setting"),
    )
    numbered = number_within(
        base, "engine_id", ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    )
    return numbered.select("engine_id", "cycle", "life", *LINEITEM_FLEET.features)


def events_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One engine per user; one cycle per event in time order."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    base = ev.select(
        (F.col("user_id") + F.lit(1)).cast("bigint").alias("engine_id"),
        "ts", "event_id",
        F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("is_error"),
    )
    numbered = number_within(base, "engine_id", ["ts", "event_id"])
    return numbered.select("engine_id", "cycle", "life", *EVENTS_FLEET.features)


def orders_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One engine per customer; one cycle per order in date order."""
    od = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    base = od.select(
        (F.col("o_custkey") + F.lit(1)).cast("bigint").alias("engine_id"),
        "o_orderdate", "o_orderkey",
        F.col("o_totalprice").cast("double").alias("totalprice"),
    )
    numbered = number_within(base, "engine_id", ["o_orderdate", "o_orderkey"])
    return numbered.select("engine_id", "cycle", "life", *ORDERS_FLEET.features)


FLEET_VIEWS = {
    LINEITEM_FLEET.name: (LINEITEM_FLEET, lineitem_fleet),
    EVENTS_FLEET.name: (EVENTS_FLEET, events_fleet),
    ORDERS_FLEET.name: (ORDERS_FLEET, orders_fleet),
}


FLEET_SOURCES = {
    LINEITEM_FLEET.name: "lineitem",
    EVENTS_FLEET.name: "events",
    ORDERS_FLEET.name: "orders",
}


def fleet_view_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Path of the fleet's written view (immutable; derived once per source snapshot)."""
    spec, fn = FLEET_VIEWS[name]
    source = f"{sf_dir.rstrip('/')}/{FLEET_SOURCES[name]}.parquet"

    def build() -> DataFrame:
        # sorted files give tight engine_id ranges per row group for pushdown
        return fn(spark, sf_dir).sortWithinPartitions("engine_id", "cycle")

    return written_path(spark, f"fleet-{name}", [source], build, spec=spec)


def fleet_view(spark: SparkSession, sf_dir: str, name: str) -> tuple[FleetSpec, DataFrame]:
    """The fleet's view, derived once per source snapshot and read back."""
    spec, _ = FLEET_VIEWS[name]
    return spec, spark.read.parquet(fleet_view_path(spark, sf_dir, name))
