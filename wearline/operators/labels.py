"""Remaining-life labels, entity splits and the synthetic test cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import cap_at
from .joins import join_lookup


def with_life(df: DataFrame, key: str = "engine_id", cycle: str = "cycle") -> DataFrame:
    """Attach ``life`` = the engine's last cycle.

    Fleet views already carry it. Otherwise it is a grouped max (partial
    aggregation, so a hot engine costs one row per map task) joined back: broadcast
    when measured small, so the readings are not shuffled for it, else left to AQE,
    which splits a skewed engine's partition.
    """
    if "life" in df.columns:
        return df
    lives = df.groupBy(key).agg(F.max(cycle).cast("bigint").alias("life"))
    return join_lookup(df, lives, key)


def label_train_rul(df: DataFrame, cap: float = C.RUL_CAP, out: str = "rul") -> DataFrame:
    """rul = min(life - cycle, cap) as double."""
    d = with_life(df)
    remaining = (F.col("life") - F.col("cycle")).cast("double")
    return d.withColumn(out, cap_at(remaining, cap))


def label_raw_and_capped(df: DataFrame, cap: float = C.RUL_CAP) -> DataFrame:
    """Uncapped ``rul_raw`` beside capped ``rul``."""
    d = with_life(df)
    remaining = (F.col("life") - F.col("cycle")).cast("double")
    return d.withColumn("rul_raw", remaining).withColumn("rul", cap_at(remaining, cap))


def train_upper_bound(df: DataFrame, fraction: float) -> int:
    """Highest train engine id = floor(fraction * max id); one scalar to the driver."""
    top = df.agg(F.max("engine_id")).first()[0]
    return int(fraction * int(top or 0))


def split_ranges(df: DataFrame, fraction: float) -> tuple[tuple[int, int], tuple[int, int]]:
    """Train ids 1..hi and validation ids hi+1..max, never by row."""
    top = int(df.agg(F.max("engine_id")).first()[0] or 0)
    hi = int(fraction * top)
    return (1, hi), (hi + 1, top)


def assign_split(df: DataFrame, train: tuple[int, int], val: tuple[int, int]) -> DataFrame:
    e = F.col("engine_id")
    return df.withColumn(
        "split",
        F.when(e.between(*train), F.lit("train")).when(e.between(*val), F.lit("val")),
    )


def split_leakage(df: DataFrame) -> DataFrame:
    """Engine ids present on both sides of the split (must be empty)."""
    train_ids = df.filter(F.col("split") == "train").select("engine_id")
    val_ids = df.filter(F.col("split") == "val").select("engine_id")
    return train_ids.intersect(val_ids)


def split_bounds(df: DataFrame) -> DataFrame:
    """min / max engine id, rows and engines per split."""
    return df.filter(F.col("split").isNotNull()).groupBy("split").agg(
        F.min("engine_id").alias("min_engine"),
        F.max("engine_id").alias("max_engine"),
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("engine_id").alias("n_engines"),
    )


def test_cut(engine_id) -> F.Column:
    return (engine_id * F.lit(C.TRUTH_MULT)) % F.lit(C.TRUTH_MOD)


def truncate_for_test(df: DataFrame) -> DataFrame:
    """Test histories: engine e loses its last c(e) cycles; life shrinks with it."""
    d = with_life(df)
    cut = test_cut(F.col("engine_id"))
    return d.filter(F.col("cycle") <= F.col("life") - cut).withColumn(
        "life", (F.col("life") - cut).cast("bigint")
    )


def synthetic_truth(df: DataFrame) -> DataFrame:
    """Truth rows (engine_id, final_rul = c(e)); engines with e mod 10 = 0 have none."""
    roster = df.select("engine_id").distinct()
    return roster.filter(F.col("engine_id") % F.lit(C.TRUTH_SKIP) != 0).select(
        "engine_id", test_cut(F.col("engine_id")).cast("double").alias("final_rul")
    )


def label_test_rul(test: DataFrame, truth: DataFrame, cap: float = C.RUL_CAP, out: str = "rul") -> DataFrame:
    """rul = min(final_rul + life - cycle, cap); engines without truth keep null.

    The truth table has one row per engine: broadcast after a size check.
    """
    d = join_lookup(with_life(test), truth, "engine_id", "left")
    remaining = F.col("final_rul") + (F.col("life") - F.col("cycle")).cast("double")
    return d.withColumn(out, cap_at(remaining, cap)).drop("final_rul")
