"""Dense per-entity ordinals (1..n in a given order) that survive hot entities.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key
to one task; a key holding a third of the data would then be sorted by a single
task. Here the rows are range-partitioned on (key, order), so a hot key is cut
into many contiguous ranges. Each range numbers its rows locally; a small
table of (range, key, count) rows (about keys + ranges rows) turns the local
numbers into per-key numbers with a running sum. The same table gives every
key's total row count (``life``) without another pass over the data.

The range bounds come from sampling, so two plans that each re-derive the
ranges could disagree. The tagged ranges are therefore checkpointed once to
the shared checkpoint folder (``spark.checkpoint.dir``); both consumers read
those files, and the lineage is cut there, which also survives lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def number_within(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    out: str = "cycle",
    total: str | None = "life",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its ``key`` in ``order``.

    ``order`` must make rows unique within a key (as ``row_number`` needs for a
    deterministic result). ``total`` (if given) receives the key's row count.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # An explicit partition count keeps AQE from coalescing these ranges, so
    # both consumers below see the same (range id, local position) pairs.
    tagged = (
        df.repartitionByRange(n, F.col(key), *order_cols)
        .sortWithinPartitions(F.col(key), *order_cols)
        .withColumn("_rng", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    ensure_checkpoint_dir(spark)
    tagged = tagged.checkpoint(eager=True)
    runs = tagged.groupBy("_rng", key).agg(
        F.min("_pos").alias("_base"), F.count(F.lit(1)).alias("_n")
    )
    per_key = Window.partitionBy(key)
    running = per_key.orderBy("_rng").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = [
        "_rng",
        key,
        "_base",
        (F.sum("_n").over(running) - F.col("_n")).alias("_off"),
    ]
    if total:
        offsets.append(F.sum("_n").over(per_key).cast("bigint").alias(total))
    runs = runs.select(*offsets)
    numbered = tagged.join(runs, ["_rng", key]).withColumn(
        out, (F.col("_off") + F.col("_pos") - F.col("_base") + F.lit(1)).cast("bigint")
    )
    return numbered.drop("_rng", "_pos", "_base", "_off")
