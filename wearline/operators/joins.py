"""Joins to small per-key tables with an explicit size check.

A table of one row per engine grows with the fleet, so it is broadcast only
after its row count has been measured under ``max_rows`` (the count stops at
``max_rows + 1``). Above the bound the join is left to the planner (sort-merge,
with AQE splitting skewed partitions). Static size estimates are not trusted:
an aggregate over a big scan looks big even when it holds a handful of rows,
and AQE decides only after both sides have been shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a per-key lookup that may be broadcast (keys plus a few numbers).
BROADCAST_ROWS = 2_000_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def join_lookup(big: DataFrame, small: DataFrame, on, how: str = "inner",
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``big.join(small)``, broadcasting ``small`` only when measured under the bound."""
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
