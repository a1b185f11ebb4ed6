"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.scalar import round_out


def finish(df: DataFrame, bits: int = 20) -> DataFrame:
    """Round every floating column for presentation (engines differ in the last bits)."""
    cols = []
    for fld in df.schema.fields:
        if isinstance(fld.dataType, (DoubleType, FloatType)):
            cols.append(round_out(F.col(fld.name).cast("double"), bits).alias(fld.name))
        else:
            cols.append(F.col(fld.name))
    return df.select(*cols)
