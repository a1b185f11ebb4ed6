"""Helpers shared by the training-data operators: text columns and written steps.

Words are runs of characters outside ``[\\x20\\x09-\\x0D]``; lower-casing touches A-Z only.
"""

from __future__ import annotations

import atexit
import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import BATCH_BYTES, PLAN_CONF, ensure_checkpoint_dir, scratch_path, ship_package
from ..sources.tables import read_table

BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
_CLEANED: set[str] = set()


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", *columns)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else. ``lower`` does the same for texts of ASCII only, and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """The words of a text in order; an empty array for null or blank texts."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, GAP))


def _root(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    root = scratch_path(spark, f"llm/{spark.sparkContext.applicationId}")
    if root not in _CLEANED:
        _CLEANED.add(root)
        atexit.register(_remove, spark, root)
    return root


def _remove(spark: SparkSession, root: str) -> None:
    """Steps written by an application go with it (a lost driver leaves them behind)."""
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session has ended before
        return


def step_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{_root(spark)}/{uuid.uuid4().hex}-{name}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a step as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, and rows computed
    once are the same for every later step. Parquet looks at a page's size only every 100 rows; of rows as large as
    blocks, such pages (and the codec's buffers outside the heap, which are as large) take hundreds of MB.
    """
    path = step_path(df.sparkSession, name)
    to = df.write.option("parquet.page.size.row.check.min", 1)
    to.partitionBy(*partition_by).parquet(path) if partition_by else to.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession) -> None:
    """Python workers can import this package (see ``session.ship_package``) and get batches cut by their bytes.

    The operators see to it themselves: a stage of the pipeline may be called without the entry's settings.
    """
    ship_package(spark)
    spark.conf.set(BATCH_BYTES, PLAN_CONF[BATCH_BYTES])


def spare_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't use yet (extra columns may clash)."""
    names = {c.lower() for c in df.columns}
    while base.lower() in names:
        base = f"_{base}"
    return base
