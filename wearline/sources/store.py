"""Written tables in the shared checkpoint folder.

A fleet view is derived once per source snapshot and written as parquet; every
later query reads the written table, as the processed splits are read by all
downstream steps. The table name carries the paths, lengths and modification times of all
source files and the parameters of the step, so a change of either gives a new table. A write goes to a fresh folder first and is
published by a marker file, so a half-written table is never read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def _fingerprint(spark: SparkSession, paths: list[str], spec: object = None) -> str:
    """Digest of every source file (path, length, modification time; any Hadoop filesystem) and of ``spec``."""
    h = hashlib.sha256(repr(spec).encode())
    for p in sorted(paths):
        h.update(p.encode())
        fs, jpath = _fs(spark, p)
        if not fs.exists(jpath):
            h.update(b"?")
            continue
        files, found = fs.listFiles(jpath, True), []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
        for line in sorted(found):
            h.update(line.encode())
    return h.hexdigest()[:16]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def written_path(
    spark: SparkSession,
    name: str,
    sources: list[str],
    build: Callable[[], DataFrame],
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    spec: object = None,
    options: dict[str, object] | None = None,
) -> str:
    """Path of table ``name`` for these sources and this ``spec``, building and writing it (with the writer's ``options``) if absent."""
    root = scratch_path(spark, f"{name}-{_fingerprint(spark, sources, spec)}")
    pointer = f"{root}/_CURRENT"
    current = _read_pointer(spark, pointer)
    if current and _exists(spark, current):
        return current
    target = f"{root}/{uuid.uuid4().hex}"
    writer = build().write.mode("overwrite").options(**(options or {}))
    if partition_by:
        # tasks move their own files into place: the marker below publishes, not the committer
        writer = writer.partitionBy(*partition_by).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.format(fmt).save(target)
    _write_pointer(spark, pointer, target)
    return target


def materialized(
    spark: SparkSession,
    name: str,
    sources: list[str],
    build: Callable[[], DataFrame],
    partition_by: tuple[str, ...] = (),
    spec: object = None,
) -> DataFrame:
    """Read table ``name`` for these sources and this ``spec``, building and writing it if absent."""
    return spark.read.parquet(written_path(spark, name, sources, build, partition_by, spec=spec))


def _read_pointer(spark: SparkSession, pointer: str) -> str | None:
    fs, jpath = _fs(spark, pointer)
    if not fs.exists(jpath) or not fs.getFileStatus(jpath).isFile():
        return None
    stream = fs.open(jpath)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    return line.strip() if line else None


def _write_pointer(spark: SparkSession, pointer: str, target: str) -> None:
    """Publish ``target``: write a temporary marker, then rename it into place."""
    fs, jpath = _fs(spark, pointer)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{pointer}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(target.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(jpath):
        fs.delete(jpath, True)
    fs.rename(tmp, jpath)
