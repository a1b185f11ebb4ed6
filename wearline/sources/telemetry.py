"""Raw telemetry text, positional truth files and checksum sidecars (A1-A4).

Text is read with ``spark.read.text``: one row per line, split across tasks by
file blocks. Tokens are whitespace runs; leading/trailing blanks give empty
tokens, which are dropped (``trim`` does not strip tabs).
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RAW_COLUMNS
from ..operators.sequence import number_within
from ..session import ship_package


class DataLoadError(ValueError):
    """A source does not have the expected shape."""


class ChecksumError(ValueError):
    """A file does not match its checksum sidecar."""


FIRST_LINES = 200


def _tokens(lines: DataFrame) -> DataFrame:
    # white space to blanks first: a split at one plain character needs no pattern
    plain = reduce(lambda c, blank: F.replace(c, F.lit(blank), F.lit(" ")), "\t\n\x0B\f\r", F.col("value"))
    # lines without a token go by their text: a test on the tokens would be pushed below them and split each line twice
    return lines.filter(F.col("value").rlike(r"[^ \t\n\x0B\f\r]")).select("source", F.array_remove(F.split(plain, " "), "").alias("t"))


def read_telemetry_text(spark: SparkSession, paths: str | Sequence[str],
                        names: Sequence[str] = RAW_COLUMNS, glob: str | None = None) -> DataFrame:
    """Whitespace-separated readings without header (A1, A2).

    Columns missing (null or NaN) in every row are dropped; exactly
    ``len(names)`` must remain. ``engine_id``/``cycle`` become bigint (a value
    that is not a whole number becomes null and fails validation), the rest
    double. One aggregate decides the width and which positions that are missing in the first lines are so in all.
    Short rows are padded with null (and then fail validation). ``glob``
    restricts a folder to its data files (e.g. "*.txt", leaving sidecars out).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(paths).select(F.col("_metadata.file_path").alias("source"), "value")
    toks = _tokens(lines)

    def value(i: int) -> Column:
        return F.get(F.col("t"), i).try_cast("double")

    def measured(rows: DataFrame, positions: Sequence[int]) -> tuple[int, set[int]]:
        """The width, and those of ``positions`` that hold a value in some row."""
        got = rows.agg(F.max(F.size("t")).alias("width"), *[F.count_if(value(i).isNotNull() & ~F.isnan(value(i))).alias(f"p{i}") for i in positions]).first()
        return got["width"] or 0, {i for i in positions if got[f"p{i}"]}

    first = toks.limit(FIRST_LINES)
    near, _ = measured(first, [])
    _, held = measured(first, range(near))
    width, late = measured(toks, [i for i in range(near) if i not in held])  # all lines, positions not decided yet
    held |= late | (measured(toks, range(near, width))[1] if width > near else set())
    vals = [value(i) for i in range(width)]
    keep = sorted(held)
    if len(keep) != len(names):
        raise DataLoadError(f"expected {len(names)} cols after NaN drop, got {len(keep)}")
    cols = []
    for name, i in zip(names, keep):
        v = vals[i]
        if name in ("engine_id", "cycle"):
            whole = v.isNotNull() & ~F.isnan(v) & (v == F.floor(v))
            cols.append(F.when(whole, v.cast("bigint")).alias(name))
        else:
            cols.append(v.alias(name))
    return toks.select("source", *cols)


def read_truth_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(source, engine_id, final_rul): the n-th non-empty line of a file is engine n (A3).

    File order is (block start, position within the block); the skew-safe
    numbering turns it into dense line numbers per file without one task
    reading the whole file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_pos"),
        F.trim(F.col("value")).alias("value"),
    ).filter(F.col("value") != "")
    numbered = number_within(lines, "source", ["_start", "_pos"], out="engine_id", total=None)
    return numbered.select("source", "engine_id", F.col("value").try_cast("double").alias("final_rul"))


CHUNK_BYTES = 4 << 20


DIGESTS = "path string, actual string, n_bytes long, expected string"
OPENS = r"(file|s3|gs|abfs|hdfs):|/"  # stores that Arrow opens


def _opened(path: str) -> tuple[pa_fs.FileSystem, str]:
    if re.match("file:|/", path):
        return pa_fs.LocalFileSystem(), re.sub("^(file:)?/+", "/", path)
    return pa_fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _digest_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path -> SHA-256 of its bytes, their number and the first token of its sidecar (null if there is none). Files are
    read in chunks: a task holds one chunk, whatever the file's size."""
    for b in batches:
        paths = b.column(0).to_pylist()
        digests, sizes, expected = [], [], []
        for path in paths:
            fs, name = _opened(path)
            h, n = hashlib.sha256(), 0
            with fs.open_input_stream(name) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    h.update(chunk)
                    n += len(chunk)
            digests.append(h.hexdigest())
            sizes.append(n)
            try:
                with fs.open_input_stream(f"{name}.sha256") as stream:
                    expected.append(re.split(r"[ \t\n\x0B\f\r]+", stream.read().decode("utf-8", "replace").strip(" "))[0].lower())
            except FileNotFoundError:
                expected.append(None)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(digests, pa.string()), pa.array(sizes, pa.int64()),
                                          pa.array(expected, pa.string())], ["path", "actual", "n_bytes", "expected"])


def _dealt(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """One row a file, dealt over the tasks."""
    ship_package(spark)
    return spark.createDataFrame(rows, schema).repartition(min(len(rows), max(spark.sparkContext.defaultParallelism, len(rows) // 256)))


def file_digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, actual, n_bytes, expected) of each file, ``expected`` from its sidecar; one task per file or few.

    Files of stores that Arrow opens are streamed; those of other Hadoop file systems go through
    Spark's ``binaryFile`` reader, which holds a file in one row (2 GiB at most).
    """
    opens = [p for p in paths if re.match(OPENS, p)]
    rest = [p for p in paths if not re.match(OPENS, p)]
    out = spark.createDataFrame([], DIGESTS)
    if opens:
        out = out.unionByName(_dealt(spark, [(p,) for p in opens], "path string").mapInArrow(_digest_files, DIGESTS))
    if rest:
        data = spark.read.format("binaryFile").load(rest).select("path", F.sha2("content", 256).alias("actual"), F.col("length").alias("n_bytes"))
        out = out.unionByName(data.withColumn("name", _plain(F.col("path"))).join(_sidecars(spark, rest), "name", "left").drop("name"))
    return out


def _sidecars(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(name, expected) of the sidecars that exist."""
    from .store import _exists

    existing = [p for p in (f"{p}.sha256" for p in paths) if _exists(spark, p)]
    if not existing:
        return spark.createDataFrame([], "name string, expected string")
    return spark.read.text(existing, wholetext=True).select(
        _plain(F.regexp_replace(F.col("_metadata.file_path"), r"\.sha256$", "")).alias("name"),
        F.lower(F.split(F.trim(F.col("value")), r"\s+")[0]).alias("expected"))


def checksum_manifest(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, expected, actual, n_bytes, status) with status ok / missing / mismatch (A4).

    The digest is SHA-256 of the file bytes; the sidecar ``<file>.sha256`` holds
    it as its first token. Missing sidecar and mismatch are distinct outcomes.
    """
    status = (F.when(F.col("expected").isNull(), F.lit("missing"))
              .when(F.col("expected") == F.col("actual"), F.lit("ok")).otherwise(F.lit("mismatch")))
    return file_digests(spark, paths).select("path", "expected", "actual", "n_bytes", status.alias("status"))


def _plain(path: Column) -> Column:
    """file:/x, file:///x and /x are one path; names in reports are URL-encoded."""
    return F.regexp_replace(F.try_url_decode(path), r"^file:/+", "/")


def verify_checksums(spark: SparkSession, paths: Sequence[str]) -> None:
    """Raise on the first missing sidecar or mismatch (ingest gate)."""
    bad = checksum_manifest(spark, paths).filter("status != 'ok'").orderBy("path").first()
    if bad and bad.status == "missing":
        raise DataLoadError(f"missing checksum sidecar for {bad.path}")
    if bad:
        raise ChecksumError(f"checksum mismatch for {bad.path}")


def publish_checksums(spark: SparkSession, paths: Sequence[str]) -> None:
    """Write a ``<file>.sha256`` sidecar ("<hex>  <name>") next to every file that has none."""
    write_sidecars(spark, file_digests(spark, paths).filter("expected IS NULL").select("path", F.col("actual").alias("digest")))


def _write_sidecars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sidecar per (path, digest), which appears by a rename; tells how many."""
    for b in batches:
        for path, digest in zip(*(c.to_pylist() for c in b.columns), strict=True):
            fs, name = _opened(path)
            folder, file = name.rsplit("/", 1)
            draft = f"{folder}/_{uuid.uuid4().hex}.draft"
            with fs.open_output_stream(draft) as out:
                out.write(f"{digest}  {path.rsplit('/', 1)[-1]}\n".encode())
            fs.move(draft, f"{folder}/{file}.sha256")
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])


def write_sidecars(spark: SparkSession, digests: DataFrame) -> None:
    """The sidecars of (path, digest), written by the tasks where Arrow opens the store, else by the driver."""
    ship_package(spark)
    digests.filter(F.col("path").rlike(f"^({OPENS})")).mapInArrow(_write_sidecars, "n long").agg(F.sum("n")).collect()
    for r in digests.filter(~F.col("path").rlike(f"^({OPENS})")).toLocalIterator():
        write_sidecar(spark, r.path, r.digest)


def write_sidecar(spark: SparkSession, path: str, digest: str) -> None:
    from .store import _fs

    fs, jpath = _fs(spark, f"{path}.sha256")
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(f"{digest}  {path.rsplit('/', 1)[-1]}\n".encode()))
    finally:
        out.close()


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Data files of a written table, also of its partition folders (names only, many folders are listed by tasks)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(folder).inputFiles()
    return sorted(re.sub("^file:/+", "file:/", unquote(p)) for p in found)
