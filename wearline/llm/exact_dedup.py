"""Exact dedup by an extendible-hash index on shared files. DataFrame functions only.

A text's key is the 64-bit hash of its normalised form. The index holds one entry per
distinct text: bucket, key, digest, number of rows, the row that stays.

1. Chains: ``groupBy(key, text)`` compares the bytes of texts with equal keys. Equal
   texts meet inside each map task before anything is shuffled, so a text that makes up
   a third of all rows reaches its owner as one row per map task. Different texts
   with one key become different entries of one chain.
2. Directory: a histogram of entries over the leading ``max_depth`` key bits (at most
   2**max_depth rows) drives directory doubling: a bucket over ``bucket_rows`` entries
   splits in two by its next bit, and the directory doubles when a bucket needs more bits
   than it has. A bucket still too full at ``max_depth`` stays one bucket and
   overflows into more files; nothing is dropped.
3. Owner tasks: entries are range-partitioned by (bucket, key); each task writes the
   sorted entries of its key range to the shared folder of ``spark.checkpoint.dir``.
4. Probe: rows join the index on (bucket, key, digest), narrow columns only; Spark
   splits skewed probe partitions.

Defined cases: null text counts as empty; an empty table gives an empty result; null ids
sort lowest (a null id stays only if all ids of its group are null); repeated rows count
one by one, and a repeated id that stays is marked kept on each row that carries it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, lower_ascii, written

BUCKET_ROWS = 65_536
MAX_DEPTH = 16


def directory(histogram: dict[int, int], bucket_rows: int, max_depth: int) -> tuple[int, list[int]]:
    """Directory doubling over entry counts by ``max_depth``-bit prefix.

    Returns the global depth and, per directory slot, its bucket: the smallest
    ``max_depth``-bit prefix the bucket holds.
    """
    sums = {max_depth: dict(histogram)}
    for depth in range(max_depth - 1, -1, -1):
        level: dict[int, int] = {}
        for prefix, n in sums[depth + 1].items():
            level[prefix >> 1] = level.get(prefix >> 1, 0) + n
        sums[depth] = level
    depth, slots = 0, [(0, 0)]  # (local depth, prefix) by slot
    while True:
        full = {b for b in slots if b[0] < max_depth and sums[b[0]].get(b[1], 0) > bucket_rows}
        if not full:
            return depth, [prefix << (max_depth - local) for local, prefix in slots]
        if any(local == depth for local, _ in full):
            slots = [b for b in slots for _ in (0, 1)]
            depth += 1
        slots = [(b[0] + 1, slot >> (depth - b[0] - 1)) if b in full else b for slot, b in enumerate(slots)]


def build_index(keyed: DataFrame, bucket_rows: int, max_depth: int) -> tuple[DataFrame, Column]:
    """The written index over ``keyed`` (id, key, text), and the bucket of a row's key."""
    entries = written(
        keyed.groupBy("key", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", F.unhex(F.sha2("text", 256)).alias("digest"), "keep_id", "group_size"), "entries")
    prefix = F.shiftrightunsigned("key", 64 - max_depth).cast("int")
    counts = entries.groupBy(prefix.alias("p")).count().collect()  # at most 2**max_depth rows
    depth, slots = directory({r["p"]: r["count"] for r in counts}, bucket_rows, max_depth)
    slot = F.shiftrightunsigned("key", 64 - depth).cast("int") if depth else F.lit(0)
    bucket = F.element_at(F.lit(slots), slot + 1)
    n = max(1, len(set(slots)))
    owned = (entries.withColumn("bucket", bucket)
             .repartitionByRange(n, "bucket", "key").sortWithinPartitions("bucket", "key", "digest"))
    return written(owned, "index"), bucket


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, bucket."""
    keyed = docs.select(F.col(id_col).alias("id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("text"))
    index, bucket = build_index(keyed, bucket_rows, max_depth)
    probes = keyed.select("id", "key", F.unhex(F.sha2("text", 256)).alias("digest")).withColumn("bucket", bucket)
    joined = probes.join(index, ["bucket", "key", "digest"], "left")
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "bucket")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""
