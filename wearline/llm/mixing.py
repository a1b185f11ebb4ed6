"""Mixing sources to target weights with hash-threshold histograms.

Sources, in code-point order with null last, weigh 1, 2, 3, repeating. They share all sizes by
weight; a target stops at ``MAX_REPEAT`` times its source's size and the excess is reshared
by weight until none is above.

A target of r times its source takes every document floor(r) times, and once more the
documents whose hash lies below a threshold. The thresholds are nested: a larger target
of the same source keeps every copy of a smaller one.

1. Histogram: sizes are summed by source and leading hash bits (``BITS`` per level).
2. Budget: running sums over the buckets of a source (at most 2**BITS rows) give the
   bucket in which its budget ends.
3. Refinement: only the rows of boundary buckets are summed again, by the next bits, until
   a boundary bucket holds one hash value or all ``HASH_BITS`` bits are used.
4. Documents are taken by comparing their hash with their source's threshold: no sort.

The hash is the first 60 bits of the MD5 of the id, so reruns agree. The hash value at the
boundary is taken if that comes nearer to the budget (documents with one id go together).

Defined cases: null text has size 0; null source is a source of its own; a source of
size 0 has target 0 and takes nothing; a null id is hashed as the empty string; repeated
rows count one by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, documents, written

MAX_REPEAT = 3
WEIGHTS = 3
HASH_BITS = 60
BITS = 12


def hash_of(id_col: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of (source, source_size); one row per source throughout.

    Resharing ends where target = min(limit, share * weight) with one share for all:
    sources are capped in order of limit / weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = sizes.withColumn("weight", (F.row_number().over(order) - 1) % WEIGHTS + 1)
    w = w.withColumn("top", F.col("source_size") * MAX_REPEAT)
    everything = Window.partitionBy(F.lit(1))
    below = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = below.rowsBetween(Window.unboundedPreceding, -1)
    after = below.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(before), F.lit(0))
    w = w.withColumn("share", rest.cast("double") / F.sum("weight").over(after))
    w = w.withColumn("capped", F.col("top") <= F.col("share") * F.col("weight"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("top") / F.col("weight"), "share"))).over(everything)["share"]
    free = F.least(F.col("top").cast("double"), level * F.col("weight"))
    return w.withColumn("level", level).select(
        "source", "source_size", F.when(F.col("capped") | F.col("level").isNull(), F.col("top").cast("double"))
        .otherwise(free).alias("target"))


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be null."""
    right = b.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in b.columns])
    on = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in keys]
    return a.join(right, on, how).drop(*[f"r_{c}" for c in keys])


def thresholds(sized: DataFrame, budget: DataFrame, bits: int = BITS) -> DataFrame:
    """source, below: hashes under ``below`` are taken once more.

    ``budget`` has source and extra (how much the extra copies may sum to).
    """
    spent = budget.select("source", "extra", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("used"))
    open_rows, done = sized, None
    used_bits = 0
    while True:
        width = min(bits, HASH_BITS - used_bits)
        used_bits += width
        shift = HASH_BITS - used_bits
        hist = (open_rows.withColumn("bucket", F.shiftright("hash", shift)).groupBy("source", "bucket")
                .agg(F.sum("size").alias("size"), F.min("hash").alias("lo"), F.max("hash").alias("hi")))
        run = Window.partitionBy("source").orderBy("bucket")
        level = _same(hist, spent.select("source", "extra", "used"), ["source"], "inner")
        level = level.withColumn("upto", F.col("used") + F.sum("size").over(run))
        edge = (level.filter(F.col("upto") > F.col("extra")).groupBy("source")
                .agg(F.min_by(F.struct("bucket", "extra", "size", "lo", "hi", "upto"), "bucket").alias("e")).select("source", "e.*"))
        edge = written(edge.withColumn("used", F.col("upto") - F.col("size")), "edge")
        one = F.lit(shift == 0) | (F.col("lo") == F.col("hi"))
        nearer = F.col("upto") - F.col("extra") <= F.col("extra") - F.col("used")
        ended = edge.filter(one).select("source", F.when(nearer, F.col("hi") + 1).otherwise(F.col("lo")).alias("below"))
        done = ended if done is None else done.unionByName(ended)
        spent = edge.filter(~one).select("source", "extra", "bucket", "used")
        if shift == 0 or spent.isEmpty():
            break
        inside = spent.select("source", F.shiftleft("bucket", shift).alias("from"),
                              F.shiftleft(F.col("bucket") + 1, shift).alias("to"))
        rows = _same(sized, inside, ["source"], "inner").filter((F.col("hash") >= F.col("from")) & (F.col("hash") < F.col("to")))
        open_rows = rows.select("source", "hash", "size")
    return written(done, "thresholds")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), hash_of(F.col(id_col)).alias("hash"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size")), "sizes")


def _plan(sized: DataFrame, bits: int) -> DataFrame:
    """Per source: source_size, target, full (copies of every document), below (threshold of one more)."""
    goal = written(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("full", full)
    budget = goal.withColumn("extra", F.col("target") - F.col("full") * F.col("source_size")).select("source", "extra")
    cut = thresholds(sized.select("source", "hash", "size").filter("size > 0"), budget, bits)
    return written(_same(goal, cut, ["source"], "left"), "plan")


def _repeats(full: Column, below: Column, hash_col: Column) -> Column:
    return full + F.coalesce((hash_col < below).cast("long"), F.lit(0).cast("long"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                bits: int = BITS) -> DataFrame:
    """Per row of ``docs``: id, source, size, source_size, target, repeats, taken."""
    sized = _sized(docs, id_col, text_col, source_col)
    out = _same(sized, _plan(sized, bits), ["source"], "left")
    out = out.withColumn("repeats", _repeats(F.col("full"), F.col("below"), F.col("hash")))
    return out.select(F.col("doc_id").alias(id_col), "source", "size", "source_size", "target", "repeats",
                      (F.col("size") * F.col("repeats")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               bits: int = BITS) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``."""
    plan = _plan(_sized(docs, id_col, text_col, source_col), bits).select(
        F.col("source").alias("mix_source"), F.struct("full", "below").alias("mix_plan"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    given = rows.withColumn("given", F.col("row").getField(source_col).cast("string"))
    joined = given.join(plan, F.col("given").eqNullSafe(F.col("mix_source")))
    repeats = _repeats(F.col("mix_plan.full"), F.col("mix_plan.below"), hash_of(F.col("row").getField(id_col)))
    times = joined.withColumn("times", repeats).filter("times > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


#: Over a relation ``docs_in`` (doc_id, text, source); also used by the pipeline.
MIX_SQL = r"""
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM docs_in),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS top, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER
             (ORDER BY 3 * source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (ORDER BY 3 * source_size / w, source IS NULL, source
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM s),
lv AS (SELECT min_by(rest::DOUBLE / ws::DOUBLE, top::DOUBLE / w) AS share FROM o WHERE NOT (top <= rest::DOUBLE / ws::DOUBLE * w)),
t AS (SELECT source, source_size, coalesce(least(top::DOUBLE, share * w), top::DOUBLE) AS target FROM o, lv),
f AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS k FROM t),
hs AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
hc AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto FROM hs WHERE size > 0),
ed AS (SELECT f.source, min(h) AS edge FROM f JOIN hc ON f.source IS NOT DISTINCT FROM hc.source
       WHERE upto > target - k * source_size GROUP BY f.source),
th AS (SELECT ed.source, CASE WHEN upto - (target - k * source_size) <= (target - k * source_size) - (upto - size)
                              THEN edge + 1 ELSE edge END AS below
       FROM ed JOIN hc ON ed.source IS NOT DISTINCT FROM hc.source AND hc.h = ed.edge
               JOIN f ON ed.source IS NOT DISTINCT FROM f.source),
mixed AS (SELECT doc_id, size, source_size, target, k + (below IS NOT NULL AND h < below)::BIGINT AS repeats
          FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source LEFT JOIN th ON d.source IS NOT DISTINCT FROM th.source)
"""
OP5_SQL = f"""
WITH docs_in AS (SELECT doc_id, text, source FROM documents),
{MIX_SQL}
SELECT doc_id, size, source_size, target, size * repeats AS taken FROM mixed
"""
