"""Quantile edges, histograms and population stability.

Bin edges and reference proportions have at most (bins + 1) values per feature,
so they are collected once and enter plans as literals. Every histogram is one
aggregate pass: for each (feature, bin) a ``count_if`` column, with partial
aggregation per task, so rows are never multiplied by the feature count and a
hot engine or group costs one partial row per task. The tiny (feature, bin)
count tables are then reshaped into PSI with ordinary DataFrame operations.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalar import floor_share
from ..session import scratch_path

DECILES = [i / C.PSI_BINS for i in range(C.PSI_BINS + 1)]
# Standard-normal quantiles at 0.1 .. 0.9 (interior decile edges of N(0, 1)).
NORMAL_DECILES = [NormalDist().inv_cdf(i / C.PSI_BINS) for i in range(1, C.PSI_BINS)]


def quantile_table(df: DataFrame, features: Sequence[str], probs: Sequence[float] = DECILES) -> DataFrame:
    """(feature, pos, edge): exact quantiles with linear interpolation (numpy's default).

    Values are counted per (feature, value) before anything else, so a constant or two-valued
    feature is a few rows whatever the number of readings. The distinct values are cut
    into ranges; only ranges that hold a needed rank are ranked, each within itself, from the
    rows that all earlier ranges of the feature hold. No feature is ever in one task.
    Null and NaN don't count; a feature without values has no rows.
    """
    spark = df.sparkSession
    # features go by their number: shorter keys to hash, shuffle and sort than names
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f).cast("double").alias("x")) for i, f in enumerate(features)])
    values = (df.select(F.inline(pairs)).filter(F.col("x").isNotNull() & ~F.isnan("x"))
              .groupBy("feature", "x").agg(F.count(F.lit(1)).alias("c")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a written step: a reliable checkpoint would compute its rows twice
    path = scratch_path(spark, f"quantiles/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}")
    values.repartitionByRange(n, "feature", "x").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema("feature int, x double, c long, part int").parquet(path)
    sums = ranged.groupBy("feature", "part").agg(F.sum("c").alias("held"))  # at most features x ranges
    upto = Window.partitionBy("feature").orderBy("part")
    sums = sums.withColumn("before", F.sum("held").over(upto) - F.col("held"))
    sums = sums.withColumn("n", F.sum("held").over(Window.partitionBy("feature")))
    place = F.array(*[F.struct(F.lit(i).alias("pos"), ((F.col("n") - 1) * F.lit(float(q))).alias("h")) for i, q in enumerate(probs)])
    wanted = sums.select("feature", "part", "held", "before", F.inline(place))
    needs = (F.floor("h") < F.col("before") + F.col("held")) & (F.ceil("h") >= F.col("before"))
    wanted = wanted.filter(needs).select("feature", "part", "before", "pos", "h")
    rows = ranged.join(wanted.select("feature", "part", "before").distinct(), ["feature", "part"])
    within = Window.partitionBy("feature", "part").orderBy("x")
    rows = rows.withColumn("last", F.col("before") + F.sum("c").over(within) - 1)  # ranks from 0
    ranked = rows.withColumn("first", F.col("last") - F.col("c") + 1).select("feature", "part", "x", "first", "last")
    hit = ranked.join(wanted.select("feature", "part", "pos", "h"), ["feature", "part"])
    low = F.floor("h").between(F.col("first"), F.col("last"))
    high = F.ceil("h").between(F.col("first"), F.col("last"))
    edges = hit.groupBy("feature", "pos").agg(F.max("h").alias("h"), F.max(F.when(low, F.col("x"))).alias("a"),
                                              F.max(F.when(high, F.col("x"))).alias("b"))
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1)
    return edges.select(name.alias("feature"), "pos", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("h") - F.floor("h"))).alias("edge"))


def quantile_edges(df: DataFrame, features: Sequence[str], probs: Sequence[float] = DECILES,
                   accuracy: int | None = None, method: str = "ranked") -> dict[str, list[float]]:
    """Quantiles per feature as lists (bounded by features x probabilities).

    ``method``: ``"ranked"`` is ``quantile_table``; ``"aggregate"`` is Spark's ``percentile``, whose buffer is a
    value -> count map per feature in one task (for data known to be small). ``accuracy`` given:
    ``percentile_approx`` (bounded sketch).
    """
    if accuracy is not None or method == "aggregate":
        p = F.array(*[F.lit(float(x)) for x in probs])
        one = (lambda f: F.percentile_approx(F.col(f), p, accuracy)) if accuracy is not None else (lambda f: F.percentile(F.col(f), p))
        row = df.agg(*[one(f).alias(f) for f in features]).first()
        return {f: [float(v) for v in (row[f] or [])] for f in features}
    if method != "ranked":
        raise ValueError(f"unknown quantile method {method!r}")
    got: dict[str, list[float]] = {f: [] for f in features}
    for r in quantile_table(df, features, probs).orderBy("feature", "pos").collect():
        got[r["feature"]].append(float(r["edge"]))
    return got


def bin_of(x: Column, edges: Sequence[float]) -> Column:
    """Histogram bin on explicit edges: [e_i, e_i+1), last bin closed, outside -> null.

    Equals numpy's histogram: the bin is the last edge <= x; a value on the top
    edge belongs to the last bin; repeated edges give empty bins.
    """
    nb = len(edges) - 1
    if nb < 1:
        return F.lit(None).cast("int")
    inside = (x >= F.lit(edges[0])) & (x <= F.lit(edges[-1]))
    expr = F.when(x >= F.lit(edges[-1]), F.lit(nb - 1))
    for i in range(nb - 1, -1, -1):
        expr = expr.when(x >= F.lit(edges[i]), F.lit(i))
    return F.when(inside, expr)


def bin_on_interior(x: Column, interior: Sequence[float]) -> Column:
    """Bin with -inf and +inf outer edges: number of interior edges <= x; NaN -> null."""
    expr = F.lit(0)
    for e in interior:
        expr = expr + F.when(x >= F.lit(e), F.lit(1)).otherwise(F.lit(0))
    return F.when(~F.isnan(x) & x.isNotNull(), expr)


def count_bins(df: DataFrame, bins: dict[str, tuple[Column, int]], by: Sequence[str] = (),
               when: Column | None = None) -> DataFrame:
    """(by..., feature, bin, n): per-bin counts in one aggregate pass.

    ``bins`` maps feature -> (bin column, number of bins); empty bins get 0.
    Bin indices are projected once, so the aggregate holds only small
    ``count_if(bin == k)`` terms and stays inside generated code.
    """
    wide = _wide_counts(df, bins, by, when)
    rows = [
        F.struct(F.lit(f).alias("feature"), F.lit(k).alias("bin"), F.col(f"c{fi}_{k}").cast("bigint").alias("n"))
        for fi, f in enumerate(bins) for k in range(bins[f][1])
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def _wide_counts(df: DataFrame, bins: dict[str, tuple[Column, int]], by: Sequence[str] = (), when: Column | None = None) -> DataFrame:
    """One row per ``by``: count ``c<feature number>_<bin>`` of every bin of every feature."""
    names = list(bins)
    proj = [F.col(c) for c in by] + [b.alias(f"_b{fi}") for fi, (b, _) in enumerate(bins.values())]
    if when is not None:
        proj.append(when.alias("_w"))
    binned = df.select(*proj)
    aggs = []
    for fi, f in enumerate(names):
        for k in range(bins[f][1]):
            cond = F.col(f"_b{fi}") == k
            if when is not None:
                cond = cond & F.col("_w")
            aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(f"c{fi}_{k}"))
    return binned.groupBy(*by).agg(*aggs) if by else binned.agg(*aggs)


def shares(counts: DataFrame, by: Sequence[str] = (), col: str = "n", out: str = "p") -> DataFrame:
    """p = max(n / max(total, 1), 1e-6) within (by..., feature)."""
    w = Window.partitionBy(*by, "feature")
    return counts.withColumn(out, floor_share(F.col(col), F.sum(col).over(w)))


def psi_sum(df: DataFrame, by: Sequence[str] = (), actual: str = "p_act", expected: str = "p_exp") -> DataFrame:
    """sum over bins of (a - e) * ln(a / e), per (by..., feature)."""
    a, e = F.col(actual), F.col(expected)
    return df.groupBy(*by, "feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))


# --- H1: sample versus sample -----------------------------------------------------

def psi_samples(expected: DataFrame, actual: DataFrame, features: Sequence[str],
                accuracy: int | None = None, deciles: dict[str, list[float]] | None = None) -> DataFrame:
    """PSI of ``actual`` against deciles of ``expected``; outer edges widened by 1e-6;
    values of ``actual`` outside the expected range are not counted (H1).
    ``deciles`` may pass the expected deciles when already known."""
    q = deciles or quantile_edges(expected, features, accuracy=accuracy)
    edges = {}
    for f in features:
        e = list(q[f])
        e[0] -= C.PSI_EPS
        e[-1] += C.PSI_EPS
        edges[f] = e
    bins = {f: (bin_of(F.col(f), edges[f]), len(edges[f]) - 1) for f in features}
    ce = shares(count_bins(expected, bins), col="n", out="p_exp").withColumnRenamed("n", "n_exp")
    ca = shares(count_bins(actual, bins), col="n", out="p_act").withColumnRenamed("n", "n_act")
    both = ce.join(ca, ["feature", "bin"])
    return psi_sum(both)


# --- H2: stored drift reference ------------------------------------------------------

def reference_edges(expected: DataFrame, features: Sequence[str], accuracy: int | None = None,
                    deciles: dict[str, list[float]] | None = None) -> dict[str, list[float]]:
    """Interior edges: unique deciles without the outermost two (H2)."""
    q = deciles or quantile_edges(expected, features, accuracy=accuracy)
    interior = {}
    for f in features:
        uniq = sorted(set(q[f]))
        interior[f] = uniq[1:-1] if len(uniq) > 2 else []
    return interior


def reference_shares(expected: DataFrame, interior: dict[str, list[float]], features: Sequence[str]) -> DataFrame:
    """(feature, pos, bin, lower_edge, upper_edge, ref_pct) of the stored reference (H2).

    Outer bins are open (null edge); shares are floored at 1e-6. A constant
    feature has no interior edge and the single share 1.0.
    """
    bins = {f: (bin_on_interior(F.col(f), interior[f]), len(interior[f]) + 1) for f in features}
    counts = shares(count_bins(expected, bins))
    pos = F.lit(None).cast("bigint")
    lower = F.lit(None).cast("double")
    upper = F.lit(None).cast("double")
    for i, f in enumerate(features):
        e = interior[f]
        is_f = F.col("feature") == f
        pos = F.when(is_f, F.lit(i + 1).cast("bigint")).otherwise(pos)
        if e:
            arr = F.array(*[F.lit(float(v)) for v in e])
            lower = F.when(is_f & (F.col("bin") > 0), F.element_at(arr, F.col("bin"))).otherwise(lower)
            upper = F.when(is_f & (F.col("bin") < len(e)), F.element_at(arr, F.col("bin") + 1)).otherwise(upper)
    return counts.select("feature", pos.alias("pos"), "bin", lower.alias("lower_edge"),
                         upper.alias("upper_edge"), F.col("p").alias("ref_pct"))


def build_reference(expected: DataFrame, features: Sequence[str], accuracy: int | None = None,
                    deciles: dict[str, list[float]] | None = None) -> dict[str, dict]:
    """feature -> {edges: interior edges, ref_pct: floored shares}; bounded, collected."""
    interior = reference_edges(expected, features, accuracy, deciles)
    ref = {f: {"edges": interior[f], "ref_pct": [0.0] * (len(interior[f]) + 1)} for f in features}
    for r in reference_shares(expected, interior, features).collect():
        ref[r["feature"]]["ref_pct"][r["bin"]] = float(r["ref_pct"])
    return ref


def reference_table(spark, ref: dict[str, dict], features: Sequence[str]) -> DataFrame:
    """(feature, pos, bin, lower_edge, upper_edge, ref_pct); open outer edges are null."""
    rows = []
    for i, f in enumerate(features):
        e = ref[f]["edges"]
        for b, p in enumerate(ref[f]["ref_pct"]):
            lo = e[b - 1] if b > 0 else None
            hi = e[b] if b < len(e) else None
            rows.append((f, i + 1, b, lo, hi, float(p)))
    return spark.createDataFrame(
        rows, "feature string, pos bigint, bin int, lower_edge double, upper_edge double, ref_pct double"
    )


# --- H3/H4/H7: cohort versus stored reference -------------------------------------------

def psi_against_reference(actual: DataFrame, ref: dict[str, dict], features: Sequence[str],
                          by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, psi) of each cohort against the stored reference (H3, H4).

    Outer bins are open so nothing is dropped; the cohort shares are floored but
    not renormalised; a feature with fewer than 2 reference shares scores 0.
    All cohorts (the whole fleet, or every engine) come from one grouped pass.
    """
    live = [f for f in features if len(ref[f]["ref_pct"]) >= 2]
    if not live and not by:
        return actual.sparkSession.createDataFrame([(f, 0.0) for f in features], "feature string, psi double")
    bins = {f: (bin_on_interior(F.col(f), ref[f]["edges"]), len(ref[f]["ref_pct"])) for f in live}
    counts = _wide_counts(actual, bins, by) if live else actual.select(*by).distinct()
    # the counts of a cohort lie in one row: no shuffle and no window after the one aggregate
    packed = counts.select(*by, *[F.array(*[F.col(f"c{i}_{k}") for k in range(bins[f][1])]).alias(f"n{i}") for i, f in enumerate(live)])
    packed = packed.select(*by, *[F.struct(F.col(f"n{i}").alias("n"), F.aggregate(f"n{i}", F.lit(0).cast("long"), lambda t, n: t + n).alias("all"))
                                  .alias(f"n{i}") for i in range(len(live))])

    def psi(i: int, shares: Sequence[float]) -> Column:
        terms = F.zip_with(F.col(f"n{i}.n"), F.lit([float(e) for e in shares]), lambda n, e: (
            floor_share(n, F.col(f"n{i}.all")) - e) * F.log(floor_share(n, F.col(f"n{i}.all")) / e))
        return F.aggregate(terms, F.lit(0.0), lambda t, x: t + x)

    rows = [F.struct(F.lit(f).alias("feature"), (psi(live.index(f), ref[f]["ref_pct"]) if f in bins else F.lit(0.0)).alias("psi")) for f in features]
    return packed.select(*by, F.inline(F.array(*rows)))


def gaussian_reference(stats: dict[str, dict], features: Sequence[str]) -> dict[str, dict]:
    """Deciles of N(mean, max(std, 1e-6)) with share 0.1 each; no random draws (H5)."""
    ref = {}
    for f in features:
        mu = float(stats[f]["mean"])
        sd = stats[f]["std"]
        sd = max(float(sd) if sd is not None else 0.0, C.PSI_EPS)
        ref[f] = {"edges": [mu + sd * z for z in NORMAL_DECILES], "ref_pct": [1.0 / C.PSI_BINS] * C.PSI_BINS}
    return ref


# --- E9: equal-width histograms ------------------------------------------------------

def equal_width_histogram(df: DataFrame, col: str, k: int) -> DataFrame:
    """(bin 1..k, lower, upper, n) over [min, max]; max folds into bin k."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    lo, hi = float(lo), float(hi)
    if hi > lo:
        b = F.width_bucket(F.col(col).cast("double"), F.lit(lo), F.lit(hi), F.lit(k))
        b = F.when(b > k, F.lit(k)).otherwise(b)
    else:
        b = F.lit(1)
    aggs = [F.count_if(b == i).cast("bigint").alias(f"b{i}") for i in range(1, k + 1)]
    width = (hi - lo) / k
    rows = [F.struct(F.lit(i).alias("bin"), F.lit(lo + (i - 1) * width).alias("lower"),
                     F.lit(lo + i * width).alias("upper"), F.col(f"b{i}").alias("n")) for i in range(1, k + 1)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
