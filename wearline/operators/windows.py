"""Ordered windows over engine histories.

Frames are never partitioned by the engine alone: a hot engine would land in
one task. Cycles are cut into blocks of ``spec.block`` cycles and each block
also receives the previous block's last L-1 rows, so every frame of L rows lies
inside one (engine, block) partition. Only the block's own rows are emitted.
Cost: (L-1)/block extra rows, and a hot engine spreads over life/block tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BAD_READING, FleetSpec
from ..functions.scalar import any_not_finite, not_finite
from .labels import with_life


def _blocked(df: DataFrame, spec: FleetSpec) -> DataFrame:
    b, L = spec.block, spec.window
    if L - 1 > b:
        raise ValueError("block must be at least window - 1 cycles")
    home = F.floor((F.col("cycle") - 1) / F.lit(b)).cast("bigint")
    tail = (F.col("cycle") - 1) % F.lit(b) >= F.lit(b - (L - 1))
    blocks = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn("_home", home).withColumn("_blk", F.explode(blocks))


ROWS_PER_TASK = 250_000  # a task's sorts and buffers stay of one size while the table grows


def _dealt(df: DataFrame, blocked: DataFrame) -> DataFrame:
    """``blocked`` by (engine, block) over as many tasks as its rows need; a small table is left to the planner."""
    tasks = -(-df.count() // ROWS_PER_TASK)
    few = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocked if tasks <= few else blocked.repartition(tasks, "engine_id", "_blk")


def frame(spec: FleetSpec) -> Window:
    """The L-row frame ending at the current cycle, inside one (engine, block)."""
    return (
        Window.partitionBy("engine_id", "_blk")
        .orderBy("cycle")
        .rowsBetween(-(spec.window - 1), Window.currentRow)
    )


def with_frames(df: DataFrame, spec: FleetSpec, columns: dict, full_only: bool = True) -> DataFrame:
    """Add frame-aggregate ``columns`` (name -> Column over ``frame``); keep owned rows.

    ``full_only`` keeps frames of exactly L rows (cycle >= L): full windows only.
    """
    d = _blocked(df, spec)
    for name, col in columns.items():
        d = d.withColumn(name, col)
    d = d.filter(F.col("_blk") == F.col("_home"))
    if full_only:
        d = d.filter(F.col("cycle") >= spec.window)
    return d.drop("_blk", "_home")


def sliding_windows(df: DataFrame, spec: FleetSpec, target: str | None = "rul") -> DataFrame:
    """Every full L-cycle window, stride 1 (D1), with the label of its last row.

    Output: engine_id, cycle (window end), window array<struct<cycle, features>>
    in cycle order, and ``target``. A struct is collected (not bare values) so a
    null reading keeps its slot.
    """
    w = frame(spec)
    reading = F.struct(F.col("cycle"), *[F.col(f) for f in spec.features])
    d = with_frames(df, spec, {"window": F.collect_list(reading).over(w)})
    keep = ["engine_id", "cycle", "window"] + ([target] if target and target in df.columns else [])
    return d.select(*keep)


def frame_stats(df: DataFrame, spec: FleetSpec, stats: tuple[str, ...] = ("mean",)) -> DataFrame:
    """``<f>_mean`` and, as asked for, ``<f>_std`` (population) and ``<f>_slope`` (vs cycle) of every full L-cycle window,
    next to its last row, and ``reason``: null, or why the window must not be scored (its statistics are null then).

    A block's cycles are cut into segments of L. A window is the end of one segment and the start of the next: the
    sums of the segment before less its running sums L rows back, plus the running sums up to here. So a row costs the
    same at every L, and no sum spans more than L rows of values centred on the block's first good reading: constant
    windows have sums of exact zeros, and neither a large level nor a long history costs digits.
    A reading that is null, NaN or infinite adds nothing to the sums but one to their count of bad rows.
    """
    L, feats = spec.window, spec.features
    block = Window.partitionBy("engine_id", "_blk").orderBy("cycle")
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    whole = block.rowsBetween(*everything)
    segment = Window.partitionBy("engine_id", "_blk", "_seg").orderBy("cycle")
    good = {f: F.when(~not_finite(F.col(f)), F.col(f)) for f in feats}
    d = _dealt(df, _blocked(df, spec))
    d = d.select("*", (F.col("cycle") - F.first("cycle").over(whole)).alias("_i"),
                 *[F.first(good[f], ignorenulls=True).over(whole).alias(f"_c_{f}") for f in feats])
    d = d.select("*", F.floor(F.col("_i") / L).alias("_seg"), (F.col("_i") % L).alias("_j"), any_not_finite(feats).cast("long").alias("_bad"),
                 *[F.coalesce(good[f] - F.col(f"_c_{f}"), F.lit(0.0)).alias(f"_y_{f}") for f in feats])
    sums = {"bad": F.col("_bad")}
    for f in feats:
        y = F.col(f"_y_{f}")
        sums[f"y_{f}"] = y
        if "std" in stats:
            sums[f"yy_{f}"] = y * y
        if "slope" in stats:
            sums[f"jy_{f}"] = F.col("_j") * y
    upto, total = segment.rowsBetween(Window.unboundedPreceding, Window.currentRow), segment.rowsBetween(*everything)
    d = d.select("*", *[F.sum(c).over(upto).alias(f"_b_{k}") for k, c in sums.items()],
                 *[F.sum(c).over(total).alias(f"_t_{k}") for k, c in sums.items()])
    # segments ascend with the cycle: this is the block's order by cycle, and the one the rows are sorted in already
    block = Window.partitionBy("engine_id", "_blk").orderBy("_seg", "cycle")
    before = {k: F.lag(F.col(f"_t_{k}") - F.col(f"_b_{k}"), L).over(block) for k in sums}
    d = d.select("*", *[F.coalesce(c, F.lit(0)).alias(f"_a_{k}") for k, c in before.items()])
    d = d.filter((F.col("_blk") == F.col("_home")) & (F.col("cycle") >= L))

    def both(k: str) -> Column:
        return F.col(f"_a_{k}") + F.col(f"_b_{k}")

    ok, out = both("bad") == 0, []
    for f in feats:
        y = both(f"y_{f}")
        out.append(F.when(ok, F.col(f"_c_{f}") + y / L).alias(f"{f}_mean"))
        if "std" in stats:
            square = both(f"yy_{f}") - y * y / L
            out.append(F.when(ok, F.sqrt(F.when(square > 1e-14 * both(f"yy_{f}"), square).otherwise(0.0) / L)).alias(f"{f}_std"))
        if "slope" in stats:  # offsets in the window: _j - p - 1 before the segment's start, _j - p + L - 1 in it
            p, half = F.col("_j"), (L - 1) / 2
            lever = F.col(f"_a_jy_{f}") - (p + 1 + half) * F.col(f"_a_y_{f}") + F.col(f"_b_jy_{f}") + (half - p) * F.col(f"_b_y_{f}")
            out.append(F.when(ok, lever / (L * (L * L - 1) / 12)).alias(f"{f}_slope"))
    return d.select(*df.columns, *out, F.when(~ok, F.lit(BAD_READING)).alias("reason"))


def window_features(df: DataFrame, spec: FleetSpec, method: str = "sums", reason: bool = False) -> DataFrame:
    """Per full window: last, mean, population std and slope vs cycle of each feature.

    ``method="sums"`` (default) puts windows together from running sums (``frame_stats``), without Python; a window
    with a bad reading has nulls, and ``reason`` adds the column that says so. ``"numpy"`` runs a
    sliding view per bounded (engine, block) group, ``"frames"`` Spark's sliding frames, ``"lags"``
    offset frames plus one projection. All give the same values for good readings.
    """
    if method == "numpy":
        return window_features_numpy(df, spec)
    if method == "lags":
        return window_features_lagged(df, spec)
    if method == "sums":
        d = frame_stats(df, spec, ("mean", "std", "slope"))
        good = F.col("reason").isNull()
    else:
        w = frame(spec)
        cols = {}
        for f in spec.features:
            cols[f"{f}_mean"] = F.avg(f).over(w)
            cols[f"{f}_std"] = F.stddev_pop(f).over(w)
            cols[f"{f}_slope"] = F.regr_slope(F.col(f), F.col("cycle").cast("double")).over(w)
        d, good = with_frames(df, spec, cols), F.lit(True)
    out = ["engine_id", "cycle"]
    for f in spec.features:
        out += [F.when(good, F.col(f)).alias(f"{f}_last"), f"{f}_mean", f"{f}_std", f"{f}_slope"]
    out += [c for c in ("rul",) if c in df.columns] + ["reason"] * (reason and method == "sums")
    return d.select(*out)


def window_features_lagged(df: DataFrame, spec: FleetSpec) -> DataFrame:
    """Same output as ``window_features`` for dense cycles, from L ``lag`` columns.

    Each lag is an O(1) offset frame; mean, two-pass population std and the
    least-squares slope (cycles are consecutive, so the centred cycle offsets are
    fixed weights) are then one generated projection per row.
    """
    L = spec.window
    d = _blocked(df, spec)
    w = Window.partitionBy("engine_id", "_blk").orderBy("cycle")
    lags = [F.lag(f, L - 1 - j).over(w).alias(f"{f}__{j}") for f in spec.features for j in range(L)]
    d = d.select("*", *lags).filter((F.col("_blk") == F.col("_home")) & (F.col("cycle") >= L))
    t = [j - (L - 1) / 2 for j in range(L)]
    tt = sum(x * x for x in t)
    out = ["engine_id", "cycle"]
    for f in spec.features:
        xs = [F.col(f"{f}__{j}") for j in range(L)]
        d = d.withColumn(f"{f}_mean", sum(xs[1:], xs[0]) / F.lit(float(L)))
        m = F.col(f"{f}_mean")
        sq = [(x - m) * (x - m) for x in xs]
        var = sum(sq[1:], sq[0]) / F.lit(float(L))
        terms = [x * F.lit(t[j]) for j, x in enumerate(xs)]
        slope = sum(terms[1:], terms[0]) / F.lit(tt)
        out += [F.col(f).alias(f"{f}_last"), f"{f}_mean", F.sqrt(var).alias(f"{f}_std"), slope.alias(f"{f}_slope")]
    if "rul" in df.columns:
        out.append("rul")
    return d.select(*out)


def window_features_numpy(df: DataFrame, spec: FleetSpec) -> DataFrame:
    """``window_features`` computed per (engine, cycle block) group with numpy.

    Groups are the same bounded blocks (block + L - 1 rows at most), moved as
    Arrow batches; every full window's mean, population std and least-squares
    slope against its cycles come from a vectorised sliding view.
    """
    from ..session import ship_package

    ship_package(df.sparkSession)
    L = spec.window
    feats = list(spec.features)
    has_rul = "rul" in df.columns
    d = _blocked(df.select("engine_id", "cycle", *feats, *(["rul"] if has_rul else [])), spec)
    fields = ["engine_id bigint", "cycle bigint"]
    for f in feats:
        fields += [f"{f}_last double", f"{f}_mean double", f"{f}_std double", f"{f}_slope double"]
    if has_rul:
        fields.append("rul double")
    schema = ", ".join(fields)

    def run(pdf):
        import numpy as np
        import pandas as pd
        from numpy.lib.stride_tricks import sliding_window_view

        pdf = pdf.sort_values("cycle")
        n = len(pdf)
        if n < L:
            return pd.DataFrame({c.split()[0]: pd.Series(dtype="float64") for c in fields})
        cyc = pdf["cycle"].to_numpy(dtype=np.float64)
        cw = sliding_window_view(cyc, L)
        cc = cw - cw.mean(axis=1, keepdims=True)
        den = (cc * cc).sum(axis=1)
        end = pdf.iloc[L - 1:]
        keep = ((end["_blk"] == end["_home"]) & (end["cycle"] >= L)).to_numpy()
        out = {"engine_id": end["engine_id"].to_numpy()[keep], "cycle": end["cycle"].to_numpy()[keep]}
        for f in feats:
            x = pdf[f].to_numpy(dtype=np.float64)
            xw = sliding_window_view(x, L)
            mean = xw.mean(axis=1)
            dev = xw - mean[:, None]
            out[f"{f}_last"] = x[L - 1:][keep]
            out[f"{f}_mean"] = mean[keep]
            out[f"{f}_std"] = np.sqrt((dev * dev).mean(axis=1))[keep]
            out[f"{f}_slope"] = ((cc * dev).sum(axis=1) / den)[keep]
        if has_rul:
            out["rul"] = end["rul"].to_numpy(dtype=np.float64)[keep]
        return pd.DataFrame(out)

    return d.groupBy("engine_id", "_blk").applyInPandas(run, schema)


def last_rows(df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` readings of every engine (D3 input).

    With ``life`` known (dense cycles) this is a narrow filter, no shuffle.
    Otherwise ``row_number() <= n`` is used, which Spark plans with a partial
    per-task limit before the exchange, so a hot engine ships at most n rows
    per map task.
    """
    if "life" in df.columns:
        return df.filter(F.col("cycle") > F.col("life") - F.lit(n))
    w = Window.partitionBy("engine_id").orderBy(F.col("cycle").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def last_window(
    df: DataFrame, spec: FleetSpec, policy: str = "skip", arrays: bool = False, last: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Last L-cycle window per engine with a short-history policy (D3).

    ``skip``: engines with fewer than L readings are left out.
    ``partial``: they are kept with the readings they have.
    ``error``: they are kept with ``error`` = 'short history' and no summary.
    Output per engine: n_rows, first_cycle, last_cycle, ``<f>_mean`` and, with
    ``arrays``, ``window`` = array<struct<cycle, features>> sorted by cycle;
    with ``last``, ``last`` = struct of the features at the last cycle (D4);
    ``reason``: null, or why the window must not be scored (a reading that is null, NaN or infinite);
    every column in ``carry`` is taken from the last cycle too (e.g. its label).
    """
    if policy not in ("skip", "partial", "error"):
        raise ValueError(f"unknown policy {policy!r}")
    rows = last_rows(df, spec.window)
    aggs = [
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.min("cycle").alias("first_cycle"),
        F.max("cycle").alias("last_cycle"),
        F.max(any_not_finite(spec.features)).alias("__bad"),
    ] + [F.avg(f).alias(f"{f}_mean") for f in spec.features]
    if arrays:
        reading = F.struct(F.col("cycle"), *[F.col(f) for f in spec.features])
        aggs.append(F.array_sort(F.collect_list(reading)).alias("window"))
    if last:
        # per-feature max_by keeps fixed-width buffers (hash aggregation);
        # a struct-valued max_by would force a sort-based aggregate
        aggs += [F.max_by(F.col(f), F.col("cycle")).alias(f"__last_{f}") for f in spec.features]
    aggs += [F.max_by(F.col(c), F.col("cycle")).alias(c) for c in carry]
    out = rows.groupBy("engine_id").agg(*aggs)
    out = out.withColumn("reason", F.when(F.col("__bad"), F.lit(BAD_READING))).drop("__bad")
    if last:
        out = out.withColumn("last", F.struct(*[F.col(f"__last_{f}").alias(f) for f in spec.features])).drop(
            *[f"__last_{f}" for f in spec.features])
    full = F.col("n_rows") >= spec.window
    if policy == "skip":
        return out.filter(full)
    if policy == "error":
        means = [f"{f}_mean" for f in spec.features]
        out = out.withColumn("error", F.when(full, F.lit(None).cast("string")).otherwise(F.lit("short history")))
        for m in means:
            out = out.withColumn(m, F.when(full, F.col(m)))
    return out


def last_reading(df: DataFrame) -> DataFrame:
    """The last row of every engine (D4): a filter when ``life`` is known, else max_by."""
    if "life" in df.columns:
        return df.filter(F.col("cycle") == F.col("life"))
    others = [c for c in df.columns if c != "engine_id"]
    last = F.max_by(F.struct(*others), F.col("cycle"))
    return df.groupBy("engine_id").agg(last.alias("_r")).select("engine_id", "_r.*")


def engine_lives(df: DataFrame) -> DataFrame:
    """Life per engine."""
    d = df if "life" in df.columns else with_life(df)
    return d.groupBy("engine_id").agg(F.max("life").alias("life"))


def fleet_life_summary(df: DataFrame) -> DataFrame:
    """Fleet min / max / mean life and engine count."""
    return engine_lives(df).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_engines"),
        F.min("life").alias("min_life"),
        F.max("life").alias("max_life"),
        F.avg("life").alias("mean_life"),
    )
