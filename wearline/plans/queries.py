"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through a fleet view derived from them)
and runs over whole tables. Floating outputs are quantized to binary steps
(``functions.scalar.round_out``) so that independent engines agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalar as X
from ..operators import attribution as A
from ..operators.joins import join_lookup
from ..operators import drift as D
from ..operators import labels as LB
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import scaling as S
from ..operators import windows as W
from ..operators.forecast import forecast_windows
from ..sources.artefacts import window_requests
from ..sources.store import materialized
from .common import finish
from .fleet import FleetRun

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


# --------------------------------------------------------------------------
# I9 flagship: the result card of every test engine
# --------------------------------------------------------------------------


def health_cards(run: FleetRun, test: DataFrame | None = None) -> DataFrame:
    """Per engine: clamped forecast on its last (possibly partial) window, band,
    life percent, strongest warning signal (display name) and action (I9). A window with a
    bad reading has a ``reason`` and nothing else."""
    spec = run.spec
    test_z = run.scaled(run.test if test is None else test)
    win = W.last_window(test_z, spec, policy="partial", last=True)
    scored = forecast_windows(win, spec, clamp=True)
    scores = A.warning_score_columns(spec, run.stats, run.importance, prefix="last.")
    status = X.health_band(F.col("predicted_rul"), upper=True)
    return scored.select(
        "engine_id",
        F.col("n_rows").alias("window_rows"),
        "predicted_rul",
        status.alias("health_status"),
        X.life_percent(F.col("predicted_rul"), C.RUL_CAP).alias("life_pct"),
        F.when(F.col("reason").isNull(), A.display_name(spec, A.top_feature(spec, scores))).alias("top_signal"),
        X.action_for(status, upper=True).alias("action"),
        "reason",
    )


@query("fleet_health")
def q_fleet_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(health_cards(FleetRun(spark, sf_dir)))


@query("fleet_health_faulty")
def q_fleet_health_faulty(spark, sf_dir):
    """The cards of a fleet with planted faults."""
    run = FleetRun(spark, sf_dir)
    return finish(health_cards(run, with_faults(run.test)))


# --------------------------------------------------------------------------
# Labels and splits
# --------------------------------------------------------------------------


@query("rul_train")
def q_rul_train(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(run.labelled.select("engine_id", "cycle", "life", "rul"))


@query("rul_raw_vs_capped")
def q_rul_raw_vs_capped(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(LB.label_raw_and_capped(run.rows, run.spec.cap).select("engine_id", "cycle", "rul_raw", "rul"))


@query("rul_test")
def q_rul_test(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(run.test.select("engine_id", "cycle", "life", "rul"))


@query("entity_split")
def q_entity_split(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    roster = run.rows.select("engine_id").distinct()
    return LB.assign_split(roster, *run.ranges)


@query("split_leakage")
def q_split_leakage(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return LB.split_leakage(run.labelled).agg(F.count(F.lit(1)).cast("bigint").alias("n_overlap"))


@query("split_bounds")
def q_split_bounds(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return LB.split_bounds(run.labelled).select("split", "min_engine", "max_engine")


@query("split_counts")
def q_split_counts(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return LB.split_bounds(run.labelled).select("split", "n_rows", "n_engines")


# --------------------------------------------------------------------------
# Scaling and statistics
# --------------------------------------------------------------------------


@query("scaler_fit")
def q_scaler_fit(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(S.scaler_fit(run.train, run.features))


@query("scaler_fit_faulty")
def q_scaler_fit_faulty(spark, sf_dir):
    """The scaler over train rows with planted faults: missing and infinite readings don't count."""
    run = FleetRun(spark, sf_dir)
    return finish(S.scaler_fit(with_faults(run.train), run.features))


@query("window_features_faulty")
def q_window_features_faulty(spark, sf_dir):
    """Window statistics of a fleet with planted faults: null, with a reason, while one lies in the window."""
    run = FleetRun(spark, sf_dir)
    return finish(W.window_features(with_faults(run.labelled), run.spec, reason=True))


@query("feature_stats")
def q_feature_stats(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(S.feature_stats(run.scaled(run.train), run.features))


@query("scaled_features")
def q_scaled_features(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(run.scaled(run.test).select("engine_id", "cycle", *run.features))


@query("near_constant_features")
def q_near_constant(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(Q.uninformative_features(run.train, run.features))


@query("feature_projection")
def q_feature_projection(spark, sf_dir):
    """Drop the uninformative columns (found by B12 on train) and keep feature order (B1, B2)."""
    run = FleetRun(spark, sf_dir)
    flagged = [r["feature"] for r in Q.uninformative_features(run.train, run.features).collect() if r["uninformative"]]
    kept = [f for f in run.features if f not in flagged]
    return finish(run.rows.drop(*flagged).select("engine_id", "cycle", *kept))


@query("scaled_signature")
def q_scaled_signature(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(Q.scaled_signature(run.scaled(run.train), run.features))


@query("raw_violations")
def q_raw_violations(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return Q.violation_counts(run.rows, Q.raw_rules(run.features))


def with_faults(rows: DataFrame) -> DataFrame:
    """Readings with faults planted by id and cycle arithmetic (also written in the SQL oracle)."""
    e, c = F.col("engine_id"), F.col("cycle")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return rows.withColumns({
        "quantity": F.when((e % 17 == 0) & (c % 50 == 3), nan).otherwise(F.col("quantity")),
        "discount": F.when((e % 19 == 0) & (c % 40 == 5), F.lit(None)).otherwise(F.col("discount")),
        "tax": F.when((e % 23 == 0) & (c % 30 == 7), inf).otherwise(F.col("tax")),
    })


@query("raw_violations_faulty")
def q_raw_violations_faulty(spark, sf_dir):
    """The raw rules over readings with planted faults: NaN and null values, bad and missing ids and cycles."""
    run = FleetRun(spark, sf_dir)
    e, c = F.col("engine_id"), F.col("cycle")
    rows = with_faults(run.rows)
    rows = rows.select(
        F.when((e % 29 == 0) & (c % 100 == 1), F.lit(None)).when((e % 13 == 0) & (c % 90 == 2), -e).otherwise(e).alias("engine_id"),
        F.when((e % 31 == 0) & (c % 70 == 1), F.lit(None)).when((e % 11 == 0) & (c % 80 == 2), F.lit(0)).otherwise(c).alias("cycle"),
        *run.features)
    return Q.violation_counts(rows, Q.raw_rules(run.features))


@query("scored_records_faulty")
def q_scored_records_faulty(spark, sf_dir):
    """Service records of a fleet with planted faults: a window with a bad reading has a reason and nothing else."""
    run = FleetRun(spark, sf_dir)
    win = W.last_window(run.scaled(with_faults(run.test)), run.spec, policy="skip")
    p = F.col("predicted_rul")
    scored = forecast_windows(win, run.spec)
    status = X.health_band(p)
    return finish(scored.select(
        "engine_id", "predicted_rul", status.alias("health_status"), X.life_percent(p).alias("life_pct"),
        X.action_for(status).alias("action"), "reason"))


@query("processed_violations")
def q_processed_violations(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return Q.violation_counts(run.test, Q.processed_rules(run.features, run.spec.cap))


# --------------------------------------------------------------------------
# Histories and windows
# --------------------------------------------------------------------------


@query("fleet_roster")
def q_fleet_roster(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return run.test.select("engine_id").distinct().orderBy("engine_id")


@query("engine_life")
def q_engine_life(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(W.fleet_life_summary(run.rows))


@query("engine_history")
def q_engine_history(spark, sf_dir):
    """Cycle-ordered history of the first engine by id."""
    run = FleetRun(spark, sf_dir)
    first = run.rows.agg(F.min("engine_id")).first()[0]
    hist = run.rows.filter(F.col("engine_id") == F.lit(first)).orderBy("cycle")
    return finish(hist.select("engine_id", "cycle", *run.features))


@query("last_reading")
def q_last_reading(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    last = W.last_reading(run.scaled(run.test))
    return finish(last.select("engine_id", "cycle", *run.features, "rul"))


def _orders_last(spark, sf_dir, policy):
    run = FleetRun(spark, sf_dir, "orders")
    out = W.last_window(run.rows, run.spec, policy=policy)
    cols = ["engine_id", "n_rows", "first_cycle", "last_cycle"] + [f"{f}_mean" for f in run.features]
    if policy == "error":
        cols.append("error")
    return finish(out.select(*cols))


@query("last_window_skip")
def q_last_window_skip(spark, sf_dir):
    return _orders_last(spark, sf_dir, "skip")


@query("last_window_partial")
def q_last_window_partial(spark, sf_dir):
    return _orders_last(spark, sf_dir, "partial")


@query("last_window_error")
def q_last_window_error(spark, sf_dir):
    return _orders_last(spark, sf_dir, "error")


@query("sliding_windows")
def q_sliding_windows(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    wins = W.sliding_windows(run.labelled, run.spec, target="rul")
    first = run.features[0]
    return finish(wins.select(
        "engine_id",
        F.col("cycle").alias("end_cycle"),
        F.size("window").cast("bigint").alias("window_rows"),
        F.col("window")[0]["cycle"].alias("start_cycle"),
        F.aggregate("window", F.lit(0.0), lambda acc, r: acc + r[first]).alias(f"{first}_sum"),
        F.col("rul").alias("target"),
    ))


@query("window_features")
def q_window_features(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(W.window_features(run.labelled, run.spec))


# --------------------------------------------------------------------------
# Forecasts, metrics and gates
# --------------------------------------------------------------------------


def prediction_pairs(run: FleetRun) -> DataFrame:
    """Service forecast (unclamped) of each engine's last full window beside the
    label of its last reading; an engine without a label keeps its forecast and has a
    null label and null errors (C4)."""
    win = forecast_windows(run.last_windows("skip"), run.spec)
    pairs = win.select("engine_id", "predicted_rul", F.col("rul").alias("actual_rul"))
    return M.pair_errors(pairs)


@query("prediction_pairs")
def q_prediction_pairs(spark, sf_dir):
    return finish(prediction_pairs(FleetRun(spark, sf_dir)))


@query("forecast_metrics")
def q_forecast_metrics(spark, sf_dir):
    return finish(M.forecast_metrics(prediction_pairs(FleetRun(spark, sf_dir))))


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    return finish(M.quality_gate(M.forecast_metrics(prediction_pairs(FleetRun(spark, sf_dir)))))


@query("batch_forecast")
def q_batch_forecast(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    win = forecast_windows(run.last_windows("skip"), run.spec)
    return finish(win.select("engine_id", "last_cycle", "predicted_rul"))


@query("degradation_curve")
def q_degradation_curve(spark, sf_dir):
    """Forecast and true label at every cycle >= L of every test engine."""
    run = FleetRun(spark, sf_dir)
    scored = trajectory(run.test_z, run.spec)
    return finish(scored.select("engine_id", "cycle", F.col("rul").alias("true_rul"), "predicted_rul"))


def trajectory(scaled: DataFrame, spec) -> DataFrame:
    """Every full window's forecast; none, but a ``reason``, where it holds a bad reading."""
    return forecast_windows(W.frame_stats(scaled, spec), spec)


@query("degradation_curve_faulty")
def q_degradation_curve_faulty(spark, sf_dir):
    """The trajectory of a fleet with planted faults: no forecast while a bad reading lies in the window."""
    run = FleetRun(spark, sf_dir)
    scored = trajectory(run.scaled(with_faults(run.test)), run.spec)
    return finish(scored.select("engine_id", "cycle", F.col("rul").alias("true_rul"), "predicted_rul", "reason"))


def dashboard_forecasts(run: FleetRun) -> DataFrame:
    """Clamped forecasts on the last, possibly partial, window of every engine."""
    return forecast_windows(run.last_windows("partial"), run.spec, clamp=True)


@query("most_critical")
def q_most_critical(spark, sf_dir):
    """Engine with the lowest forecast; the lower id wins a tie."""
    return finish(most_critical(dashboard_forecasts(FleetRun(spark, sf_dir))))


def most_critical(forecasts: DataFrame) -> DataFrame:
    """Of the engines that have a forecast."""
    top = forecasts.filter("predicted_rul IS NOT NULL").orderBy("predicted_rul", "engine_id").limit(1)
    return top.select("engine_id", "predicted_rul")


@query("most_critical_faulty")
def q_most_critical_faulty(spark, sf_dir):
    """Engines whose last window holds a planted fault have no forecast and are not the most critical."""
    run = FleetRun(spark, sf_dir)
    win = W.last_window(run.scaled(with_faults(run.test)), run.spec, policy="partial")
    return finish(most_critical(forecast_windows(win, run.spec, clamp=True)))


@query("engine_sample")
def q_engine_sample(spark, sf_dir):
    """Five engines drawn reproducibly with the shared arithmetic hash."""
    run = FleetRun(spark, sf_dir)
    roster = run.test.select("engine_id").distinct()
    h = (F.col("engine_id") * F.lit(C.HASH_ID) + F.lit(run.spec.seed)) % F.lit(C.HASH_MOD)
    return roster.withColumn("h", h).orderBy("h", "engine_id").limit(5).select("engine_id")


# --------------------------------------------------------------------------
# Bands, records and text
# --------------------------------------------------------------------------


@query("health_bands")
def q_health_bands(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    raw = forecast_windows(run.last_windows("partial"), run.spec)
    p = F.col("predicted_rul")
    clamped = X.clamp_non_negative(p)
    return finish(raw.select(
        "engine_id", p.alias("predicted_rul"), clamped.alias("clamped_rul"),
        X.health_band(p).alias("status"), X.health_band(clamped, upper=True).alias("dashboard_status"),
        X.life_percent(clamped, C.RUL_CAP).alias("life_pct"),
    ))


def flag_columns(run: FleetRun, prefix: str = "last.") -> dict:
    """Range flag per feature: strictly outside the train [min, max]; NaN is not flagged (F8)."""
    out = {}
    for f in run.features:
        s = run.stats[f]
        x = F.col(prefix + f)
        out[f] = F.coalesce(~F.isnan(x) & ((x < F.lit(float(s["min"]))) | (x > F.lit(float(s["max"])))), F.lit(False))
    return out


def flag_summary(run: FleetRun, flags: dict) -> dict:
    names = F.filter(F.array(*[F.when(flags[f], F.lit(f)) for f in run.features]), lambda x: x.isNotNull())
    return {
        "drift_flags": F.map_from_arrays(F.array(*[F.lit(f) for f in run.features]), F.array(*[flags[f] for f in run.features])),
        "flagged": names,
        "any_flag": F.exists(F.array(*[flags[f] for f in run.features]), lambda v: v),
    }


def scored_records(run: FleetRun) -> DataFrame:
    """Service record per engine: flags (before scoring), forecast, status,
    confidence and sentence (I7). ``drift_flags`` is a map feature -> flagged."""
    win = forecast_windows(run.last_windows("skip"), run.spec)
    fl = flag_summary(run, flag_columns(run))
    p = F.col("predicted_rul")
    status = X.health_band(p)
    return win.select(
        "engine_id", p.alias("predicted_rul"),
        status.alias("health_status"),
        X.confidence(p, C.RUL_CAP).alias("confidence"),
        X.maintenance_sentence(F.col("engine_id"), p, status, X.action_for(status)).alias("nl_summary"),
        fl["drift_flags"].alias("drift_flags"),
        fl["flagged"].alias("flagged"),
        fl["any_flag"].alias("any_flag"),
        "reason",
    )


@query("scored_records")
def q_scored_records(spark, sf_dir):
    rec = scored_records(FleetRun(spark, sf_dir))
    return finish(rec.select(
        "engine_id", "predicted_rul", "health_status", "confidence", "nl_summary",
        F.array_join("flagged", ",").alias("flagged_features"), "any_flag", "reason",
    ))


@query("range_flags")
def q_range_flags(spark, sf_dir):
    """Per test reading: number of features outside the train range."""
    run = FleetRun(spark, sf_dir)
    flags = flag_columns(run, prefix="")
    fl = flag_summary(run, flags)
    return run.test_z.select(
        "engine_id", "cycle",
        F.size(fl["flagged"]).cast("bigint").alias("n_flags"),
        F.array_join(fl["flagged"], ",").alias("flagged_features"),
        fl["any_flag"].alias("any_flag"),
    )


@query("scoring_counters")
def q_scoring_counters(spark, sf_dir):
    """Total scored, drift events and the last forecast in scoring order."""
    rec = scored_records(FleetRun(spark, sf_dir))
    ok = ~F.isnan("predicted_rul")
    return finish(rec.agg(
        F.count_if(ok).cast("bigint").alias("total_predictions"),
        F.count_if(F.col("any_flag")).cast("bigint").alias("drift_events"),
        F.max_by("predicted_rul", "engine_id").alias("last_prediction"),
    ))


@query("maintenance_summary")
def q_maintenance_summary(spark, sf_dir):
    """Sentence per engine with the service wording and its top warning signal."""
    run = FleetRun(spark, sf_dir)
    win = forecast_windows(run.last_windows("skip"), run.spec)
    top = A.top_feature(run.spec, run.warning_scores())
    p = F.col("predicted_rul")
    status = X.health_band(p)
    return win.select(
        "engine_id",
        X.maintenance_sentence(F.col("engine_id"), p, status, X.action_for(status), top).alias("nl_summary"),
    )


# --------------------------------------------------------------------------
# Attribution, signals and ranking
# --------------------------------------------------------------------------


def warning_long(run: FleetRun) -> DataFrame:
    last = W.last_reading(run.test_z)
    return A.long_scores(last, run.spec, run.warning_scores(prefix=""))


@query("warning_scores")
def q_warning_scores(spark, sf_dir):
    return finish(warning_long(FleetRun(spark, sf_dir)))


@query("top_signal")
def q_top_signal(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    last = W.last_reading(run.test_z)
    top = A.top_feature(run.spec, run.warning_scores(prefix=""))
    return last.select("engine_id", top.alias("feature"), A.display_name(run.spec, top).alias("signal"))


def signal_ranks(run: FleetRun) -> DataFrame:
    """(engine_id, ranked): every test engine's features ranked by warning score, within the engine's last reading."""
    return W.last_reading(run.test_z).select("engine_id", A.ranked_features(run.spec, run.warning_scores(prefix="")).alias("ranked"))


def ranked_signals(run: FleetRun) -> DataFrame:
    """``signal_ranks`` as rows, with the engine's highest score."""
    return signal_ranks(run).select("engine_id", F.col("ranked")[0]["score"].alias("peak"), F.inline("ranked"))


@query("top3_signals")
def q_top3_signals(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    r = ranked_signals(run).filter(F.col("rank") <= 3)
    peak = F.when(F.col("peak") == 0, F.lit(1.0)).otherwise(F.col("peak"))
    rel = F.least(F.col("score") / peak, F.lit(1.0))
    return finish(r.select("engine_id", "rank", "feature", "score", rel.alias("relative")))


@query("signal_ranking")
def q_signal_ranking(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    r = ranked_signals(run)
    return finish(r.select("engine_id", "feature", "rank", "score", (F.col("rank") == 1).alias("is_top")))


@query("labelled_signals")
def q_labelled_signals(spark, sf_dir):
    """Warning contributions with display names, raw name when none."""
    run = FleetRun(spark, sf_dir)
    long = warning_long(run)
    return finish(long.select("engine_id", A.display_name(run.spec, F.col("feature")).alias("signal"), "score"))


@query("signal_trend")
def q_signal_trend(spark, sf_dir):
    """Scaled readings over the whole life of each engine's top-3 warning features.

    The top-3 table has one row per engine (an array of 3 names); it joins the
    readings through the size-checked lookup, and each reading then yields its
    3 values by name, so readings are never exploded before a shuffle.
    """
    run = FleetRun(spark, sf_dir)
    top3 = signal_ranks(run).select("engine_id", F.transform(
        F.slice("ranked", 1, 3), lambda x: F.struct(x["rank"].alias("rank"), x["feature"].alias("feature"))).alias("top3"))
    joined = join_lookup(run.test_z, top3, "engine_id")
    picked = joined.select("engine_id", "cycle", *run.features, F.inline("top3"))
    value = F.lit(None).cast("double")
    for f in run.features:
        value = F.when(F.col("feature") == f, F.col(f)).otherwise(value)
    return finish(picked.select("engine_id", "cycle", "feature", "rank", value.alias("value")))


@query("background_sample")
def q_background_sample(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return A.background_ends(run.scaled(run.train), run.spec)


@query("importance_baseline")
def q_importance_baseline(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(A.importance_baseline(run.background, run.spec, run.step_means))


def last_full_window_attribution(run: FleetRun) -> DataFrame:
    rows = run.last_window_rows(run.test_z).filter(F.col("life") >= run.spec.window)
    return A.window_attribution(rows, run.spec, run.step_means)


@query("linear_attribution")
def q_linear_attribution(spark, sf_dir):
    return finish(last_full_window_attribution(FleetRun(spark, sf_dir)))


def explained_records(run: FleetRun) -> DataFrame:
    """Per engine with a full window: forecast, ``attribution`` (map feature -> share), the three strongest features and the
    sentence with the strongest (I8). Shares are ranked within the engine's row."""
    rows = run.last_window_rows(run.test_z).filter(F.col("life") >= run.spec.window)
    shares = A.wide_attribution(rows, run.spec, run.step_means)
    columns = {f: F.col(f) for f in run.features}
    explained = shares.select(
        "engine_id", F.map_from_arrays(F.array(*[F.lit(f) for f in run.features]), F.array(*columns.values())).alias("attribution"),
        F.transform(F.slice(A.ranked_features(run.spec, columns), 1, 3), lambda x: x["feature"]).alias("top_features"))
    win = forecast_windows(run.last_windows("skip"), run.spec)
    p = F.col("predicted_rul")
    status = X.health_band(p)
    return win.select("engine_id", "predicted_rul").join(explained, "engine_id").select(
        "engine_id", "predicted_rul", "attribution", "top_features",
        X.maintenance_sentence(F.col("engine_id"), p, status, X.action_for(status), F.col("top_features")[0]).alias("nl_summary"))


@query("explained_records")
def q_explained_records(spark, sf_dir):
    """The explained records with the attribution map as one column a feature (I8)."""
    run = FleetRun(spark, sf_dir)
    return finish(explained_records(run).select(
        "engine_id", "predicted_rul", *[F.col("attribution")[f].alias(f"attribution_{f}") for f in run.features],
        F.array_join("top_features", ",").alias("top_features"), "nl_summary"))


# --------------------------------------------------------------------------
# Quantiles, histograms and drift
# --------------------------------------------------------------------------


@query("quantile_edges")
def q_quantile_edges(spark, sf_dir):
    """Decile edges of every standardised train feature (E7), straight from the plan."""
    run = FleetRun(spark, sf_dir)
    edges = D.quantile_table(run.scaled(run.train), run.features)
    pos = F.array_position(F.array(*[F.lit(f) for f in run.features]), F.col("feature")).cast("bigint")
    return finish(edges.select("feature", pos.alias("pos"), F.col("pos").alias("q"), "edge"))


@query("histogram_edges")
def q_histogram_edges(spark, sf_dir):
    """Test readings binned on the train deciles: half-open bins, last closed,
    values outside the edges not counted (E8)."""
    run = FleetRun(spark, sf_dir)
    edges = run.train_deciles
    bins = {f: (D.bin_of(F.col(f), edges[f]), len(edges[f]) - 1) for f in run.features}
    return D.count_bins(run.test_z, bins)


@query("life_histogram")
def q_life_histogram(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(D.equal_width_histogram(W.engine_lives(run.rows), "life", 20))


@query("rul_histogram")
def q_rul_histogram(spark, sf_dir):
    """40 equal-width bins of the uncapped and the capped train label."""
    run = FleetRun(spark, sf_dir)
    lab = LB.label_raw_and_capped(run.rows, run.spec.cap)
    raw = D.equal_width_histogram(lab, "rul_raw", 40).withColumn("label", F.lit("raw"))
    capped = D.equal_width_histogram(lab, "rul", 40).withColumn("label", F.lit("capped"))
    return finish(raw.unionByName(capped))


@query("psi_train_vs_test")
def q_psi_train_vs_test(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    return finish(D.psi_samples(run.scaled(run.train), run.test_z, run.features, deciles=run.train_deciles))


@query("drift_reference")
def q_drift_reference(spark, sf_dir):
    run = FleetRun(spark, sf_dir)
    train_z = run.scaled(run.train)
    interior = D.reference_edges(train_z, run.features, deciles=run.train_deciles)
    return finish(D.reference_shares(train_z, interior, run.features))


def drift_fleet(run: FleetRun) -> DataFrame:
    psi = D.psi_against_reference(run.test_z, run.reference, run.features)
    pos = F.lit(None).cast("bigint")
    for i, f in enumerate(run.features):
        pos = F.when(F.col("feature") == f, F.lit(i + 1).cast("bigint")).otherwise(pos)
    return psi.select(
        "feature", pos.alias("pos"), A.display_name(run.spec, F.col("feature")).alias("signal"),
        "psi", X.psi_severity(F.col("psi")).alias("severity"),
    )


@query("drift_fleet")
def q_drift_fleet(spark, sf_dir):
    """PSI of the whole test fleet per feature against the stored reference (H3, H4)."""
    return finish(drift_fleet(FleetRun(spark, sf_dir)).orderBy(F.col("psi").desc()))


@query("drift_by_engine")
def q_drift_by_engine(spark, sf_dir):
    """PSI per engine and feature; all engines in one grouped pass (H4)."""
    run = FleetRun(spark, sf_dir)
    return finish(D.psi_against_reference(run.test_z, run.reference, run.features, by=("engine_id",)))


@query("drift_recent")
def q_drift_recent(spark, sf_dir):
    """PSI of each engine's most recent 500 readings (H7)."""
    run = FleetRun(spark, sf_dir)
    recent = W.last_rows(run.test_z, C.DRIFT_RECENT)
    return finish(D.psi_against_reference(recent, run.reference, run.features, by=("engine_id",)))


@query("psi_gaussian")
def q_psi_gaussian(spark, sf_dir):
    """PSI of each engine's last window against N(mean, std) deciles of the train stats (H5)."""
    run = FleetRun(spark, sf_dir)
    recent = W.last_rows(run.test_z, run.spec.window)
    ref = D.gaussian_reference(run.stats, run.features)
    return finish(D.psi_against_reference(recent, ref, run.features, by=("engine_id",)))


@query("drift_alarms")
def q_drift_alarms(spark, sf_dir):
    """Features drifted past 0.2: count and their names, most drifted first."""
    table = drift_fleet(FleetRun(spark, sf_dir))
    alarms = table.filter(F.col("psi") > C.PSI_ALARM)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("psi")).alias("k"), "pos", "signal")))
    return alarms.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_alarms"),
        F.array_join(F.transform(ordered, lambda x: x["signal"]), ", ").alias("alarms"),
    )


# --------------------------------------------------------------------------
# Written tables, requests and guards
# --------------------------------------------------------------------------


def _source(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


@query("splits_roundtrip")
def q_splits_roundtrip(spark, sf_dir):
    """Processed train / val / test written as one parquet table partitioned by
    split, read back and summarised per split (A5)."""
    run = FleetRun(spark, sf_dir)

    def build():
        cols = ["engine_id", "cycle", *run.features, "rul", "split"]
        trval = run.scaled(run.labelled.filter(F.col("split").isNotNull())).select(*cols)
        test = run.test_z.withColumn("split", F.lit("test")).select(*cols)
        return trval.unionByName(test)

    back = materialized(spark, "splits-lineitem", [_source(sf_dir, "lineitem")], build, partition_by=("split",), spec=run.spec)
    return finish(back.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.countDistinct("engine_id").cast("bigint").alias("n_engines"),
        F.sum("rul").alias("rul_sum"),
    ))


@query("last_window_table")
def q_last_window_table(spark, sf_dir):
    """Raw (unscaled) last windows kept for serving, written and read back."""
    run = FleetRun(spark, sf_dir)

    def build():
        return W.last_window(run.test, run.spec, policy="partial")

    back = materialized(spark, "last-windows-lineitem", [_source(sf_dir, "lineitem")], build, spec=run.spec)
    cols = ["engine_id", "n_rows", "first_cycle", "last_cycle"] + [f"{f}_mean" for f in run.features]
    return finish(back.select(*cols))


def orders_requests(spark, sf_dir) -> tuple[FleetRun, DataFrame]:
    """Scoring requests built from each customer's last (possibly short) window."""
    run = FleetRun(spark, sf_dir, "orders")
    wins = W.last_window(run.rows, run.spec, policy="partial", arrays=True)
    return run, window_requests(wins, run.features)


@query("request_violations")
def q_request_violations(spark, sf_dir):
    """Request validation: id >= 1, exactly L rows, each with all features."""
    run, req = orders_requests(spark, sf_dir)
    reason = Q.request_reason(F.col("sensor_window"), F.col("engine_id"), run.spec.window, len(run.features))
    return req.select(
        "engine_id", F.size("sensor_window").cast("bigint").alias("n_rows"),
        reason.isNull().alias("valid"), reason.alias("reason"),
    )


@query("guarded_windows")
def q_guarded_windows(spark, sf_dir):
    """Shape and finiteness guard before scoring, finiteness after; rejected
    windows keep their reason and get no score (B10)."""
    run = FleetRun(spark, sf_dir, "orders")
    req = window_requests(W.last_window(run.scaled(run.rows), run.spec, policy="partial", arrays=True), run.features)
    w = F.col("sensor_window")
    reason = Q.guard_reason(w, run.spec.window, len(run.features))
    def column_of(i):
        return lambda r: r[i]

    means = {f"{f}_mean": F.aggregate(F.transform(w, column_of(i)), F.lit(0.0), lambda a, x: a + x) / F.size(w)
             for i, f in enumerate(run.features)}
    ok = reason.isNull()
    scored = req.select("engine_id", reason.alias("reason"), *[F.when(ok, v).alias(k) for k, v in means.items()])
    scored = forecast_windows(scored, run.spec)
    pred = F.when(F.col("reason").isNull(), F.col("predicted_rul"))
    out = scored.select("engine_id", "reason", pred.alias("predicted_rul"))
    return finish(out.withColumn("output_reason", F.when(F.col("reason").isNull(), Q.output_reason(F.col("predicted_rul")))))


@query("window_input_stats")
def q_window_input_stats(spark, sf_dir):
    """Mean and population std of all values of each scored window."""
    run = FleetRun(spark, sf_dir)
    wins = W.last_window(run.test_z, run.spec, policy="skip", arrays=True)
    req = window_requests(wins, run.features)
    mean, std = Q.window_mean_std(F.col("sensor_window"))
    return finish(req.select("engine_id", mean.alias("mean"), std.alias("std")))


# --------------------------------------------------------------------------
# Fitted forecasters and the pluggable scorer (I1, I3, I6, L1): rows-only
# --------------------------------------------------------------------------


#: The configured number of iterations and of iterations without improvement.
MODEL_ROUNDS, MODEL_PATIENCE = 50, 10
LATE_ORDER = (3, 1, 0, 2, 5, 4, 8, 9, 7, 6)  # the delivery of each three days
LATE_MINUTES = 5 * 24 * 60


def _model_windows(run: FleetRun) -> tuple[DataFrame, DataFrame]:
    """Train/val windows (with ``is_val``) and each test engine's last full window."""
    lab = run.scaled(run.labelled.filter(F.col("split").isNotNull()))
    val_lo, val_hi = run.ranges[1]
    wins = W.window_features(lab, run.spec, reason=True).filter("reason IS NULL").drop("reason")
    wins = wins.withColumn("is_val", F.col("engine_id").between(val_lo, val_hi))
    # only the last L readings feed an engine's last full window
    test = W.window_features(W.last_rows(run.test_z, run.spec.window), run.spec, reason=True).filter("reason IS NULL").drop("reason")
    last = test.join(run.test_z.filter(F.col("cycle") == F.col("life")).select("engine_id", "cycle"), ["engine_id", "cycle"])
    return wins, last


def _fitted(spark, sf_dir, kind):
    from ..operators import models as ML

    run = FleetRun(spark, sf_dir)
    wins, last = _model_windows(run)
    model = ML.fit_forecaster(wins, run.spec, kind=kind, max_iter=20 if kind == "linear" else MODEL_ROUNDS,
                              patience=MODEL_PATIENCE)
    return finish(ML.predict(model, last, run.spec).select("engine_id", "cycle", "predicted_rul"))


@query("forecast_linear")
def q_forecast_linear(spark, sf_dir):
    """Linear forecaster fitted on train windows, applied to last test windows."""
    return _fitted(spark, sf_dir, "linear")


@query("forecast_gbt")
def q_forecast_gbt(spark, sf_dir):
    """Boosted trees, validation engines decide when to stop."""
    return _fitted(spark, sf_dir, "gbt")


@query("forecaster_saved")
def q_forecaster_saved(spark, sf_dir):
    """The forecaster as a pipeline stage: fitted on train windows, saved, loaded, and both applied to every test
    engine's last full window; ``same`` tells whether the two forecasts are equal (I4, I5)."""
    import uuid

    from pyspark.ml import Pipeline, PipelineModel

    from ..operators.estimator import WindowForecaster
    from ..operators.models import summary_columns
    from ..session import scratch_path

    run = FleetRun(spark, sf_dir)
    wins, last = _model_windows(run)
    stage = WindowForecaster(featureCols=summary_columns(run.spec), kind="linear", validationCol="is_val")
    model = Pipeline(stages=[stage]).fit(wins.drop("reason"))
    path = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    model.save(path)
    last = last.checkpoint()  # one row per engine, read by both models
    fitted = model.transform(last).select("engine_id", "cycle", F.col("predicted_rul").alias("fitted"))
    both = PipelineModel.load(path).transform(last).select("engine_id", "cycle", "predicted_rul").join(fitted, ["engine_id", "cycle"])
    return both.select("engine_id", "cycle", (F.col("predicted_rul") == F.col("fitted")).alias("same"))


@query("pluggable_scorer")
def q_pluggable_scorer(spark, sf_dir):
    """Any vectorised scorer over window arrays, guarded before and after (L1)."""
    from ..operators import models as ML

    run = FleetRun(spark, sf_dir)
    wins = W.last_window(run.test_z, run.spec, policy="partial", arrays=True)
    req = window_requests(wins, run.features)
    scored = ML.guarded_score(req, ML.linear_scorer(run.spec), run.spec.window, len(run.features))
    return finish(scored.select("engine_id", "reason", "predicted_rul", "output_reason"))


# --------------------------------------------------------------------------
# Structured Streaming (K1, K2, K4, K5, K6): streams over the events table,
# run to completion with trigger(availableNow) and read back from their sinks
# --------------------------------------------------------------------------


@query("stream_scoring")
def q_stream_scoring(spark, sf_dir):
    """Latest full-window forecast per engine from the stateful stream (K1)."""
    from ..streaming import scoring as ST

    run = FleetRun(spark, sf_dir, "events")
    stream = ST.standardise_stream(ST.readings(ST.event_stream(spark, sf_dir)), run.scaler, run.features)
    out = ST.run_available(ST.score_stream(stream, run.spec), "scoring")
    rows = spark.read.parquet(out)
    latest = rows.groupBy("engine_id").agg(F.max_by(F.struct("n_seen", "predicted_rul"), "n_seen").alias("r"))
    return finish(latest.select("engine_id", F.col("r.n_seen").alias("n_seen"), F.col("r.predicted_rul").alias("predicted_rul")))


@query("stream_counters")
def q_stream_counters(spark, sf_dir):
    """Hourly counters maintained in update mode; the last update per window wins (K4)."""
    from ..streaming import scoring as ST

    from ..session import scratch_path
    import uuid

    counters = ST.hourly_counters(ST.readings(ST.event_stream(spark, sf_dir)))
    sink = scratch_path(spark, f"streams/counters/{uuid.uuid4().hex}/out")

    def keep(batch, epoch):
        batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(sink)

    ST.run_available(counters, "counters", mode="update", foreach=keep)
    rows = spark.read.parquet(sink)
    last = rows.groupBy("window").agg(F.max_by(F.struct("n_readings", "n_errors", "max_value", "last_value"), "epoch").alias("r"))
    return finish(last.select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "r.n_readings", "r.n_errors", "r.max_value", "r.last_value",
    ))


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Every event delivered twice; repeats dropped within the watermark (K6)."""
    from ..streaming import scoring as ST

    dedup = ST.drop_repeats(ST.readings(ST.event_stream(spark, sf_dir, copies=2)))
    out = ST.run_available(dedup, "dedup")
    return spark.read.parquet(out).groupBy("engine_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_readings"))


@query("stream_late")
def q_stream_late(spark, sf_dir):
    """Events delivered in ten parts that are out of order, every third event again one part later: each
    reading is kept, late or a repeat, and the three add up to what was delivered (K6)."""
    import uuid

    from ..session import scratch_path
    from ..sources.tables import read_table
    from ..streaming import late as LT
    from ..streaming import scoring as ST

    path = scratch_path(spark, f"streams/deliveries/{uuid.uuid4().hex}")
    events = read_table(spark, sf_dir, "events", *[f.name for f in ST.EVENTS_SCHEMA])
    days = F.least(F.floor((F.dayofmonth("ts") - 1) / 3), F.lit(9)).cast("int")  # three days a part
    first = events.withColumn("part", F.element_at(F.array(*[F.lit(x) for x in LATE_ORDER]), days + 1))
    again = first.filter("event_id % 3 = 0").withColumn("part", F.col("part") + 1)
    LT.deliver(first.unionByName(again), "part", path, batches=11, files=2)
    stream = spark.readStream.schema(ST.EVENTS_SCHEMA).option("maxFilesPerTrigger", 2).option("recursiveFileLookup", "true").parquet(path)
    out = LT.run_routed(LT.route_readings(ST.readings(stream).select("engine_id", "event_id", "ts"), delay_minutes=LATE_MINUTES), "late")
    rows = spark.read.schema("engine_id long, event_id long, route string").parquet(out)
    count = {r: F.count_if(F.col("route") == r).cast("bigint").alias(f"n_{r}") for r in (LT.KEPT, LT.LATE, LT.REPEAT)}
    return rows.groupBy("engine_id").agg(*count.values(), F.count(F.lit(1)).cast("bigint").alias("n_delivered"))


@query("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """Stateless validation routing clean and rejected readings to two sinks (K2)."""
    from ..streaming import scoring as ST
    from ..session import scratch_path
    import uuid

    run = FleetRun(spark, sf_dir, "events")
    base = scratch_path(spark, f"streams/quarantine/{uuid.uuid4().hex}")
    rules = [("engine_id_below_1", F.col("engine_id") < 1)] + [(f"{f}_missing", X.is_missing(F.col(f))) for f in run.features]
    ST.run_available(ST.readings(ST.event_stream(spark, sf_dir)), "quarantine",
                     foreach=ST.quarantine_to(rules, f"{base}/good", f"{base}/bad"))
    from ..sources.store import _exists

    routed = spark.read.parquet(f"{base}/good").select(F.lit(True).alias("ok"))
    if _exists(spark, f"{base}/bad"):
        routed = routed.unionByName(spark.read.parquet(f"{base}/bad").select(F.lit(False).alias("ok")))
    return routed.agg(F.count_if("ok").cast("bigint").alias("n_good"),
                      F.count_if(~F.col("ok")).cast("bigint").alias("n_rejected"))


@query("stream_drift")
def q_stream_drift(spark, sf_dir):
    """PSI of every micro-batch against the stored reference, with alarms (K5)."""
    from ..streaming import scoring as ST
    from ..session import scratch_path
    import uuid

    run = FleetRun(spark, sf_dir, "events")
    stream = ST.standardise_stream(ST.readings(ST.event_stream(spark, sf_dir)), run.scaler, run.features)
    path = scratch_path(spark, f"streams/drift/{uuid.uuid4().hex}/out")
    ST.run_available(stream, "drift", foreach=ST.drift_to(run.reference, run.features, path, C.PSI_ALARM))
    return finish(spark.read.parquet(f"{path}/batch-*").select("epoch", "feature", "psi", "alarm"))


def raw_text_path(spark, sf_dir, run: FleetRun) -> str:
    """The lineitem fleet written once as raw whitespace text (mixed blanks and
    tabs, two trailing NaN fields, no header), like the original raw files."""
    from ..sources.store import written_path

    def build():
        fields = [F.col("engine_id").cast("string"), F.col("cycle").cast("string")] + \
                 [F.col(f).cast("string") for f in run.features] + [F.lit("NaN"), F.lit("NaN")]
        line = F.concat(F.lit(" "), F.concat_ws(" \t ", *fields), F.lit("  "))
        return run.rows.select(line.alias("value"))

    return written_path(spark, "text-lineitem", [_source(sf_dir, "lineitem")], build, fmt="text")


@query("telemetry_scan")
def q_telemetry_scan(spark, sf_dir):
    """The raw text scanned back: empty tokens dropped, all-NaN columns dropped,
    arity checked, ids and cycles typed (A1, A2)."""
    from ..sources.telemetry import read_telemetry_text

    run = FleetRun(spark, sf_dir)
    names = ["engine_id", "cycle", *run.features]
    scanned = read_telemetry_text(spark, raw_text_path(spark, sf_dir, run), names=names, glob="*.txt")
    return finish(scanned.select(*names))


@query("checksum_manifest")
def q_checksum_manifest(spark, sf_dir):
    """Checksum-verified ingest over the fleet's raw text files (A4): sidecars
    are published once when the text is written; every file is then verified
    (status ok / missing / mismatch)."""
    from ..sources.telemetry import checksum_manifest, list_files, publish_checksums

    run = FleetRun(spark, sf_dir)
    files = list_files(spark, raw_text_path(spark, sf_dir, run), suffix=".txt")
    publish_checksums(spark, files)
    m = checksum_manifest(spark, files)
    return m.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "status",
                    (F.col("expected") == F.col("actual")).alias("verified"))


@query("checksum_statuses")
def q_checksum_statuses(spark, sf_dir):
    """Raw text files, one per engine, against sidecars of which every tenth is left out and every tenth is wrong (A4)."""
    from ..sources.store import written_path
    from ..sources.telemetry import checksum_manifest, file_digests, list_files, write_sidecars

    run = FleetRun(spark, sf_dir)
    line = F.concat_ws(" ", "engine_id", "cycle", F.col("quantity").cast("bigint"))

    def build():
        # a file costs time whatever its size, so the engines are dealt over many tasks, however small the table (an explicit number stays)
        dealt = run.rows.repartition(4 * spark.sparkContext.defaultParallelism, "engine_id")
        return dealt.sortWithinPartitions("engine_id", "cycle").select(line.alias("value"), "engine_id")

    folder = written_path(spark, "text-engines", [_source(sf_dir, "lineitem")], build, partition_by=("engine_id",), fmt="text")
    engine = F.regexp_extract("path", r"engine_id=(\d+)/", 1).cast("bigint")
    files = list_files(spark, folder, suffix=".txt")
    planted = F.when(engine % 10 == 7, F.repeat(F.lit("0"), 64)).otherwise(F.col("actual"))
    wanted = file_digests(spark, files).filter(F.col("expected").isNull() & (engine % 10 != 3))
    write_sidecars(spark, wanted.select("path", planted.alias("digest")))
    return checksum_manifest(spark, files).select(engine.alias("engine_id"), "status", "actual", "n_bytes")


def loss_log(scaled: DataFrame, spec) -> DataFrame:
    """Squared loss of the given forecaster per split and batch of full windows (64 hash batches); n = scored windows."""
    scored = trajectory(scaled, spec)
    batch = X.sample_hash(F.col("engine_id"), F.col("cycle"), spec.seed) % F.lit(64)
    err = F.col("predicted_rul") - F.col("rul")
    return scored.filter(err.isNotNull()).groupBy("split", batch.alias("step")).agg(
        F.avg(err * err).alias("loss"), F.count(err).cast("bigint").alias("n"))


@query("weighted_loss")
def q_weighted_loss(spark, sf_dir):
    """Batch losses combined per split as sum(loss * n) / max(sum(n), 1) (E10, A10 form)."""
    run = FleetRun(spark, sf_dir)
    lab = run.scaled(run.labelled.filter(F.col("split").isNotNull()))
    return finish(M.weighted_loss(loss_log(lab, run.spec), by="split"))


@query("weighted_loss_faulty")
def q_weighted_loss_faulty(spark, sf_dir):
    """The loss over windows without a planted fault only."""
    run = FleetRun(spark, sf_dir)
    lab = run.scaled(with_faults(run.labelled.filter(F.col("split").isNotNull())))
    return finish(M.weighted_loss(loss_log(lab, run.spec), by="split"))


@query("early_stop_point")
def q_early_stop_point(spark, sf_dir):
    """Where each of four curves in one run log stops at a patience of 5: batch losses of two runs (train and
    validation engines) and two metrics, appended run by run and read back (E12, A10)."""
    import uuid

    from ..session import scratch_path
    from ..sources.artefacts import append_run_log, read_run_log

    run = FleetRun(spark, sf_dir)
    lab = run.scaled(run.labelled.filter(F.col("split").isNotNull()))
    scored = trajectory(lab, run.spec)
    step = X.sample_hash(F.col("engine_id"), F.col("cycle"), run.spec.seed) % F.lit(64)
    err = F.col("predicted_rul") - F.col("rul")
    losses = scored.groupBy(F.col("split").alias("run_id"), step.alias("step")).agg(
        F.round(F.avg(err * err), 6).alias("mse"), F.round(F.avg(F.abs(err)), 6).alias("mae"))
    path = scratch_path(spark, f"runs/{uuid.uuid4().hex}")
    curves = losses.unpivot(["run_id", "step"], ["mse", "mae"], "metric", "value")
    for run_id in ("train", "val"):
        append_run_log(spark, curves.filter(F.col("run_id") == run_id), path)
    return finish(M.early_stop_points(read_run_log(spark, path), patience=5))


@query("training_curve")
def q_training_curve(spark, sf_dir):
    """Validation loss after each boosting iteration, best so far, iterations
    since the last strict improvement and the early-stop step at the configured patience
    (I6, E12); the curve is also appended to the run log (A10)."""
    import uuid

    from ..operators import models as ML
    from ..session import scratch_path
    from ..sources.artefacts import append_run_log, read_run_log

    run = FleetRun(spark, sf_dir)
    wins, _ = _model_windows(run)
    # a fixed number of trees on train windows; validation loss after each tree
    model = ML.fit_forecaster(wins.filter(~F.col("is_val")), run.spec, kind="gbt", validation=None, max_iter=MODEL_ROUNDS)
    curve = ML.training_curve(model, wins.filter(F.col("is_val")), run.spec)
    run_id = uuid.uuid4().hex
    log_path = scratch_path(spark, f"runs/{run_id}")
    append_run_log(spark, [(run_id, step, "val_loss", loss) for step, loss in curve], log_path)
    losses = read_run_log(spark, log_path).select("step", F.col("value").alias("loss"))
    return finish(M.early_stop_series(losses, patience=MODEL_PATIENCE))
