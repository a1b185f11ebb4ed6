"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Written directly against the driver's tables with window functions, joins and
grouping; it shares no code path with the Spark plans, only the parameters in
``config`` (feature lists, weights, caps). DuckDB notes: decimal literals are
DECIMAL, so every literal double is cast; ``row_number`` is cast to BIGINT.
"""

from __future__ import annotations

from .. import config as C

LI = C.LINEITEM_FLEET
F6 = LI.features
L = LI.window
ORACLE: dict[str, str] = {}


def d(x: float) -> str:
    """A DOUBLE literal."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def r6(expr: str, bits: int = 20) -> str:
    """Same presentation quantization as the Spark side (binary steps by magnitude)."""
    e = f"({expr})"

    def q(k: int) -> str:
        return f"(floor({e} * {d(2 ** k)} + {d(0.5)}) / {d(2 ** k)})"

    r = (f"(CASE WHEN abs({e}) < 1e3 THEN {q(bits)} WHEN abs({e}) < 1e6 THEN {q(min(bits, 10))} "
         f"WHEN abs({e}) < 1e15 THEN {q(2)} ELSE {e} END)")
    return f"(CASE WHEN {r} = 0 THEN {d(0)} ELSE {r} END)"


def cap(expr: str, c: float) -> str:
    return f"(CASE WHEN ({expr}) > {d(c)} THEN {d(c)} ELSE ({expr}) END)"


def sql_list(items) -> str:
    return ", ".join(items)


# --- lineitem fleet ------------------------------------------------------

def li_ctes() -> list[str]:
    """f: view; lv: lives; bnd: split bounds; lab: train labels + split;
    tr: train rows; sc: scaler; z*: standardised sets; tst/truth/tlab: test fleet."""
    feats = sql_list(F6)
    mu_sd = []
    for f in F6:
        sd = f"stddev_pop({f})"
        mu_sd.append(f"avg({f}) AS mu_{f}")
        mu_sd.append(
            f"CASE WHEN {sd} IS NULL OR {sd} <= 1e-9 * greatest(1, abs(avg({f}))) THEN {d(1)} ELSE {sd} END AS sd_{f}"
        )
    z = sql_list(f"({f} - sc.mu_{f}) / sc.sd_{f} AS {f}" for f in F6)
    return [
        f"""f AS (SELECT CAST(l_suppkey + 1 AS BIGINT) AS engine_id,
            CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS BIGINT) AS cycle,
            CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_extendedprice AS DOUBLE) AS extendedprice,
            CAST(l_discount AS DOUBLE) AS discount, CAST(l_tax AS DOUBLE) AS tax,
            CASE WHEN l_linestatus = 'O' THEN {d(1)} ELSE {d(0)} END AS linestatus,
            {d(100)} AS setting
          FROM lineitem)""",
        "lv AS (SELECT engine_id, max(cycle) AS life FROM f GROUP BY engine_id)",
        f"bnd AS (SELECT CAST(floor({LI.train_fraction} * max(engine_id)) AS BIGINT) AS hi, max(engine_id) AS top FROM f)",
        f"""lab AS (SELECT f.engine_id, f.cycle, lv.life, {sql_list('f.' + x for x in F6)},
            {cap('CAST(lv.life - f.cycle AS DOUBLE)', LI.cap)} AS rul,
            CASE WHEN f.engine_id BETWEEN 1 AND bnd.hi THEN 'train'
                 WHEN f.engine_id BETWEEN bnd.hi + 1 AND bnd.top THEN 'val' END AS split
          FROM f JOIN lv ON f.engine_id = lv.engine_id CROSS JOIN bnd)""",
        "tr AS (SELECT * FROM lab WHERE split = 'train')",
        f"sc AS (SELECT {sql_list(mu_sd)} FROM tr)",
        f"ztr AS (SELECT engine_id, cycle, life, rul, {z} FROM tr CROSS JOIN sc)",
        f"""tst AS (SELECT f.engine_id, f.cycle, lv.life - (f.engine_id * {C.TRUTH_MULT}) % {C.TRUTH_MOD} AS life, {sql_list('f.' + x for x in F6)}
          FROM f JOIN lv ON f.engine_id = lv.engine_id
          WHERE f.cycle <= lv.life - (f.engine_id * {C.TRUTH_MULT}) % {C.TRUTH_MOD})""",
        f"""truth AS (SELECT engine_id, CAST((engine_id * {C.TRUTH_MULT}) % {C.TRUTH_MOD} AS DOUBLE) AS final_rul
          FROM lv WHERE engine_id % {C.TRUTH_SKIP} <> 0)""",
        f"""tlab AS (SELECT tst.*, {cap('t.final_rul + CAST(tst.life - tst.cycle AS DOUBLE)', LI.cap)} AS rul
          FROM tst LEFT JOIN truth t ON tst.engine_id = t.engine_id)""",
        f"ztst AS (SELECT engine_id, cycle, life, rul, {z} FROM tlab CROSS JOIN sc)",
    ]


def li_importance_ctes() -> list[str]:
    """Background sample of full train windows, per-step means, importance."""
    means = sql_list(f"avg({f}) AS m_{f}" for f in F6)
    absphi = sql_list(
        f"avg(abs({d(LI.weight(f) / L)} * (r.{f} - m.m_{f}))) AS a_{f}" for f in F6
    )
    total = " + ".join(f"a_{f}" for f in F6)
    imp = sql_list(f"a_{f} / greatest({total}, 1e-9) AS i_{f}" for f in F6)
    return [
        f"""cand AS (SELECT engine_id, cycle AS end_cycle,
              (engine_id * {C.HASH_ID} + cycle * {C.HASH_CYCLE} + {LI.seed}) % {C.HASH_MOD} AS h
            FROM ztr WHERE cycle >= {L})""",
        f"bg AS (SELECT engine_id, end_cycle FROM cand ORDER BY h, engine_id, end_cycle LIMIT {C.BACKGROUND_SAMPLES})",
        f"""bgr AS (SELECT z.*, b.end_cycle, CAST(z.cycle - b.end_cycle + {L} AS INTEGER) AS step
            FROM ztr z JOIN bg b ON z.engine_id = b.engine_id AND z.cycle BETWEEN b.end_cycle - {L - 1} AND b.end_cycle)""",
        f"bgm AS (SELECT step, {means} FROM bgr GROUP BY step)",
        f"ia AS (SELECT {absphi} FROM bgr r JOIN bgm m ON r.step = m.step)",
        f"imp AS (SELECT {imp} FROM ia)",
    ]


def li_stats_cte() -> str:
    """Statistics of the standardised train rows (sample std)."""
    cols = []
    for f in F6:
        cols += [f"avg({f}) AS mean_{f}", f"stddev_samp({f}) AS std_{f}", f"min({f}) AS min_{f}", f"max({f}) AS max_{f}"]
    return f"zst AS (SELECT {sql_list(cols)} FROM ztr)"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def forecast_sql(fmt: str = "{f}") -> str:
    """bias + sum of weight * fmt(feature), e.g. fmt='avg({f})'."""
    terms = [d(LI.bias)] + [f"{d(LI.weight(f))} * {fmt.format(f=f)}" for f in F6 if LI.weight(f)]
    return "(" + " + ".join(terms) + ")"


def display_sql(expr: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LI.display.items())
    return f"COALESCE(CASE {expr} {cases} END, {expr})"


def status_sql(expr: str, upper: bool) -> str:
    h, w, c = ("HEALTHY", "WARNING", "CRITICAL") if upper else ("Healthy", "Warning", "Critical")
    return (f"CASE WHEN {expr} >= {d(C.HEALTHY_MIN)} THEN '{h}' WHEN {expr} >= {d(C.WARNING_MIN)} "
            f"THEN '{w}' ELSE '{c}' END")


def action_sql(status_expr: str, upper: bool) -> str:
    table = C.DASHBOARD_ACTIONS if upper else C.SERVICE_ACTIONS
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {status_expr} {cases} END"


def warning_long_sql(src: str) -> str:
    """(engine_id, feature, pos, score) for the rows of ``src`` (scaled last readings)."""
    parts = []
    for i, f in enumerate(F6):
        std = f"CASE WHEN zst.std_{f} > {d(C.SCALE_STD_FLOOR)} THEN zst.std_{f} ELSE {d(1)} END"
        parts.append(
            f"SELECT s.engine_id, '{f}' AS feature, CAST({i + 1} AS BIGINT) AS pos, "
            f"abs(s.{f} - zst.mean_{f}) / ({std}) * imp.i_{f} AS score FROM {src} s CROSS JOIN zst CROSS JOIN imp"
        )
    return " UNION ALL ".join(parts)


# --- I9 flagship -------------------------------------------------------------

ORACLE["fleet_health"] = with_(
    li_ctes() + li_importance_ctes() + [li_stats_cte()] + [
        f"lw AS (SELECT * FROM ztst WHERE cycle > life - {L})",
        f"""fc AS (SELECT engine_id, count(*) AS window_rows,
              CASE WHEN {forecast_sql('avg({f})')} < 0 THEN {d(0)} ELSE {forecast_sql('avg({f})')} END AS p
            FROM lw GROUP BY engine_id)""",
        f"lastz AS (SELECT * FROM ztst WHERE cycle = life)",
        f"ws AS ({warning_long_sql('lastz')})",
        "top AS (SELECT engine_id, feature FROM (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY score DESC, pos) AS rn FROM ws) WHERE rn = 1)",
    ],
    f"""SELECT fc.engine_id, CAST(fc.window_rows AS BIGINT) AS window_rows,
        {r6('fc.p')} AS predicted_rul,
        {status_sql('fc.p', True)} AS health_status,
        {r6(f'least(fc.p / {d(C.RUL_CAP)} * 100, 100)')} AS life_pct,
        {display_sql('top.feature')} AS top_signal,
        {action_sql(status_sql('fc.p', True), True)} AS action, CAST(NULL AS VARCHAR) AS reason
    FROM fc JOIN top ON fc.engine_id = top.engine_id""",
)


# --- labels and splits -------------------------------------------------------

ORACLE["rul_train"] = with_(li_ctes(), f"SELECT engine_id, cycle, life, {r6('rul')} AS rul FROM lab")

ORACLE["rul_raw_vs_capped"] = with_(
    li_ctes(),
    f"SELECT engine_id, cycle, {r6('CAST(life - cycle AS DOUBLE)')} AS rul_raw, {r6('rul')} AS rul FROM lab",
)

ORACLE["rul_test"] = with_(li_ctes(), f"SELECT engine_id, cycle, life, {r6('rul')} AS rul FROM tlab")

ORACLE["entity_split"] = with_(li_ctes(), "SELECT DISTINCT engine_id, split FROM lab")

ORACLE["split_leakage"] = with_(
    li_ctes(),
    """SELECT CAST(count(*) AS BIGINT) AS n_overlap FROM (
         SELECT engine_id FROM lab WHERE split = 'train' INTERSECT SELECT engine_id FROM lab WHERE split = 'val')""",
)

ORACLE["split_bounds"] = with_(
    li_ctes(),
    "SELECT split, min(engine_id) AS min_engine, max(engine_id) AS max_engine FROM lab WHERE split IS NOT NULL GROUP BY split",
)

ORACLE["split_counts"] = with_(
    li_ctes(),
    """SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT engine_id) AS BIGINT) AS n_engines
       FROM lab WHERE split IS NOT NULL GROUP BY split""",
)


# --- scaling and statistics --------------------------------------------------

def unpivot_sql(src: str, fields: dict[str, str]) -> str:
    """One row per feature from a one-row source: fields maps out-name -> template with {f}."""
    parts = []
    for i, f in enumerate(F6):
        cols = ", ".join(f"{r6(t.format(f=f))} AS {name}" for name, t in fields.items())
        parts.append(f"SELECT '{f}' AS feature, CAST({i + 1} AS BIGINT) AS pos, {cols} FROM {src}")
    return " UNION ALL ".join(parts)


ORACLE["scaler_fit"] = with_(li_ctes(), unpivot_sql("sc", {"mu": "mu_{f}", "sigma": "sd_{f}"}))

ORACLE["feature_stats"] = with_(
    li_ctes() + [li_stats_cte()],
    unpivot_sql("zst", {"mean": "mean_{f}", "std": "std_{f}", "min": "min_{f}", "max": "max_{f}"}),
)

ORACLE["scaled_features"] = with_(
    li_ctes(), f"SELECT engine_id, cycle, {sql_list(f'{r6(f)} AS {f}' for f in F6)} FROM ztst"
)


def near_constant_sql() -> str:
    parts = []
    for i, f in enumerate(F6):
        parts.append(
            f"""SELECT '{f}' AS feature, CAST({i + 1} AS BIGINT) AS pos, {r6(f'stddev_samp({f})')} AS std,
                count(DISTINCT {f}) <= 2 AS at_most_two_values,
                (coalesce(stddev_samp({f}) < 1e-6, false) OR count(DISTINCT {f}) <= 2) AS uninformative
              FROM tr"""
        )
    return " UNION ALL ".join(parts)


ORACLE["near_constant_features"] = with_(li_ctes(), near_constant_sql())

# linestatus (two values) and setting (constant) are the uninformative ones
ORACLE["feature_projection"] = with_(
    li_ctes(),
    f"SELECT engine_id, cycle, {sql_list(f'{r6(f)} AS {f}' for f in ('quantity', 'extendedprice', 'discount', 'tax'))} FROM f",
)


def signature_sql() -> str:
    parts = []
    for i, f in enumerate(F6):
        m, s = f"avg({f})", f"stddev_samp({f})"
        parts.append(
            f"""SELECT '{f}' AS feature, CAST({i + 1} AS BIGINT) AS pos, {r6(m)} AS mean, {r6(s)} AS std,
                abs({m}) < 1e-2 AS centred, (abs({s} - 1) < 1e-1 OR {s} < 1e-6) AS unit_or_constant,
                (abs({m}) < 1e-2 AND (abs({s} - 1) < 1e-1 OR {s} < 1e-6)) AS passed
              FROM ztr"""
        )
    return " UNION ALL ".join(parts)


ORACLE["scaled_signature"] = with_(li_ctes(), signature_sql())


def violations_sql(src: str, processed: bool) -> str:
    rules = [
        ("engine_id_missing", "engine_id IS NULL"),
        ("engine_id_below_1", "engine_id < 1"),
        ("cycle_missing", "cycle IS NULL"),
        ("cycle_below_1", "cycle < 1"),
    ] + [(f"{f}_missing", f"{f} IS NULL OR isnan({f})") for f in F6]
    if processed:
        rules += [("rul_missing", "rul IS NULL OR isnan(rul)"),
                  ("rul_out_of_range", f"rul < 0 OR rul > {d(LI.cap)}")]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST(count(*) FILTER (WHERE {p}) AS BIGINT) AS n_violations FROM {src}"
        for n, p in rules
    )


ORACLE["raw_violations"] = with_(li_ctes(), violations_sql("f", False))


def faulty_sql(name: str, src: str) -> str:
    faults = {
        "quantity": "CASE WHEN engine_id % 17 = 0 AND cycle % 50 = 3 THEN CAST('NaN' AS DOUBLE) ELSE quantity END",
        "discount": "CASE WHEN engine_id % 19 = 0 AND cycle % 40 = 5 THEN NULL ELSE discount END",
        "tax": "CASE WHEN engine_id % 23 = 0 AND cycle % 30 = 7 THEN CAST('Infinity' AS DOUBLE) ELSE tax END",
    }
    return f"{name} AS (SELECT * REPLACE ({sql_list(f'{v} AS {k}' for k, v in faults.items())}) FROM {src})"


ORACLE["raw_violations_faulty"] = with_(
    li_ctes() + [faulty_sql("ff", "f"), """fv AS (SELECT * REPLACE (
        CASE WHEN engine_id % 29 = 0 AND cycle % 100 = 1 THEN NULL WHEN engine_id % 13 = 0 AND cycle % 90 = 2 THEN -engine_id
             ELSE engine_id END AS engine_id,
        CASE WHEN engine_id % 31 = 0 AND cycle % 70 = 1 THEN NULL WHEN engine_id % 11 = 0 AND cycle % 80 = 2 THEN 0
             ELSE cycle END AS cycle) FROM ff)"""],
    violations_sql("fv", False))
ORACLE["processed_violations"] = with_(li_ctes(), violations_sql("tlab", True))


# --- histories and windows ---------------------------------------------------

ORACLE["fleet_roster"] = with_(li_ctes(), "SELECT DISTINCT engine_id FROM tst ORDER BY engine_id")

ORACLE["engine_life"] = with_(
    li_ctes(),
    f"""SELECT CAST(count(*) AS BIGINT) AS n_engines, min(life) AS min_life, max(life) AS max_life,
        {r6('avg(life)')} AS mean_life FROM lv""",
)

ORACLE["engine_history"] = with_(
    li_ctes(),
    f"""SELECT engine_id, cycle, {sql_list(f'{r6(f)} AS {f}' for f in F6)} FROM f
        WHERE engine_id = (SELECT min(engine_id) FROM f) ORDER BY cycle""",
)

ORACLE["last_reading"] = with_(
    li_ctes(),
    f"SELECT engine_id, cycle, {sql_list(f'{r6(f)} AS {f}' for f in F6)}, {r6('rul')} AS rul FROM ztst WHERE cycle = life",
)


def orders_ctes() -> list[str]:
    return [
        """fo AS (SELECT CAST(o_custkey + 1 AS BIGINT) AS engine_id,
             CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS cycle,
             CAST(o_totalprice AS DOUBLE) AS totalprice FROM orders)""",
    ]


def orders_last_sql(policy: str) -> str:
    Lo = C.ORDERS_FLEET.window
    body = f"""SELECT engine_id, CAST(count(*) AS BIGINT) AS n_rows, min(cycle) AS first_cycle, max(cycle) AS last_cycle,
                 avg(totalprice) AS m FROM (
                   SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle DESC) AS rn FROM fo) q
               WHERE rn <= {Lo} GROUP BY engine_id"""
    if policy == "skip":
        return with_(orders_ctes() + [f"g AS ({body})"],
                     f"SELECT engine_id, n_rows, first_cycle, last_cycle, {r6('m')} AS totalprice_mean FROM g WHERE n_rows >= {Lo}")
    if policy == "partial":
        return with_(orders_ctes() + [f"g AS ({body})"],
                     f"SELECT engine_id, n_rows, first_cycle, last_cycle, {r6('m')} AS totalprice_mean FROM g")
    return with_(orders_ctes() + [f"g AS ({body})"],
                 f"""SELECT engine_id, n_rows, first_cycle, last_cycle,
                       CASE WHEN n_rows >= {Lo} THEN {r6('m')} END AS totalprice_mean,
                       CASE WHEN n_rows >= {Lo} THEN NULL ELSE 'short history' END AS error FROM g""")


ORACLE["last_window_skip"] = orders_last_sql("skip")
ORACLE["last_window_partial"] = orders_last_sql("partial")
ORACLE["last_window_error"] = orders_last_sql("error")

ORACLE["sliding_windows"] = with_(
    li_ctes(),
    f"""SELECT engine_id, end_cycle, window_rows, start_cycle, {r6('qsum')} AS quantity_sum, {r6('rul')} AS target FROM (
          SELECT engine_id, cycle AS end_cycle, CAST(count(*) OVER w AS BIGINT) AS window_rows,
                 min(cycle) OVER w AS start_cycle, sum(quantity) OVER w AS qsum, rul
          FROM lab WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW)) q
        WHERE end_cycle >= {L}""",
)


def window_features_sql() -> str:
    cols = []
    for f in F6:
        cols += [f"{r6(f)} AS {f}_last", f"{r6(f'avg({f}) OVER w')} AS {f}_mean",
                 f"{r6(f'stddev_pop({f}) OVER w')} AS {f}_std",
                 f"{r6(f'regr_slope({f}, CAST(cycle AS DOUBLE)) OVER w')} AS {f}_slope"]
    return with_(
        li_ctes(),
        f"""SELECT * FROM (SELECT engine_id, cycle, {sql_list(cols)}, {r6('rul')} AS rul
              FROM lab WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW)) q
            WHERE cycle >= {L}""",
    )


ORACLE["window_features"] = window_features_sql()


# --- forecasts, metrics, gates -----------------------------------------------

def full_ctes() -> list[str]:
    return li_ctes() + li_importance_ctes() + [li_stats_cte()]


def last_win_cte(name: str, min_rows: int | None) -> str:
    having = f"HAVING count(*) >= {min_rows}" if min_rows else ""
    return f"""{name} AS (SELECT engine_id, CAST(count(*) AS BIGINT) AS n_rows, max(cycle) AS last_cycle,
                 {forecast_sql('avg({f})')} AS p
               FROM ztst WHERE cycle > life - {L} GROUP BY engine_id {having})"""


PAIRS = [
    last_win_cte("g", L),
    "lastrow AS (SELECT engine_id, rul FROM ztst WHERE cycle = life)",
    "pairs AS (SELECT g.engine_id, g.p, lastrow.rul AS a FROM g JOIN lastrow ON g.engine_id = lastrow.engine_id)",
]


def penalty_sql(e: str) -> str:
    return (f"CASE WHEN {e} < 0 THEN exp(-({e}) / {d(C.EARLY_DIVISOR)}) - 1 "
            f"ELSE exp(({e}) / {d(C.LATE_DIVISOR)}) - 1 END")


METRICS = PAIRS + [
    f"""m AS (SELECT sqrt(avg((p - a) * (p - a))) AS rmse, avg(abs(p - a)) AS mae,
              sum({penalty_sql('p - a')}) AS score,
              CAST(count(p) AS BIGINT) AS n, CAST(count(a) AS BIGINT) AS n_labelled FROM pairs)""",
]

ORACLE["prediction_pairs"] = with_(
    li_ctes() + PAIRS,
    f"SELECT engine_id, {r6('p')} AS predicted_rul, {r6('a')} AS actual_rul, {r6('p - a')} AS error, {r6('abs(p - a)')} AS abs_error FROM pairs",
)

ORACLE["forecast_metrics"] = with_(
    li_ctes() + METRICS, f"SELECT {r6('rmse')} AS rmse, {r6('mae')} AS mae, {r6('score')} AS score, n, n_labelled FROM m"
)

ORACLE["quality_gate"] = with_(
    li_ctes() + METRICS,
    f"""SELECT 'rmse' AS gate, {r6('rmse')} AS value, {d(C.RMSE_GATE)} AS threshold, coalesce(rmse <= {d(C.RMSE_GATE)}, false) AS passed FROM m
        UNION ALL SELECT 'score', {r6('score')}, {d(0)}, coalesce(isfinite(score) AND score > 0, false) FROM m
        UNION ALL SELECT 'engines', {r6('CAST(n AS DOUBLE)')}, {d(C.MIN_SCORED_ENGINES)}, n >= {C.MIN_SCORED_ENGINES} FROM m""",
)

ORACLE["batch_forecast"] = with_(
    li_ctes() + [last_win_cte("g", L)], f"SELECT engine_id, last_cycle, {r6('p')} AS predicted_rul FROM g"
)

ORACLE["degradation_curve"] = with_(
    li_ctes(),
    f"""SELECT engine_id, cycle, {r6('rul')} AS true_rul, {r6('p')} AS predicted_rul FROM (
          SELECT engine_id, cycle, rul, {forecast_sql('avg({f}) OVER w')} AS p
          FROM ztst WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW)) q
        WHERE cycle >= {L}""",
)

ORACLE["most_critical"] = with_(
    li_ctes() + [last_win_cte("g", None)],
    f"""SELECT engine_id, {r6('pc')} AS predicted_rul FROM (
          SELECT engine_id, CASE WHEN p < 0 THEN {d(0)} ELSE p END AS pc FROM g) q
        ORDER BY pc, engine_id LIMIT 1""",
)

ORACLE["engine_sample"] = with_(
    li_ctes(),
    f"""SELECT engine_id FROM (SELECT DISTINCT engine_id FROM tst) q
        ORDER BY (engine_id * {C.HASH_ID} + {LI.seed}) % {C.HASH_MOD}, engine_id LIMIT 5""",
)


# --- bands, records, text ------------------------------------------------------

ORACLE["health_bands"] = with_(
    li_ctes() + [last_win_cte("g", None)],
    f"""SELECT engine_id, {r6('p')} AS predicted_rul, {r6('pc')} AS clamped_rul,
          {status_sql('p', False)} AS status, {status_sql('pc', True)} AS dashboard_status,
          {r6(f'least(pc / {d(C.RUL_CAP)} * 100, 100)')} AS life_pct
        FROM (SELECT *, CASE WHEN p < 0 THEN {d(0)} ELSE p END AS pc FROM g) q""",
)


def sentence_sql(eid: str, p: str, status: str, top: str | None = None) -> str:
    base = (f"'{C.SUMMARY_PREFIX}' || CAST({eid} AS VARCHAR) || '{C.SUMMARY_MIDDLE}' || "
            f"printf('%.0f', round_even({p}, 0)) || '{C.SUMMARY_STATUS}' || upper({status}) || '. ' || "
            f"({action_sql(status, False)})")
    if top is None:
        return base
    return f"CASE WHEN {top} IS NULL OR {top} = '' THEN {base} ELSE {base} || '{C.SUMMARY_SIGNAL}' || {top} || '.' END"


def flags_sql(src: str) -> tuple[str, str, str]:
    """(n_flags, flagged list, any) for rows of ``src`` joined with zst."""
    conds = [f"(NOT isnan({src}.{f}) AND ({src}.{f} < zst.min_{f} OR {src}.{f} > zst.max_{f}))" for f in F6]
    n = " + ".join(f"CAST({c} AS BIGINT)" for c in conds)
    names = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{f}' END" for c, f in zip(conds, F6)) + ")"
    return f"({n})", names, "(" + " OR ".join(conds) + ")"


_n, _names, _any = flags_sql("lr")
SCORED = full_ctes() + [
    last_win_cte("g", L),
    f"""rec AS (SELECT g.engine_id, g.p, {_names} AS flagged_features, {_any} AS any_flag
          FROM g JOIN ztst lr ON g.engine_id = lr.engine_id AND lr.cycle = lr.life CROSS JOIN zst)""",
]

ORACLE["scored_records_faulty"] = with_(
    li_ctes() + [faulty_sql("tf", "tlab"), f"""zf AS (SELECT engine_id, cycle, life,
          {sql_list(f"({f} - sc.mu_{f}) / sc.sd_{f} AS {f}" for f in F6)} FROM tf CROSS JOIN sc)""",
        f"""wf AS (SELECT engine_id, bool_or({" OR ".join(f"{f} IS NULL OR NOT isfinite({f})" for f in F6)}) AS bad,
          {forecast_sql('avg({f})')} AS p FROM zf WHERE cycle > life - {L} GROUP BY engine_id HAVING count(*) >= {L})""",
        "sf AS (SELECT engine_id, bad, CASE WHEN NOT bad THEN p END AS p FROM wf)"],
    f"""SELECT engine_id, CASE WHEN NOT bad THEN {r6('p')} END AS predicted_rul, st AS health_status,
          CASE WHEN NOT bad THEN {r6(f"least(p / {d(C.RUL_CAP)} * {d(100)}, {d(100)})")} END AS life_pct,
          CASE {" ".join(f"WHEN st = '{k}' THEN '{v}'" for k, v in C.SERVICE_ACTIONS.items())} END AS action,
          CASE WHEN bad THEN 'reading missing or not finite' END AS reason
        FROM (SELECT *, CASE WHEN bad THEN NULL WHEN p >= {d(C.HEALTHY_MIN)} THEN 'Healthy' WHEN p >= {d(C.WARNING_MIN)} THEN 'Warning'
                             ELSE 'Critical' END AS st FROM sf)""",
)

ORACLE["scored_records"] = with_(
    SCORED,
    f"""SELECT engine_id, {r6('p')} AS predicted_rul, {status_sql('p', False)} AS health_status,
          {r6(f'1 - least(abs(p) / {d(C.RUL_CAP)}, 1)')} AS confidence,
          {sentence_sql('engine_id', 'p', status_sql('p', False))} AS nl_summary,
          flagged_features, any_flag, CAST(NULL AS VARCHAR) AS reason FROM rec""",
)

_n2, _names2, _any2 = flags_sql("z")
ORACLE["range_flags"] = with_(
    full_ctes(),
    f"SELECT z.engine_id, z.cycle, {_n2} AS n_flags, {_names2} AS flagged_features, {_any2} AS any_flag FROM ztst z CROSS JOIN zst",
)

ORACLE["scoring_counters"] = with_(
    SCORED,
    f"""SELECT CAST(count(*) FILTER (WHERE NOT isnan(p)) AS BIGINT) AS total_predictions,
          CAST(count(*) FILTER (WHERE any_flag) AS BIGINT) AS drift_events,
          {r6('arg_max(p, engine_id)')} AS last_prediction FROM rec""",
)

WARN = full_ctes() + [
    "lastz AS (SELECT * FROM ztst WHERE cycle = life)",
    f"ws AS ({warning_long_sql('lastz')})",
    """rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY engine_id ORDER BY score DESC, pos) AS BIGINT) AS rnk,
              max(score) OVER (PARTITION BY engine_id) AS peak FROM ws)""",
]

ORACLE["maintenance_summary"] = with_(
    WARN + [last_win_cte("g", L)],
    f"""SELECT g.engine_id, {sentence_sql('g.engine_id', 'g.p', status_sql('g.p', False), 'rk.feature')} AS nl_summary
        FROM g JOIN rk ON g.engine_id = rk.engine_id AND rk.rnk = 1""",
)

ORACLE["warning_scores"] = with_(WARN, f"SELECT engine_id, feature, pos, {r6('score')} AS score FROM ws")

ORACLE["top_signal"] = with_(
    WARN, f"SELECT engine_id, feature, {display_sql('feature')} AS signal FROM rk WHERE rnk = 1"
)

ORACLE["top3_signals"] = with_(
    WARN,
    f"""SELECT engine_id, rnk AS rank, feature, {r6('score')} AS score,
          {r6(f'least(score / CASE WHEN peak = 0 THEN {d(1)} ELSE peak END, 1)')} AS relative
        FROM rk WHERE rnk <= 3""",
)

ORACLE["signal_ranking"] = with_(
    WARN, f"SELECT engine_id, feature, rnk AS rank, {r6('score')} AS score, rnk = 1 AS is_top FROM rk"
)

ORACLE["labelled_signals"] = with_(
    WARN, f"SELECT engine_id, {display_sql('feature')} AS signal, {r6('score')} AS score FROM ws"
)


def unpivot_rows_sql(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT engine_id, cycle, '{f}' AS feature, {f} AS value FROM {src}" for f in F6
    )


ORACLE["signal_trend"] = with_(
    WARN + [f"lng AS ({unpivot_rows_sql('ztst')})"],
    f"""SELECT l.engine_id, l.cycle, l.feature, rk.rnk AS rank, {r6('l.value')} AS value
        FROM lng l JOIN rk ON l.engine_id = rk.engine_id AND l.feature = rk.feature WHERE rk.rnk <= 3""",
)

ORACLE["background_sample"] = with_(li_ctes() + li_importance_ctes(), "SELECT engine_id, end_cycle FROM bg")

ORACLE["importance_baseline"] = with_(
    li_ctes() + li_importance_ctes(),
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({i + 1} AS BIGINT) AS pos, {r6(f'i_{f}')} AS importance FROM imp"
        for i, f in enumerate(F6)
    ),
)


def attribution_ctes() -> list[str]:
    absphi = sql_list(f"avg(abs({d(LI.weight(f) / L)} * (r.{f} - m.m_{f}))) AS a_{f}" for f in F6)
    total = " + ".join(f"a_{f}" for f in F6)
    longs = " UNION ALL ".join(
        f"SELECT engine_id, '{f}' AS feature, CAST({i + 1} AS BIGINT) AS pos, a_{f} / greatest({total}, 1e-9) AS attribution FROM pa"
        for i, f in enumerate(F6)
    )
    return [
        f"lwr AS (SELECT *, CAST(cycle - life + {L} AS INTEGER) AS step FROM ztst WHERE cycle > life - {L} AND life >= {L})",
        f"pa AS (SELECT r.engine_id, {absphi} FROM lwr r JOIN bgm m ON r.step = m.step GROUP BY r.engine_id)",
        f"att AS ({longs})",
    ]


ORACLE["linear_attribution"] = with_(
    li_ctes() + li_importance_ctes() + attribution_ctes(),
    f"SELECT engine_id, feature, pos, {r6('attribution')} AS attribution FROM att",
)

ORACLE["explained_records"] = with_(
    li_ctes() + li_importance_ctes() + attribution_ctes() + [
        last_win_cte("g", L),
        """t3 AS (SELECT engine_id, string_agg(feature, ',' ORDER BY rn) AS top_features,
                  min(CASE WHEN rn = 1 THEN feature END) AS top1
                FROM (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY attribution DESC, pos) AS rn FROM att) q
                WHERE rn <= 3 GROUP BY engine_id)""",
        f"aw AS (SELECT engine_id, {sql_list(f"max(CASE WHEN feature = '{f}' THEN attribution END) AS {f}" for f in F6)} FROM att GROUP BY engine_id)",
    ],
    f"""SELECT g.engine_id, {r6('g.p')} AS predicted_rul, {sql_list(f"{r6(f'aw.{f}')} AS attribution_{f}" for f in F6)}, t3.top_features,
          {sentence_sql('g.engine_id', 'g.p', status_sql('g.p', False), 't3.top1')} AS nl_summary
        FROM g JOIN t3 ON g.engine_id = t3.engine_id JOIN aw ON g.engine_id = aw.engine_id""",
)


# --- quantiles, histograms, drift ---------------------------------------------------

DEC = "[" + ", ".join(repr(i / C.PSI_BINS) for i in range(C.PSI_BINS + 1)) + "]"


def long_sql(src: str, extra: str = "", feats=F6) -> str:
    """(feature, x[, extra cols]) rows of a wide source."""
    ex = f", {extra}" if extra else ""
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x{ex} FROM {src}" for f in feats)


def quantiles_sql(src: str, feats=F6) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({i + 1} AS BIGINT) AS pos, quantile_cont({f}, {DEC}) AS q FROM {src}"
        for i, f in enumerate(feats)
    )


ORACLE["quantile_edges"] = with_(
    li_ctes() + [f"qs AS ({quantiles_sql('ztr')})"],
    f"SELECT feature, pos, CAST(g.i AS INTEGER) AS q, {r6('qs.q[g.i + 1]')} AS edge FROM qs CROSS JOIN range(11) g(i)",
)

ORACLE["histogram_edges"] = with_(
    li_ctes() + [
        f"qs AS ({quantiles_sql('ztr')})",
        f"al AS ({long_sql('ztst')})",
        """ab AS (SELECT al.feature, CASE WHEN x >= q[1] AND x <= q[11]
                   THEN least(len(list_filter(q, lambda v: v <= x)) - 1, 9) END AS bin
                 FROM al JOIN qs ON al.feature = qs.feature)""",
        "cnt AS (SELECT feature, bin, count(*) AS n FROM ab WHERE bin IS NOT NULL GROUP BY feature, bin)",
    ],
    """SELECT qs.feature, CAST(g.b AS INTEGER) AS bin, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
       FROM qs CROSS JOIN range(10) g(b) LEFT JOIN cnt ON cnt.feature = qs.feature AND cnt.bin = g.b""",
)


def equal_width_sql(src: str, col: str, k: int) -> str:
    return f"""(SELECT CAST(g.b AS INTEGER) AS bin, mn + (g.b - 1) * ((mx - mn) / {k}) AS lower,
                 mn + g.b * ((mx - mn) / {k}) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS n
               FROM (SELECT CAST(min({col}) AS DOUBLE) AS mn, CAST(max({col}) AS DOUBLE) AS mx FROM {src}) r
               CROSS JOIN range(1, {k + 1}) g(b)
               LEFT JOIN (SELECT bk, count(*) AS n FROM (
                   SELECT CASE WHEN mx > mn THEN least(CAST(floor({k} * (CAST({col} AS DOUBLE) - mn) / (mx - mn)) AS BIGINT) + 1, {k}) ELSE 1 END AS bk
                   FROM {src} CROSS JOIN (SELECT CAST(min({col}) AS DOUBLE) AS mn, CAST(max({col}) AS DOUBLE) AS mx FROM {src}) r2) q
                 GROUP BY bk) c ON c.bk = g.b)"""


ORACLE["life_histogram"] = with_(
    li_ctes(), f"SELECT bin, {r6('lower')} AS lower, {r6('upper')} AS upper, n FROM {equal_width_sql('lv', 'life', 20)} h"
)

ORACLE["rul_histogram"] = with_(
    li_ctes() + ["rr AS (SELECT CAST(life - cycle AS DOUBLE) AS rul_raw, rul FROM lab)"],
    f"""SELECT bin, {r6('lower')} AS lower, {r6('upper')} AS upper, n, 'raw' AS label FROM {equal_width_sql('rr', 'rul_raw', 40)} h1
        UNION ALL
        SELECT bin, {r6('lower')} AS lower, {r6('upper')} AS upper, n, 'capped' AS label FROM {equal_width_sql('rr', 'rul', 40)} h2""",
)

ORACLE["psi_train_vs_test"] = with_(
    li_ctes() + [
        f"qs AS ({quantiles_sql('ztr')})",
        f"qw AS (SELECT feature, list_concat([q[1] - {d(C.PSI_EPS)}], q[2:10], [q[11] + {d(C.PSI_EPS)}]) AS e FROM qs)",
        f"el AS ({long_sql('ztr')})",
        f"al AS ({long_sql('ztst')})",
        """eb AS (SELECT el.feature, CASE WHEN x >= e[1] AND x <= e[11] THEN least(len(list_filter(e, lambda v: v <= x)) - 1, 9) END AS bin
                 FROM el JOIN qw ON el.feature = qw.feature)""",
        """ab AS (SELECT al.feature, CASE WHEN x >= e[1] AND x <= e[11] THEN least(len(list_filter(e, lambda v: v <= x)) - 1, 9) END AS bin
                 FROM al JOIN qw ON al.feature = qw.feature)""",
        """grid AS (SELECT qw.feature, g.b AS bin FROM qw CROSS JOIN range(10) g(b))""",
        """ec AS (SELECT grid.feature, grid.bin, count(eb.bin) AS n FROM grid LEFT JOIN eb ON eb.feature = grid.feature AND eb.bin = grid.bin GROUP BY grid.feature, grid.bin)""",
        """ac AS (SELECT grid.feature, grid.bin, count(ab.bin) AS n FROM grid LEFT JOIN ab ON ab.feature = grid.feature AND ab.bin = grid.bin GROUP BY grid.feature, grid.bin)""",
        f"""es AS (SELECT feature, bin, greatest(n / greatest(sum(n) OVER (PARTITION BY feature), 1), {d(C.PSI_EPS)}) AS p FROM ec)""",
        f"""ash AS (SELECT feature, bin, greatest(n / greatest(sum(n) OVER (PARTITION BY feature), 1), {d(C.PSI_EPS)}) AS p FROM ac)""",
    ],
    f"""SELECT es.feature, {r6('sum((ash.p - es.p) * ln(ash.p / es.p))')} AS psi
        FROM es JOIN ash ON es.feature = ash.feature AND es.bin = ash.bin GROUP BY es.feature""",
)


def reference_ctes(train: str = "ztr", feats=F6) -> list[str]:
    """ri: interior edges per feature; rs: floored train shares per bin."""
    return [
        f"qs AS ({quantiles_sql(train, feats)})",
        """ri AS (SELECT feature, pos, CASE WHEN len(u) > 2 THEN u[2:len(u) - 1] ELSE [] END AS e
                 FROM (SELECT feature, pos, list_sort(list_distinct(q)) AS u FROM qs) q)""",
        f"el AS ({long_sql(train, feats=feats)})",
        """eb AS (SELECT el.feature, len(list_filter(e, lambda v: v <= x)) AS bin FROM el JOIN ri ON el.feature = ri.feature)""",
        """rgrid AS (SELECT ri.feature, ri.pos, ri.e, g.b AS bin FROM ri CROSS JOIN range(10) g(b) WHERE g.b <= len(ri.e))""",
        """rc AS (SELECT rgrid.feature, rgrid.pos, rgrid.e, rgrid.bin, count(eb.bin) AS n FROM rgrid
                 LEFT JOIN eb ON eb.feature = rgrid.feature AND eb.bin = rgrid.bin GROUP BY ALL)""",
        f"""rs AS (SELECT feature, pos, e, bin, greatest(n / sum(n) OVER (PARTITION BY feature), {d(C.PSI_EPS)}) AS ref_pct,
                   count(*) OVER (PARTITION BY feature) AS nbins FROM rc)""",
    ]


ORACLE["drift_reference"] = with_(
    li_ctes() + reference_ctes(),
    f"""SELECT feature, pos, CAST(bin AS INTEGER) AS bin,
          {r6('CASE WHEN bin > 0 THEN e[bin] END')} AS lower_edge,
          {r6('CASE WHEN bin < len(e) THEN e[bin + 1] END')} AS upper_edge,
          {r6('ref_pct')} AS ref_pct FROM rs""",
)


def cohort_psi_sql(src: str, by: str | None, train: str = "ztr", feats=F6) -> list[str]:
    """CTEs ending in cp(by?, feature, psi) for cohort rows of ``src`` vs the stored reference."""
    key = f"{by}, " if by else ""
    keysel = f"s.{by}, " if by else ""
    cohorts = f"(SELECT DISTINCT {by} FROM {src})" if by else "(SELECT 1 AS one)"
    join_key = f"ac.{by} = gg.{by} AND " if by else ""
    grp = f"gg.{by}, " if by else ""
    part = f"PARTITION BY {by}, feature" if by else "PARTITION BY feature"
    ext = by if by else ""
    return reference_ctes(train, feats) + [
        f"al AS ({long_sql(src, ext, feats) if by else long_sql(src, feats=feats)})",
        f"""ab AS (SELECT {('al.' + by + ', ') if by else ''}al.feature, len(list_filter(ri.e, lambda v: v <= x)) AS bin
                 FROM al JOIN ri ON al.feature = ri.feature WHERE NOT isnan(x))""",
        f"ac AS (SELECT {key}feature, bin, count(*) AS n FROM ab GROUP BY ALL)",
        f"""gg AS (SELECT {('c.' + by + ', ') if by else ''}rs.feature, rs.bin, rs.ref_pct, rs.nbins FROM {cohorts} c CROSS JOIN rs)""",
        f"""cj AS (SELECT {grp}gg.feature, gg.bin, gg.ref_pct, gg.nbins, coalesce(ac.n, 0) AS n FROM gg
                 LEFT JOIN ac ON {join_key}ac.feature = gg.feature AND ac.bin = gg.bin)""",
        f"""cs AS (SELECT *, greatest(n / greatest(sum(n) OVER ({part}), 1), {d(C.PSI_EPS)}) AS p FROM cj)""",
        f"""cp AS (SELECT {key}feature, CASE WHEN max(nbins) < 2 THEN {d(0)}
                    ELSE sum((p - ref_pct) * ln(p / ref_pct)) END AS psi FROM cs GROUP BY ALL)""",
    ]


def severity_sql(e: str) -> str:
    return (f"CASE WHEN {e} < {d(C.PSI_MODERATE)} THEN 'stable' WHEN {e} <= {d(C.PSI_ALARM)} "
            f"THEN 'moderate' ELSE 'significant' END")


ORACLE["drift_fleet"] = with_(
    li_ctes() + cohort_psi_sql("ztst", None),
    f"""SELECT cp.feature, ri.pos, {display_sql('cp.feature')} AS signal, {r6('cp.psi')} AS psi, {severity_sql('cp.psi')} AS severity
        FROM cp JOIN ri ON cp.feature = ri.feature ORDER BY cp.psi DESC""",
)

ORACLE["drift_by_engine"] = with_(
    li_ctes() + cohort_psi_sql("ztst", "engine_id"),
    f"SELECT engine_id, feature, {r6('psi')} AS psi FROM cp",
)

ORACLE["drift_recent"] = with_(
    li_ctes() + [f"recent AS (SELECT * FROM ztst WHERE cycle > life - {C.DRIFT_RECENT})"] + cohort_psi_sql("recent", "engine_id"),
    f"SELECT engine_id, feature, {r6('psi')} AS psi FROM cp",
)

ORACLE["drift_alarms"] = with_(
    li_ctes() + cohort_psi_sql("ztst", None),
    f"""SELECT CAST(count(*) AS BIGINT) AS n_alarms,
          coalesce(string_agg({display_sql('cp.feature')}, ', ' ORDER BY cp.psi DESC, ri.pos), '') AS alarms
        FROM cp JOIN ri ON cp.feature = ri.feature WHERE cp.psi > {d(C.PSI_ALARM)}""",
)


def gaussian_psi_sql() -> str:
    zs = "[" + ", ".join(repr(z) for z in __import__("wearline.operators.drift", fromlist=["x"]).NORMAL_DECILES) + "]"
    ge = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, list_transform({zs}, lambda z: mean_{f} + greatest(coalesce(std_{f}, 0), {d(C.PSI_EPS)}) * z) AS e FROM zst"
        for f in F6
    )
    return with_(
        full_ctes() + [
            f"ge AS ({ge})",
            f"recent AS (SELECT * FROM ztst WHERE cycle > life - {L})",
            f"al AS ({long_sql('recent', 'engine_id')})",
            "ab AS (SELECT al.engine_id, al.feature, len(list_filter(ge.e, lambda v: v <= x)) AS bin FROM al JOIN ge ON al.feature = ge.feature)",
            "ac AS (SELECT engine_id, feature, bin, count(*) AS n FROM ab GROUP BY ALL)",
            f"gg AS (SELECT c.engine_id, ge.feature, g.b AS bin FROM (SELECT DISTINCT engine_id FROM recent) c CROSS JOIN ge CROSS JOIN range({C.PSI_BINS}) g(b))",
            """cj AS (SELECT gg.*, coalesce(ac.n, 0) AS n FROM gg LEFT JOIN ac
                     ON ac.engine_id = gg.engine_id AND ac.feature = gg.feature AND ac.bin = gg.bin)""",
            f"cs AS (SELECT *, greatest(n / greatest(sum(n) OVER (PARTITION BY engine_id, feature), 1), {d(C.PSI_EPS)}) AS p FROM cj)",
        ],
        f"""SELECT engine_id, feature, {r6(f'sum((p - {d(1 / C.PSI_BINS)}) * ln(p / {d(1 / C.PSI_BINS)}))')} AS psi
            FROM cs GROUP BY engine_id, feature""",
    )


ORACLE["psi_gaussian"] = gaussian_psi_sql()


# --- written tables, requests, guards -------------------------------------------

ORACLE["splits_roundtrip"] = with_(
    li_ctes() + [
        f"zval AS (SELECT engine_id, cycle, life, rul, {sql_list(f'({f} - sc.mu_{f}) / sc.sd_{f} AS {f}' for f in F6)} FROM lab CROSS JOIN sc WHERE split = 'val')",
        "allz AS (SELECT 'train' AS split, engine_id, rul FROM ztr UNION ALL SELECT 'val', engine_id, rul FROM zval UNION ALL SELECT 'test', engine_id, rul FROM ztst)",
    ],
    f"""SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT engine_id) AS BIGINT) AS n_engines,
          {r6('sum(rul)')} AS rul_sum FROM allz GROUP BY split""",
)

ORACLE["last_window_table"] = with_(
    li_ctes(),
    f"""SELECT engine_id, CAST(count(*) AS BIGINT) AS n_rows, min(cycle) AS first_cycle, max(cycle) AS last_cycle,
          {sql_list(f'{r6(f"avg({f})")} AS {f}_mean' for f in F6)}
        FROM tst WHERE cycle > life - {L} GROUP BY engine_id""",
)

_LO = C.ORDERS_FLEET.window
ORDERS_WIN = orders_ctes() + [
    f"""ow AS (SELECT engine_id, CAST(count(*) AS BIGINT) AS n, avg(totalprice) AS m FROM (
          SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle DESC) AS rn FROM fo) q
        WHERE rn <= {_LO} GROUP BY engine_id)""",
]

ORACLE["request_violations"] = with_(
    ORDERS_WIN,
    f"""SELECT engine_id, n AS n_rows, n = {_LO} AS valid,
          CASE WHEN engine_id < 1 THEN 'engine_id must be >= 1'
               WHEN n <> {_LO} THEN 'sensor_window must have {_LO} rows, got ' || CAST(n AS VARCHAR) END AS reason
        FROM ow""",
)

_OF = C.ORDERS_FLEET
ORACLE["guarded_windows"] = with_(
    ORDERS_WIN + [f"""osc AS (SELECT avg(totalprice) AS mu, stddev_pop(totalprice) AS sd FROM fo
        WHERE engine_id BETWEEN 1 AND (SELECT CAST(floor({_OF.train_fraction} * max(engine_id)) AS BIGINT) FROM fo))"""],
    f"""SELECT engine_id, CASE WHEN n <> {_LO} THEN 'shape mismatch' END AS reason,
          CASE WHEN n = {_LO} THEN {r6(f'{d(_OF.bias)} + {d(_OF.weight("totalprice"))} * ((m - mu) / sd)')} END AS predicted_rul,
          CAST(NULL AS VARCHAR) AS output_reason
        FROM ow CROSS JOIN osc""",
)

ORACLE["window_input_stats"] = with_(
    li_ctes() + [
        f"lw AS (SELECT * FROM ztst WHERE cycle > life - {L} AND life >= {L})",
        f"vals AS ({' UNION ALL '.join(f'SELECT engine_id, {f} AS x FROM lw' for f in F6)})",
    ],
    f"SELECT engine_id, {r6('avg(x)')} AS mean, {r6('stddev_pop(x)')} AS std FROM vals GROUP BY engine_id",
)

ORACLE["forecaster_saved"] = with_(
    li_ctes(), f"SELECT engine_id, max(cycle) AS cycle, true AS same FROM tst GROUP BY engine_id HAVING count(*) >= {L}")

ORACLE["pluggable_scorer"] = with_(
    li_ctes() + [last_win_cte("g", None)],
    f"""SELECT engine_id, CASE WHEN n_rows <> {L} THEN 'shape mismatch' END AS reason,
          CASE WHEN n_rows = {L} THEN {r6('p')} END AS predicted_rul, CAST(NULL AS VARCHAR) AS output_reason FROM g""",
)


# --- streaming (batch-equivalent SQL over the events table) ------------------------

EV = C.EVENTS_FLEET
EVF = EV.features


def events_ctes() -> list[str]:
    mu_sd = []
    for f in EVF:
        sd = f"stddev_pop({f})"
        mu_sd.append(f"avg({f}) AS mu_{f}")
        mu_sd.append(f"CASE WHEN {sd} IS NULL OR {sd} <= 1e-9 * greatest(1, abs(avg({f}))) THEN {d(1)} ELSE {sd} END AS sd_{f}")
    return [
        f"""fe AS (SELECT CAST(user_id + 1 AS BIGINT) AS engine_id,
              CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS cycle,
              CAST(value AS DOUBLE) AS value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
              CAST(hour(ts) AS DOUBLE) AS hour, CASE WHEN event_type = 'error' THEN {d(1)} ELSE {d(0)} END AS is_error
            FROM events)""",
        "fev AS (SELECT engine_id, max(cycle) AS life FROM fe GROUP BY engine_id)",
        f"esc AS (SELECT {sql_list(mu_sd)} FROM fe WHERE engine_id <= (SELECT CAST(floor({EV.train_fraction} * max(engine_id)) AS BIGINT) FROM fe))",
        f"zfe AS (SELECT fe.engine_id, fe.cycle, fev.life, {sql_list(f'({f} - esc.mu_{f}) / esc.sd_{f} AS {f}' for f in EVF)} FROM fe JOIN fev ON fe.engine_id = fev.engine_id CROSS JOIN esc)",
    ]


def ev_forecast(fmt: str) -> str:
    return "(" + " + ".join([d(EV.bias)] + [f"{d(EV.weight(f))} * {fmt.format(f=f)}" for f in EVF if EV.weight(f)]) + ")"


ORACLE["stream_scoring"] = with_(
    events_ctes(),
    f"""SELECT engine_id, max(life) AS n_seen, {r6(ev_forecast('avg({f})'))} AS predicted_rul
        FROM zfe WHERE cycle > life - {EV.window} AND life >= {EV.window} GROUP BY engine_id""",
)

ORACLE["stream_counters"] = f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       CAST(count(*) AS BIGINT) AS n_readings,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_errors,
       {r6('max(value)')} AS max_value, {r6('arg_max(value, (ts, event_id))')} AS last_value
FROM events GROUP BY date_trunc('hour', ts)"""

ORACLE["stream_dedup"] = "SELECT CAST(user_id + 1 AS BIGINT) AS engine_id, CAST(count(*) AS BIGINT) AS n_readings FROM events GROUP BY user_id"

ORACLE["stream_late"] = """
WITH e AS (SELECT event_id, CAST(user_id + 1 AS BIGINT) AS engine_id, ts,
                  [3, 1, 0, 2, 5, 4, 8, 9, 7, 6][CAST(least(floor((day(ts) - 1) / 3), 9) AS INT) + 1] AS b FROM events),
del AS (SELECT *, false AS again FROM e UNION ALL SELECT event_id, engine_id, ts, b + 1, true FROM e WHERE event_id % 3 = 0),
seen AS (SELECT b, max(epoch_ms(max(ts))) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ms FROM del GROUP BY b),
r AS (SELECT engine_id, CASE WHEN epoch_us(ts) < 1000 * greatest(coalesce(ms - 5 * 24 * 3600 * 1000, 0), 0) THEN 'late'
                             WHEN again THEN 'repeat' ELSE 'kept' END AS route FROM del JOIN seen USING (b))
SELECT engine_id, CAST(count(*) FILTER (WHERE route = 'kept') AS BIGINT) AS n_kept,
       CAST(count(*) FILTER (WHERE route = 'late') AS BIGINT) AS n_late,
       CAST(count(*) FILTER (WHERE route = 'repeat') AS BIGINT) AS n_repeat, CAST(count(*) AS BIGINT) AS n_delivered
FROM r GROUP BY engine_id"""

ORACLE["stream_quarantine"] = "SELECT CAST(count(*) AS BIGINT) AS n_good, CAST(0 AS BIGINT) AS n_rejected FROM events"

ORACLE["telemetry_scan"] = with_(
    li_ctes(), f"SELECT engine_id, cycle, {sql_list(f'{r6(f)} AS {f}' for f in F6)} FROM f"
)

ORACLE["weighted_loss"] = with_(
    li_ctes() + [
        f"zl AS (SELECT engine_id, cycle, life, rul, split, {sql_list(f'({f} - sc.mu_{f}) / sc.sd_{f} AS {f}' for f in F6)} FROM lab CROSS JOIN sc WHERE split IS NOT NULL)",
        f"""fr AS (SELECT split, engine_id, cycle, rul, {forecast_sql('avg({f}) OVER w')} AS p FROM zl
              WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW))""",
        f"""bl AS (SELECT split, (engine_id * {C.HASH_ID} + cycle * {C.HASH_CYCLE} + {LI.seed}) % {C.HASH_MOD} % 64 AS step,
              avg((p - rul) * (p - rul)) AS loss, count(*) AS n FROM fr WHERE cycle >= {L} GROUP BY ALL)""",
    ],
    f"SELECT split, {r6('sum(loss * n) / greatest(sum(n), 1)')} AS loss, CAST(sum(n) AS BIGINT) AS n FROM bl GROUP BY split",
)


ORACLE["stream_drift"] = with_(
    events_ctes() + [
        "zfe_tr AS (SELECT * FROM zfe WHERE engine_id <= (SELECT CAST(floor(%r * max(engine_id)) AS BIGINT) FROM fe))" % EV.train_fraction,
    ] + cohort_psi_sql("zfe", None, train="zfe_tr", feats=EVF),
    f"SELECT CAST(0 AS BIGINT) AS epoch, feature, {r6('psi')} AS psi, psi > {d(C.PSI_ALARM)} AS alarm FROM cp",
)


# --- planted faults on further paths -----------------------------------------------

BAD_F6 = " OR ".join(f"{f} IS NULL OR NOT isfinite({f})" for f in F6)
BAD_WINDOW = f"coalesce(max(CASE WHEN {BAD_F6} THEN 1 ELSE 0 END) OVER w, 0) = 1"
FRAME = f"WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW)"


def fine(f: str) -> str:
    return f"CASE WHEN isfinite({f}) THEN {f} END"


def faulty_z(name: str, src: str, extra: str = "") -> list[str]:
    return [faulty_sql(f"{name}_f", src),
            f"{name} AS (SELECT engine_id, cycle, life, rul{extra}, {sql_list(f'({f} - sc.mu_{f}) / sc.sd_{f} AS {f}' for f in F6)} FROM {name}_f CROSS JOIN sc)"]


ORACLE["degradation_curve_faulty"] = with_(
    li_ctes() + faulty_z("zf", "tlab"),
    f"""SELECT engine_id, cycle, {r6('rul')} AS true_rul, CASE WHEN NOT bad THEN {r6('p')} END AS predicted_rul,
          CASE WHEN bad THEN 'reading missing or not finite' END AS reason FROM (
          SELECT engine_id, cycle, rul, {BAD_WINDOW} AS bad, {forecast_sql(f"avg({fine('{f}')}) OVER w")} AS p FROM zf {FRAME}) q
        WHERE cycle >= {L}""",
)

_PF = forecast_sql(f"avg({fine('{f}')})")
ORACLE["fleet_health_faulty"] = with_(
    li_ctes() + li_importance_ctes() + [li_stats_cte()] + faulty_z("zf", "tlab") + [
        f"""fc AS (SELECT engine_id, count(*) AS window_rows, bool_or({BAD_F6}) AS bad, CASE WHEN {_PF} < 0 THEN {d(0)} ELSE {_PF} END AS p
            FROM zf WHERE cycle > life - {L} GROUP BY engine_id)""",
        "lastz AS (SELECT * FROM zf WHERE cycle = life)",
        f"ws AS ({warning_long_sql('lastz')})",
        "top AS (SELECT engine_id, feature FROM (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY score DESC, pos) AS rn FROM ws) WHERE rn = 1)",
    ],
    f"""SELECT fc.engine_id, CAST(fc.window_rows AS BIGINT) AS window_rows, CASE WHEN NOT bad THEN {r6('fc.p')} END AS predicted_rul,
        CASE WHEN NOT bad THEN {status_sql('fc.p', True)} END AS health_status,
        CASE WHEN NOT bad THEN {r6(f'least(fc.p / {d(C.RUL_CAP)} * 100, 100)')} END AS life_pct,
        CASE WHEN NOT bad THEN {display_sql('top.feature')} END AS top_signal,
        CASE WHEN NOT bad THEN {action_sql(status_sql('fc.p', True), True)} END AS action,
        CASE WHEN bad THEN '{C.BAD_READING}' END AS reason
    FROM fc JOIN top ON fc.engine_id = top.engine_id""",
)

ORACLE["most_critical_faulty"] = with_(
    li_ctes() + faulty_z("zf", "tlab") + [
        f"""g AS (SELECT engine_id, {forecast_sql('avg({f})')} AS p FROM zf WHERE cycle > life - {L} GROUP BY engine_id
              HAVING NOT bool_or({BAD_F6}))"""],
    f"""SELECT engine_id, {r6('pc')} AS predicted_rul FROM (SELECT engine_id, CASE WHEN p < 0 THEN {d(0)} ELSE p END AS pc FROM g) q
        ORDER BY pc, engine_id LIMIT 1""",
)

ORACLE["weighted_loss_faulty"] = with_(
    li_ctes() + faulty_z("zl", "lab", ", split") + [
        f"""fr AS (SELECT split, engine_id, cycle, rul, {BAD_WINDOW} AS bad, {forecast_sql(f"avg({fine('{f}')}) OVER w")} AS p
              FROM zl WHERE split IS NOT NULL {FRAME})""",
        "ok AS (SELECT split, (p - rul) * (p - rul) AS e FROM fr WHERE cycle >= %d AND NOT bad)" % L],
    f"SELECT split, {r6('avg(e)')} AS loss, CAST(count(*) AS BIGINT) AS n FROM ok GROUP BY split",
)

ORACLE["scaler_fit_faulty"] = with_(
    li_ctes() + [faulty_sql("trf", "tr"), "scf AS (SELECT " + sql_list(
        x for f in F6 for x in (f"avg({fine(f)}) AS mu_{f}", f"CASE WHEN stddev_pop({fine(f)}) IS NULL OR stddev_pop({fine(f)}) <= 1e-9 * "
                                f"greatest(1, abs(avg({fine(f)}))) THEN {d(1)} ELSE stddev_pop({fine(f)}) END AS sd_{f}")) + " FROM trf)"],
    unpivot_sql("scf", {"mu": "mu_{f}", "sigma": "sd_{f}"}))


def window_features_faulty_sql() -> str:
    cols, out = [], []
    for f in F6:
        g = fine(f)
        cols += [f"{f} AS {f}_last", f"avg({g}) OVER w AS {f}_mean", f"stddev_pop({g}) OVER w AS {f}_std",
                 f"regr_slope({g}, CAST(cycle AS DOUBLE)) OVER w AS {f}_slope"]
        out += [f"CASE WHEN NOT bad THEN {r6(f'{f}_{k}')} END AS {f}_{k}" for k in ("last", "mean", "std", "slope")]
    return with_(li_ctes() + [faulty_sql("lf", "lab"), f"wf AS (SELECT engine_id, cycle, rul, {BAD_WINDOW} AS bad, {sql_list(cols)} FROM lf {FRAME})"],
                 f"""SELECT engine_id, cycle, {sql_list(out)}, {r6('rul')} AS rul, CASE WHEN bad THEN 'reading missing or not finite' END AS reason
                     FROM wf WHERE cycle >= {L}""")


ORACLE["window_features_faulty"] = window_features_faulty_sql()

ORACLE["early_stop_point"] = with_(
    li_ctes() + [
        f"zl AS (SELECT engine_id, cycle, life, rul, split, {sql_list(f'({f} - sc.mu_{f}) / sc.sd_{f} AS {f}' for f in F6)} FROM lab CROSS JOIN sc WHERE split IS NOT NULL)",
        f"""fr AS (SELECT split, engine_id, cycle, rul, {forecast_sql('avg({f}) OVER w')} AS p FROM zl {FRAME})""",
        f"""ls AS (SELECT split AS run_id, (engine_id * {C.HASH_ID} + cycle * {C.HASH_CYCLE} + {LI.seed}) % {C.HASH_MOD} % 64 AS step,
              round(avg((p - rul) * (p - rul)), 6) AS mse, round(avg(abs(p - rul)), 6) AS mae FROM fr WHERE cycle >= {L} GROUP BY ALL)""",
        "lg AS (SELECT run_id, step, 'mse' AS metric, mse AS value FROM ls UNION ALL SELECT run_id, step, 'mae', mae FROM ls)",
        """b AS (SELECT *, min(value) OVER (PARTITION BY run_id, metric ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb,
              min(value) OVER (PARTITION BY run_id, metric ORDER BY step) AS best FROM lg)""",
        "im AS (SELECT *, pb IS NULL OR value < pb AS improved FROM b)",
        "il AS (SELECT *, sum(CASE WHEN improved THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, metric ORDER BY step) AS island FROM im)",
        "si AS (SELECT *, row_number() OVER (PARTITION BY run_id, metric, island ORDER BY step) - 1 AS since FROM il)",
        "sp AS (SELECT run_id, metric, min(step) FILTER (WHERE since >= 5) AS stop_step FROM si GROUP BY ALL)",
    ],
    f"""SELECT run_id, metric, CAST(count(*) AS BIGINT) AS n_steps, any_value(stop_step) AS stop_step,
          max(step) FILTER (WHERE improved AND step <= coalesce(stop_step, step)) AS best_step,
          {r6('min(value) FILTER (WHERE step <= coalesce(stop_step, step))')} AS best_value
        FROM si JOIN sp USING (run_id, metric) GROUP BY run_id, metric""",
)

ORACLE["checksum_statuses"] = with_(
    li_ctes() + ["""fl AS (SELECT engine_id, string_agg(engine_id || ' ' || cycle || ' ' || CAST(quantity AS BIGINT) || chr(10), '' ORDER BY cycle) AS content
              FROM f GROUP BY engine_id)"""],
    """SELECT engine_id, CASE engine_id % 10 WHEN 3 THEN 'missing' WHEN 7 THEN 'mismatch' ELSE 'ok' END AS status,
          sha256(content) AS actual, CAST(strlen(content) AS BIGINT) AS n_bytes FROM fl""",
)
