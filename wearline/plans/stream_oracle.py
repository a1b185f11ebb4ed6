"""DuckDB SQL for the streams of several micro-batches: batch queries over the parts they deliver."""

from __future__ import annotations

from .. import config as C
from .oracle import EV, EVF, ORACLE, cohort_psi_sql, d, ev_forecast, events_ctes, r6, sql_list, with_

PART = "CAST(least(floor((day(ts) - 1) / 5), 5) AS BIGINT)"
VALUE = "CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 89 = 7 THEN CAST('NaN' AS DOUBLE) ELSE CAST(value AS DOUBLE) END"
KEY = "CASE WHEN event_id % 103 = 11 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END"
DELIVERED = f"""de AS (SELECT event_id, ts, {PART} AS part, CAST(user_id + 1 AS BIGINT) AS engine_id,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS cycle,
      {VALUE} AS value, {KEY} AS k, CAST(hour(ts) AS DOUBLE) AS hour,
      CASE WHEN event_type = 'error' THEN {d(1)} ELSE {d(0)} END AS is_error FROM events)"""


def _missing(f: str) -> str:
    return f"({f} IS NULL OR isnan({f}))"


ORACLE["stream_rejects"] = with_(
    [DELIVERED],
    f"""SELECT part AS epoch, concat_ws(',', CASE WHEN event_id % 101 = 3 THEN 'engine_id_below_1' END,
          {sql_list(f"CASE WHEN {_missing(f)} THEN '{f}_missing' END" for f in EVF)}) AS violations,
          CAST(count(*) AS BIGINT) AS n_readings FROM de GROUP BY ALL""",
)


def _outside(f: str, lo: str, hi: str) -> str:
    return f"coalesce(NOT isnan({f}) AND ({f} < {lo} OR {f} > {hi}), false)"


def _ranges(name: str, src: str, engines: int) -> str:
    return f"{name} AS (SELECT {sql_list(f'min({f}) AS min_{f}, max({f}) AS max_{f}' for f in EVF)} FROM {src} WHERE engine_id <= {engines})"


_flags = {f: _outside(f, f"CASE WHEN part < 3 THEN r0.min_{f} ELSE r1.min_{f} END", f"CASE WHEN part < 3 THEN r0.max_{f} ELSE r1.max_{f} END")
          for f in EVF}
ORACLE["stream_range_flags"] = with_(
    events_ctes() + [DELIVERED, _ranges("r0", "fe", 5), _ranges("r1", "fe", 50)],
    f"""SELECT event_id, engine_id, CAST(CASE WHEN part < 3 THEN 0 ELSE 1 END AS BIGINT) AS stats_version,
          {" + ".join(f"CAST({x} AS BIGINT)" for x in _flags.values())} AS n_flags,
          concat_ws(',', {sql_list(f"CASE WHEN {x} THEN '{f}' END" for f, x in _flags.items())}) AS flagged_features,
          ({" OR ".join(_flags.values())}) AS any_flag FROM de CROSS JOIN r0 CROSS JOIN r1""",
)

_LAST = " OR ".join(_outside(f"z{f}", f"zr.min_{f}", f"zr.max_{f}") for f in EVF)
_BOUNDS = (3600.0, 6 * 3600.0, 24 * 3600.0, 48 * 3600.0)
_bucket = [f"{'' if i == 0 else f'latency_s > {d(_BOUNDS[i - 1])} AND '}{'true' if i == len(_BOUNDS) else f'latency_s <= {d(_BOUNDS[i])}'}"
           for i in range(len(_BOUNDS) + 1)]
ORACLE["stream_scored_counters"] = with_(
    events_ctes() + [
        DELIVERED, _ranges("zr", "zfe", 5),
        f"""zd AS (SELECT de.engine_id, event_id, cycle, ts, part, {sql_list(f"(de.{f} - esc.mu_{f}) / esc.sd_{f} AS z{f}" for f in EVF)}
              FROM de CROSS JOIN esc)""",
        f"""wd AS (SELECT *, max(CASE WHEN {" OR ".join(f"z{f} IS NULL OR NOT isfinite(z{f})" for f in EVF)} THEN 1 ELSE 0 END) OVER w AS bad,
              {ev_forecast("avg(CASE WHEN isfinite(z{f}) THEN z{f} END) OVER w")} AS p,
              max(cycle) OVER (PARTITION BY engine_id, part) AS last_cycle FROM zd
              WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {EV.window - 1} PRECEDING AND CURRENT ROW))""",
        f"""rc AS (SELECT engine_id, ts, CASE WHEN bad = 0 THEN p END AS p, ({_LAST}) AS any_flag,
              (epoch_us(date_trunc('month', ts) + to_days(CAST((part + 1) * 5 + CASE WHEN part = 5 THEN 1 ELSE 0 END AS INT))) - epoch_us(ts))
                / {d(1e6)} AS latency_s
              FROM wd CROSS JOIN zr WHERE cycle = last_cycle AND cycle >= {EV.window})""",
    ],
    f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
          CAST(count(p) AS BIGINT) AS n_scored, CAST(count(*) - count(p) AS BIGINT) AS n_rejected,
          CAST(count(*) FILTER (WHERE p IS NOT NULL AND any_flag) AS BIGINT) AS n_drifted,
          {r6("arg_max(p, (ts, engine_id)) FILTER (WHERE p IS NOT NULL)")} AS last_prediction,
          {sql_list(f"CAST(count(*) FILTER (WHERE p IS NOT NULL AND {b}) AS BIGINT) AS latency_{i}" for i, b in enumerate(_bucket))},
          {r6("sum(latency_s) FILTER (WHERE p IS NOT NULL)")} AS latency_sum, {r6("max(latency_s) FILTER (WHERE p IS NOT NULL)")} AS latency_max
        FROM rc GROUP BY 1""",
)

ORACLE["stream_drift_batches"] = with_(
    events_ctes() + [
        "zfe_tr AS (SELECT * FROM zfe WHERE engine_id <= (SELECT CAST(floor(%r * max(engine_id)) AS BIGINT) FROM fe))" % EV.train_fraction,
        DELIVERED,
        "zpt AS (SELECT zfe.*, de.part FROM zfe JOIN de USING (engine_id, cycle))",
    ] + cohort_psi_sql("zpt", "part", train="zfe_tr", feats=EVF),
    f"SELECT part AS epoch, feature, {r6('psi')} AS psi, psi > {d(C.PSI_ALARM)} AS alarm FROM cp",
)
