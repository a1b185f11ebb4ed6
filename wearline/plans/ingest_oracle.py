"""DuckDB SQL of the strict ingest, from the driver's tables (no text in between)."""

from __future__ import annotations

from .. import config as C
from .oracle import ORACLE, cap, d, li_ctes, r6, sql_list, with_

TF = C.TELEMETRY_FEATURES


def _value(i: int, name: str) -> str:
    if name in C.DROP_COLUMNS:
        return d(10.5 * i)
    v = f"(quantity * {d(i)}) % {d(17)} + discount"
    if name == "sensor_2":
        return f"CASE WHEN e % 17 = 0 AND c % 50 = 3 THEN NULL ELSE {v} END"
    if name == "sensor_9":
        return f"CASE WHEN e % 19 = 0 AND c % 40 = 5 THEN CAST('NaN' AS DOUBLE) ELSE {v} END"
    return v


_sensors = [f"{_value(i, n)} AS {n}" for i, n in enumerate(C.RAW_COLUMNS[5:], start=1)]
_broken = ["CASE WHEN engine_id < 1 THEN 'engine_id_below_1' END", "CASE WHEN cycle < 1 THEN 'cycle_below_1' END",
           *[f"CASE WHEN {n} IS NULL OR isnan({n}) THEN '{n}_missing' END" for n in C.RAW_COLUMNS[2:]]]
CHECKED = li_ctes() + [
    """rr AS (SELECT 'train' AS kind, engine_id AS e, cycle AS c, quantity, discount, tax, linestatus, setting FROM f
       UNION ALL SELECT 'test', engine_id, cycle, quantity, discount, tax, linestatus, setting FROM tst)""",
    f"""rv AS (SELECT kind, CASE WHEN e % 13 = 0 AND c % 90 = 2 THEN -1 ELSE e END AS engine_id,
          CASE WHEN e % 11 = 0 AND c % 80 = 2 THEN 0 ELSE c END AS cycle,
          tax AS setting_1, linestatus AS setting_2, setting AS setting_3, {sql_list(_sensors)} FROM rr)""",
    f"ck AS (SELECT *, concat_ws(',', {sql_list(_broken)}) AS violations FROM rv)",
]
ORACLE["ingest_rejects"] = with_(
    CHECKED, "SELECT kind, CAST(engine_id AS BIGINT) AS engine_id, CAST(cycle AS BIGINT) AS cycle, violations FROM ck WHERE violations <> ''")

_fit = [x for f in TF for x in (
    f"avg({f}) AS mu_{f}",
    f"CASE WHEN stddev_pop({f}) IS NULL OR stddev_pop({f}) <= 1e-9 * greatest(1, abs(avg({f}))) THEN {d(1)} ELSE stddev_pop({f}) END AS sd_{f}")]
ORACLE["ingest_splits"] = with_(
    CHECKED + [
        "ak AS (SELECT *, max(cycle) OVER (PARTITION BY kind, engine_id) AS last FROM ck WHERE violations = '')",
        f"tb AS (SELECT CAST(floor({C.TELEMETRY_FLEET.train_fraction} * max(engine_id)) AS BIGINT) AS hi FROM ak WHERE kind = 'train')",
        f"""al AS (SELECT CASE WHEN kind = 'test' THEN 'test' WHEN engine_id <= hi THEN 'train' ELSE 'val' END AS part, ak.* REPLACE (
              CASE WHEN kind = 'train' THEN CAST(last - cycle AS DOUBLE)
                   WHEN engine_id % {C.TRUTH_SKIP} <> 0 THEN CAST((engine_id * {C.TRUTH_MULT}) % {C.TRUTH_MOD} + last - cycle AS DOUBLE) END AS last)
            FROM ak CROSS JOIN tb)""",
        f"fm AS (SELECT {sql_list(_fit)} FROM al WHERE part = 'train')",
    ],
    f"""SELECT part AS split, CAST(engine_id AS BIGINT) AS engine_id, CAST(cycle AS BIGINT) AS cycle, {r6(cap('last', C.RUL_CAP))} AS rul,
          {sql_list(f"{r6(f'({f} - mu_{f}) / sd_{f}')} AS {f}" for f in TF)} FROM al CROSS JOIN fm""",
)

ORACLE["truth_positions"] = with_(
    li_ctes(),
    f"""SELECT engine_id, CASE WHEN engine_id % {C.TRUTH_SKIP} = 0 THEN CAST('NaN' AS DOUBLE)
          ELSE CAST((engine_id * {C.TRUTH_MULT}) % {C.TRUTH_MOD} AS DOUBLE) END AS final_rul
        FROM (SELECT unnest(generate_series(1, top)) AS engine_id FROM bnd)""",
)
