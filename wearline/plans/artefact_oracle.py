"""DuckDB SQL of the artefacts that are written and read back."""

from __future__ import annotations

from .oracle import _LO, F6, METRICS, ORACLE, ORDERS_WIN, li_ctes, li_stats_cte, r6, with_

ORACLE["report_table"] = ORACLE["prediction_pairs"].replace(f"{r6('p - a')} AS error, ", "")
ORACLE["model_info"] = with_(
    li_ctes() + METRICS, f"SELECT {r6('rmse')} AS rmse, {r6('mae')} AS mae, {r6('score')} AS nasa_score, n AS test_set_size FROM m")
ORACLE["stats_roundtrip"] = with_(
    li_ctes() + [li_stats_cte()],
    " UNION ALL ".join(f"SELECT '{form}' AS form, '{f}' AS feature, " + ", ".join(f"{r6(f'{k}_{f}')} AS {k}" for k in ("mean", "std", "min", "max"))
                       + " FROM zst" for form in ("lines", "object") for f in F6))
ORACLE["request_scan"] = with_(
    ORDERS_WIN,
    f"""SELECT engine_id, CAST(count(*) AS BIGINT) AS n_rows, {r6('arg_min(totalprice, cycle)')} AS first_value,
          {r6('arg_max(totalprice, cycle)')} AS last_value
        FROM (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle DESC) AS rn FROM fo) q WHERE rn <= {_LO} GROUP BY engine_id""")
