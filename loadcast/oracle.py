"""DuckDB SQL for the correctness oracle: the test views of ``sources.testviews`` and the
expected result of every registered query, written directly from the definitions (sliding
frames, plain window functions, CASE pivots) rather than from the Spark plans.

Rolling statistics are compared exactly: both sides sum integers (values x 100) and apply
the same final double formula, so results agree bit for bit."""

from __future__ import annotations

from loadcast.plans.weather import WEATHER_KEYS
from loadcast.sources import testviews as tv

G = tv.N_GROUPS
KEYS_SQL = ", ".join(f"'{k}'" for k in WEATHER_KEYS)


def _pick(values: list[str], idx: str) -> str:
    arr = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"([{arr}])[({idx}) % {len(values)} + 1]"


def _temp_text(v: str, e: str) -> str:
    return f"CASE WHEN {e} % 17 = 0 THEN '-' WHEN {e} % 23 = 0 THEN 'NaN' ELSE CAST({v} AS VARCHAR) END"


def _special_desc() -> str:
    whens = " ".join(
        f"WHEN strftime(d, '%Y-%m-%d') = '{k}' THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'")
        for k, v in tv.SPECIAL_DAYS.items()
    )
    return f"CASE {whens} WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'working day' END"


def pivot_cols(value: str, key: str = "group_id", agg: str = "max") -> str:
    return ", ".join(f'{agg}(CASE WHEN {key} = {g} THEN {value} END) AS "{g}"' for g in range(G))


L = tv.LANDING_TABLES

VIEWS: dict[str, str] = {
    "ev_h": "SELECT date_trunc('hour', ts) AS h, user_id, event_type, event_id, CAST(value AS DECIMAL(12,2)) AS v FROM events",
    "hours": "SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM (SELECT min(h) AS lo, max(h) AS hi FROM ev_h)",
    "cells": f"SELECT h, CAST(user_id % {G} AS INTEGER) AS g, CAST(SUM(v) AS DOUBLE) AS v FROM ev_h GROUP BY 1, 2",
    "cons": (
        "SELECT hr.h AS timestamp_utc, k.g AS group_id, c.v AS target_consumption "
        f"FROM hours hr CROSS JOIN (SELECT CAST(range AS INTEGER) AS g FROM range({G})) k "
        "LEFT JOIN cells c ON c.h = hr.h AND c.g = k.g"
    ),
    "cons_wide": f"SELECT strftime(hr.h, '%Y-%m-%d %H:%M:%S') AS measured_at, {pivot_cols('c.v', 'c.g')} "
                 "FROM hours hr LEFT JOIN cells c ON c.h = hr.h GROUP BY hr.h",
    "price": "SELECT h AS timestamp_utc, CAST(SUM(v) AS DOUBLE) AS eur_per_mwh FROM ev_h GROUP BY h",
    "cal_raw": (
        f"SELECT strftime(d, '%Y-%m-%d') AS timestamp, {_special_desc()} AS \"desc\" "
        "FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)"
    ),
    "cal_raw2": "SELECT timestamp, \"desc\", \"desc\" = 'working day' AS working_day FROM cal_raw",
    "cal_hourly": (
        "SELECT \"desc\", working_day, t AS timestamp_utc, CAST(hour(t) AS INTEGER) AS hour_of_day, "
        "CAST(isodow(t) AS INTEGER) AS day_of_week, CASE WHEN isodow(t) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, "
        "CASE WHEN NOT (\"desc\" IN ('weekend', 'working day')) THEN 1 ELSE 0 END AS is_holiday, "
        "CAST(month(t) AS INTEGER) AS month, CAST(dayofyear(t) AS INTEGER) AS day_of_year "
        "FROM cal_raw2, unnest(generate_series(CAST(timestamp AS TIMESTAMP), CAST(timestamp AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS u(t)"
    ),
    "wx_inf_raw": (
        f"SELECT strftime(h, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, city, {_temp_text('t', 'e')} AS TA_PT1H_AVG "
        f"FROM (SELECT h, {_pick(tv.CITIES, 'user_id')} AS city, max(v) AS t, min(event_id) AS e "
        "FROM ev_h GROUP BY 1, 2)"
    ),
    "wx_inf_keyed": (
        "SELECT CAST(CAST(timestamp AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS timestamp_utc, "
        "TRY_CAST(TA_PT1H_AVG AS DOUBLE) AS temperature, "
        "CASE WHEN upper(substr(translate(lower(trim(city)), 'äöå', 'aoa'), 1, 3)) IN "
        "(" + KEYS_SQL + ") "
        "THEN upper(substr(translate(lower(trim(city)), 'äöå', 'aoa'), 1, 3)) END AS weather_key FROM wx_inf_raw"
    ),
    "wx_inf": (
        "SELECT timestamp_utc, temperature, weather_key FROM (SELECT *, row_number() OVER "
        "(PARTITION BY weather_key ORDER BY timestamp_utc DESC) AS rn FROM wx_inf_keyed) WHERE rn > 1"
    ),
    "wx_inf_dense": (
        "SELECT k.weather_key, t AS timestamp_utc, o.temperature FROM (SELECT DISTINCT weather_key FROM wx_inf) k "
        f"CROSS JOIN unnest(generate_series(TIMESTAMP '{tv.WX_MIN}', TIMESTAMP '{tv.WX_MAX}', INTERVAL 1 HOUR)) AS u(t) "
        "LEFT JOIN wx_inf o ON o.weather_key = k.weather_key AND o.timestamp_utc = u.t"
    ),
    "wx_inf_feat": (
        "SELECT weather_key, timestamp_utc, temperature_missing_flag, temp_lag_24, temp_lag_48, temp_lag_168 FROM ("
        "SELECT weather_key, timestamp_utc, temperature_missing_flag, lag(tf, 24) OVER w AS temp_lag_24, "
        "lag(tf, 48) OVER w AS temp_lag_48, lag(tf, 168) OVER w AS temp_lag_168, row_number() OVER w AS rn FROM ("
        "SELECT *, CASE WHEN temperature IS NULL THEN 1 ELSE 0 END AS temperature_missing_flag, "
        "last_value(temperature IGNORE NULLS) OVER (PARTITION BY weather_key ORDER BY timestamp_utc "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tf FROM wx_inf_dense) "
        "WINDOW w AS (PARTITION BY weather_key ORDER BY timestamp_utc)) WHERE rn > 336"
    ),
    "landing": (
        "SELECT source_table, station AS Havaintoasema, CAST(year(h) AS INTEGER) AS Vuosi, CAST(month(h) AS INTEGER) AS Kuukausi, "
        "CAST(day(h) AS INTEGER) AS \"Päivä\", h, " + _temp_text("t", "e") + " AS temp_text "
        f"FROM (SELECT h, {_pick([t for t, _ in L], 'user_id')} AS source_table, {_pick([s for _, s in L], 'user_id')} AS station, "
        "max(v) AS t, min(event_id) AS e FROM ev_h GROUP BY 1, 2, 3)"
    ),
    "wx_long": (
        "SELECT Havaintoasema, Vuosi, Kuukausi, \"Päivä\", CAST(hour(h) AS VARCHAR) || ':00' AS hour, "
        "TRY_CAST(temp_text AS DOUBLE) AS temperature, upper(substr(source_table, 1, 3)) AS weather_key, h "
        "FROM landing WHERE upper(substr(source_table, 1, 3)) IN ("
        + KEYS_SQL + ")"
    ),
    "wx_train_obs": "SELECT h AS timestamp_utc, temperature, weather_key FROM wx_long",
    "wx_train_feat_all": (
        "SELECT weather_key, timestamp_utc, temperature_missing_flag, "
        "lag(tf, 24) OVER w AS temp_lag_24, lag(tf, 48) OVER w AS temp_lag_48, lag(tf, 168) OVER w AS temp_lag_168, "
        "row_number() OVER w AS rn, count(*) OVER (PARTITION BY weather_key) AS cnt FROM ("
        "SELECT *, last_value(temperature IGNORE NULLS) OVER (PARTITION BY weather_key ORDER BY timestamp_utc "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tf FROM ("
        "SELECT k.weather_key, u.t AS timestamp_utc, o.temperature, CASE WHEN o.temperature IS NULL THEN 1 ELSE 0 END AS temperature_missing_flag "
        "FROM (SELECT DISTINCT weather_key FROM wx_train_obs) k "
        f"CROSS JOIN unnest(generate_series(TIMESTAMP '{tv.WX_MIN}', TIMESTAMP '{tv.WX_MAX}', INTERVAL 1 HOUR)) AS u(t) "
        "LEFT JOIN wx_train_obs o ON o.weather_key = k.weather_key AND o.timestamp_utc = u.t)) "
        "WINDOW w AS (PARTITION BY weather_key ORDER BY timestamp_utc)"
    ),
    # head drop 336 then drop the latest 48 of what is left
    "wx_train_feat": (
        "SELECT weather_key, timestamp_utc, temperature_missing_flag, temp_lag_24, temp_lag_48, temp_lag_168 "
        "FROM wx_train_feat_all WHERE rn > 336 AND rn <= cnt - 48"
    ),
    "groups_raw": (
        "SELECT CAST(c_custkey AS INTEGER) AS group_id, CASE WHEN c_custkey % 50 = 7 "
        "THEN concat_ws(' | ', r_name, n_name, c_name, c_mktsegment) "
        f"ELSE concat_ws(' | ', r_name, n_name, c_name, c_mktsegment, {_pick(tv.PRODUCTS, 'c_custkey')}, {_pick(tv.BUCKETS, 'c_custkey')}) END AS group_label "
        "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"
    ),
    "groups": (
        "SELECT group_id, " + ", ".join(
            f"trim(string_split(group_label, '|')[{i + 1}]) AS {n}"
            for i, n in enumerate(("macro_region", "region", "municipality", "segment", "product_type", "consumption_bucket"))
        ) + " FROM groups_raw"
    ),
    "bridge": f"SELECT CAST(c_custkey AS INTEGER) AS group_id, {_pick(tv.BRIDGE_KEYS, 'c_custkey')} AS weather_key FROM customer",
    "feat_all": (
        "SELECT timestamp_utc, group_id, target_consumption, "
        "lag(target_consumption, 48) OVER w AS consumption_lag_48, lag(target_consumption, 168) OVER w AS consumption_lag_168, "
        "lag(target_consumption, 336) OVER w AS consumption_lag_336, "
        "sum(x) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS s, "
        "sum(x * x) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS q, "
        "count(x) OVER (w ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS n, row_number() OVER w AS rn "
        "FROM (SELECT *, CAST(round(target_consumption * 100) AS BIGINT) AS x FROM cons) "
        "WINDOW w AS (PARTITION BY group_id ORDER BY timestamp_utc)"
    ),
    "feat_cols": (
        "SELECT timestamp_utc, group_id, target_consumption, consumption_lag_48, consumption_lag_168, consumption_lag_336, "
        "CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(100 AS DOUBLE)) END AS rolling_mean_168, "
        "CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / CAST(100 AS DOUBLE) END AS rolling_std_168, "
        "consumption_lag_48 - consumption_lag_168 AS lag_diff_48_168, consumption_lag_168 - consumption_lag_336 AS lag_diff_168_336, rn "
        "FROM feat_all"
    ),
    "feat": "SELECT * EXCLUDE (rn) FROM feat_cols WHERE rn > 336",
    "feat_train": f"SELECT * FROM feat WHERE timestamp_utc < TIMESTAMP '{tv.INFER_START}'",
    "feat_inf": f"SELECT * FROM feat WHERE timestamp_utc >= TIMESTAMP '{tv.INFER_START}' AND timestamp_utc < TIMESTAMP '{tv.INFER_END}'",
    "feat_base": f"SELECT * FROM feat WHERE timestamp_utc >= TIMESTAMP '{tv.BASE_START}' AND timestamp_utc < TIMESTAMP '{tv.BASE_END}'",
    "price_feat_all": (
        "SELECT timestamp_utc, lag(eur_per_mwh, 24) OVER w AS price_lag_24, lag(eur_per_mwh, 48) OVER w AS price_lag_48, "
        "lag(eur_per_mwh, 168) OVER w AS price_lag_168, row_number() OVER w AS rn FROM price WINDOW w AS (ORDER BY timestamp_utc)"
    ),
    "price_feat": "SELECT timestamp_utc, price_lag_24, price_lag_48, price_lag_168 FROM price_feat_all WHERE rn > 336",
    "cal_trim": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY timestamp_utc) AS rn FROM cal_hourly) WHERE rn > 336",
    "orders_long": (
        f"SELECT o_orderdate AS timestamp_utc, CAST(o_custkey % {G} AS INTEGER) AS group_id, "
        "CAST(o_totalprice AS DECIMAL(12,2)) AS target_consumption FROM orders"
    ),
    "supplier_daily": (
        "SELECT l_suppkey AS supplier_id, l_shipdate AS day, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity "
        "FROM lineitem GROUP BY 1, 2"
    ),
}

# Dependencies between the views (each CTE lists the views it reads).
DEPS: dict[str, list[str]] = {
    "ev_h": [], "hours": ["ev_h"], "cells": ["ev_h"], "cons": ["hours", "cells"], "cons_wide": ["hours", "cells"],
    "price": ["ev_h"], "cal_raw": [], "cal_raw2": ["cal_raw"], "cal_hourly": ["cal_raw2"],
    "wx_inf_raw": ["ev_h"], "wx_inf_keyed": ["wx_inf_raw"], "wx_inf": ["wx_inf_keyed"], "wx_inf_dense": ["wx_inf"], "wx_inf_feat": ["wx_inf_dense"],
    "landing": ["ev_h"], "wx_long": ["landing"], "wx_train_obs": ["wx_long"], "wx_train_feat_all": ["wx_train_obs"],
    "wx_train_feat": ["wx_train_feat_all"], "groups_raw": [], "groups": ["groups_raw"], "bridge": [],
    "feat_all": ["cons"], "feat_cols": ["feat_all"], "feat": ["feat_cols"], "feat_train": ["feat"], "feat_inf": ["feat"],
    "feat_base": ["feat"], "price_feat_all": ["price"], "price_feat": ["price_feat_all"], "cal_trim": ["cal_hourly"],
    "orders_long": [], "supplier_daily": [],
}


def with_views(body: str, *names: str) -> str:
    """``WITH`` the named views (and their dependencies, in order) followed by ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    return f"WITH {ctes}\n{body}" if ctes else body
