"""The registered queries (Spark) and their DuckDB oracles, keyed by the same names.

Each query reads the driver tables at ``sf_dir`` through ``sources.testviews`` and runs one
operator or job of the library over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions import key_from_prefix, normalize_name, to_ts, tolerant_double
from loadcast.oracle import pivot_cols, with_views
from loadcast.operators import index, joins, reshape, spine, splits, windows
from loadcast.plans import calendar, deliver, evaluate, features, gold, groups, price, weather
from loadcast.sources import payloads
from loadcast.sources import testviews as tv

TS = tv.TS
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- shared builders

def _features(spark, sf) -> DataFrame:
    return features.hourly_features(tv.consumption_long(spark, sf), scale=2)


def _split(spark, sf) -> features.HourlySplit:
    return features.split_hourly(_features(spark, sf), tv.INFER_START, tv.INFER_END, tv.BASE_START, tv.BASE_END, ts_type=TS)


def _calendar_hourly(spark, sf) -> DataFrame:
    return calendar.expand_calendar_hourly(tv.calendar_raw(spark, sf), ts_type=TS)


def _price_features(spark, sf) -> DataFrame:
    return price.price_features(tv.price_raw(spark, sf), ts_type=TS)


def _weather_training(spark, sf) -> DataFrame:
    long = weather.build_weather_long(tv.weather_landing(spark, sf), "source_table")
    obs = weather.prepare_weather_training(long, ts_type=TS)
    return weather.drop_latest_horizon(weather.weather_features(obs, tv.WX_MIN, tv.WX_MAX, ts_type=TS))


def _weather_inference(spark, sf) -> DataFrame:
    return weather.prepare_weather_inference(tv.weather_inference_raw(spark, sf), ts_type=TS)


def _groups(spark, sf) -> DataFrame:
    return groups.parse_groups(tv.groups_raw(spark, sf))


def _rounded(df: DataFrame, cols, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


FEAT_COLS = "timestamp_utc, group_id, target_consumption, " + ", ".join(features.FEATURE_COLUMNS)
GROUP_COLS = ", ".join(f"g.{c}" for c in groups.GROUP_ATTRIBUTES)
CAL_COLS = "cal.working_day, cal.\"desc\", cal.is_weekend, cal.is_holiday, cal.hour_of_day, cal.day_of_week, cal.month, cal.day_of_year"
FC = ", ".join(f"c.{c}" for c in ["timestamp_utc", "group_id", "target_consumption", *features.FEATURE_COLUMNS])
METRIC_COLS = list(evaluate.METRIC_COLUMNS)

# ---------------------------------------------------------------- reshape


@register("unpivot_wide_to_long", with_views("SELECT * FROM cons", "cons"))
def q_unpivot(spark, sf):
    return reshape.to_long(tv.consumption_wide(spark, sf), ts_type=TS)


@register("pivot_hourly", with_views(
    f"SELECT timestamp_utc + INTERVAL 7 DAY AS measured_at, {pivot_cols('target_consumption')} FROM cons GROUP BY 1", "cons"))
def q_pivot_hourly(spark, sf):
    naive = evaluate.seasonal_naive(tv.consumption_long(spark, sf), out="target_consumption")
    return deliver.hourly_deliverable(naive, tv.GROUP_IDS)


@register("pivot_monthly", with_views(
    f"SELECT measured_at, {pivot_cols('m')} FROM (SELECT group_id, date_trunc('month', timestamp_utc) AS measured_at, "
    "CAST(SUM(target_consumption) AS DOUBLE) AS m FROM orders_long GROUP BY 1, 2) GROUP BY measured_at", "orders_long"))
def q_pivot_monthly(spark, sf):
    monthly = deliver.monthly_totals(tv.orders_long(spark, sf), "predicted", ts_type=TS)
    return reshape.to_wide(monthly, "measured_at", "group_id", "monthly_consumption", tv.GROUP_IDS)


# ---------------------------------------------------------------- scalar cleaning


@register("decimal_comma_parse", with_views("SELECT timestamp_utc, eur_per_mwh FROM price", "price"))
def q_decimal_comma_parse(spark, sf):
    return price.clean_price(tv.price_raw(spark, sf), ts_type=TS)


@register("export_decimal_comma", with_views(
    "SELECT measured_at, " + ", ".join(f"replace(CAST(\"{g}\" AS VARCHAR), '.', ',') AS \"{g}\"" for g in tv.GROUP_IDS)
    + " FROM cons_wide", "cons_wide"))
def q_export_decimal_comma(spark, sf):
    return deliver.decimal_comma_projection(tv.consumption_wide(spark, sf))


@register("try_cast_numeric", with_views(
    "SELECT timestamp, city, TRY_CAST(TA_PT1H_AVG AS DOUBLE) AS temperature FROM wx_inf_raw", "wx_inf_raw"))
def q_try_cast(spark, sf):
    raw = tv.weather_inference_raw(spark, sf)
    return raw.select("timestamp", "city", tolerant_double("TA_PT1H_AVG").alias("temperature"))


@register("parse_group_label", with_views("SELECT * FROM groups", "groups"))
def q_parse_group_label(spark, sf):
    return _groups(spark, sf)


@register("normalize_city", with_views(
    "SELECT DISTINCT city, translate(lower(trim(city)), 'äöå', 'aoa') AS city_clean FROM wx_inf_raw", "wx_inf_raw"))
def q_normalize_city(spark, sf):
    raw = tv.weather_inference_raw(spark, sf)
    return raw.select("city", normalize_name("city").alias("city_clean")).distinct()


@register("wx_key_from_name", with_views(
    "SELECT DISTINCT source_table, CASE WHEN upper(substr(source_table, 1, 3)) IN ("
    + ", ".join(f"'{k}'" for k in weather.WEATHER_KEYS) + ") THEN upper(substr(source_table, 1, 3)) END AS weather_key FROM landing",
    "landing"))
def q_wx_key(spark, sf):
    names = tv.weather_landing(spark, sf).select("source_table").distinct()
    return names.select("source_table", key_from_prefix(F.col("source_table"), weather.WEATHER_KEYS).alias("weather_key"))


@register("union_sources", with_views(
    "SELECT Havaintoasema, Vuosi, Kuukausi, \"Päivä\", hour, temperature, weather_key FROM wx_long", "wx_long"))
def q_union_sources(spark, sf):
    return weather.build_weather_long(tv.weather_landing(spark, sf), "source_table")


@register("assemble_timestamp", with_views("SELECT h AS timestamp_utc, temperature, weather_key FROM wx_long", "wx_long"))
def q_assemble_timestamp(spark, sf):
    long = weather.build_weather_long(tv.weather_landing(spark, sf), "source_table")
    return weather.prepare_weather_training(long, ts_type=TS)


# ---------------------------------------------------------------- calendar, spines, grids


@register("calendar_json_flatten", with_views("SELECT * FROM cal_raw2", "cal_raw2"))
def q_calendar_json(spark, sf):
    raw = tv.calendar_raw(spark, sf)
    entry = F.struct(F.col("timestamp"), F.struct("desc", "working_day"))
    weekly = raw.groupBy(F.weekofyear(F.to_date("timestamp")).alias("week")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("payload")
    )
    return payloads.calendar_payload_rows(weekly)


@register("calendar_hourly", with_views("SELECT * FROM cal_hourly", "cal_hourly"))
def q_calendar_hourly(spark, sf):
    return _calendar_hourly(spark, sf)


@register("time_spine", with_views("SELECT h AS timestamp_utc FROM hours", "hours"))
def q_time_spine(spark, sf):
    eh = tv.event_hours(spark, sf)
    return spine.spine_between(eh.agg(F.min("h").alias("lo"), F.max("h").alias("hi")), "lo", "hi", ts_type=TS)


@register("future_grid", with_views(
    "SELECT k.group_id, u.t AS timestamp_utc, CAST(NULL AS DOUBLE) AS target_consumption "
    "FROM (SELECT DISTINCT group_id FROM cons) k CROSS JOIN unnest(generate_series("
    f"TIMESTAMP '{tv.INFER_END}', TIMESTAMP '{tv.FUTURE_END}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS u(t)", "cons"))
def q_future_grid(spark, sf):
    return features.monthly_train_inference(tv.consumption_long(spark, sf), tv.INFER_END, tv.FUTURE_END, ts_type=TS)[1]


@register("densify_grid", with_views("SELECT * FROM wx_inf_dense", "wx_inf_dense"))
def q_densify(spark, sf):
    return spine.densify(_weather_inference(spark, sf), ["weather_key"], tv.WX_MIN, tv.WX_MAX, ts_type=TS)


@register("forward_fill", with_views(
    "SELECT *, last_value(temperature IGNORE NULLS) OVER (PARTITION BY weather_key ORDER BY timestamp_utc "
    "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temperature_filled FROM wx_inf_dense", "wx_inf_dense"))
def q_forward_fill(spark, sf):
    dense = spine.densify(_weather_inference(spark, sf), ["weather_key"], tv.WX_MIN, tv.WX_MAX, ts_type=TS)
    return windows.forward_fill(dense, "temperature", keys=["weather_key"], out="temperature_filled")


# ---------------------------------------------------------------- windows


@register("lag_features", with_views(
    "SELECT timestamp_utc, group_id, target_consumption, consumption_lag_48, consumption_lag_168, consumption_lag_336, "
    "lag_diff_48_168, lag_diff_168_336 FROM feat_cols", "feat_cols"))
def q_lag_features(spark, sf):
    out = windows.lag_features(tv.consumption_long(spark, sf), "target_consumption", features.TARGET_LAGS,
                               keys=["group_id"], prefix="consumption")
    return out.withColumns({
        "lag_diff_48_168": F.col("consumption_lag_48") - F.col("consumption_lag_168"),
        "lag_diff_168_336": F.col("consumption_lag_168") - F.col("consumption_lag_336"),
    })


@register("global_lag_features", with_views(
    "SELECT timestamp_utc, price_lag_24, price_lag_48, price_lag_168 FROM price_feat_all", "price_feat_all"))
def q_global_lag(spark, sf):
    return price.price_lag_features(price.clean_price(tv.price_raw(spark, sf), ts_type=TS))


@register("global_lag_features_time", with_views(
    "SELECT p.timestamp_utc, a.eur_per_mwh AS price_lag_24, b.eur_per_mwh AS price_lag_48, c.eur_per_mwh AS price_lag_168 "
    "FROM price p LEFT JOIN price a ON a.timestamp_utc = p.timestamp_utc - INTERVAL 24 HOUR "
    "LEFT JOIN price b ON b.timestamp_utc = p.timestamp_utc - INTERVAL 48 HOUR "
    "LEFT JOIN price c ON c.timestamp_utc = p.timestamp_utc - INTERVAL 168 HOUR", "price"))
def q_global_lag_time(spark, sf):
    return price.price_lag_features(price.clean_price(tv.price_raw(spark, sf), ts_type=TS), mode="time")


@register("rolling_stats", with_views(
    "SELECT timestamp_utc, group_id, target_consumption, rolling_mean_168, rolling_std_168 FROM feat_cols", "feat_cols"))
def q_rolling_stats(spark, sf):
    return windows.rolling_moments(tv.consumption_long(spark, sf), "target_consumption", 168, 1, keys=["group_id"], scale=2)


@register("rolling_stats_doubles", with_views(
    "SELECT supplier_id, day, round(avg(x) OVER w, 3) AS mean_168, round(stddev_samp(x) OVER w, 3) AS std_168 "
    "FROM (SELECT *, 100000 + sqrt(quantity) AS x FROM supplier_daily) "
    "WINDOW w AS (PARTITION BY supplier_id ORDER BY day ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)", "supplier_daily"))
def q_rolling_stats_doubles(spark, sf):
    """Trailing statistics of doubles without a stated number of decimals: large values, small spread, merged segments."""
    series = tv.supplier_daily(spark, sf).withColumn("x", F.lit(100000) + F.sqrt("quantity"))
    out = windows.rolling_moments(series, "x", 168, 1, "day", ["supplier_id"])
    return out.select("supplier_id", "day", F.round("rolling_mean_168", 3).alias("mean_168"), F.round("rolling_std_168", 3).alias("std_168"))


@register("drop_head_per_key", with_views("SELECT timestamp_utc, group_id, target_consumption FROM feat", "feat"))
def q_drop_head_per_key(spark, sf):
    return windows.drop_head(tv.consumption_long(spark, sf), 336, keys=["group_id"])


@register("drop_head_global", with_views("SELECT * FROM price_feat", "price_feat"))
def q_drop_head_global(spark, sf):
    return _price_features(spark, sf)


@register("drop_tail_per_key", with_views("SELECT * FROM wx_inf", "wx_inf"))
def q_drop_tail(spark, sf):
    return _weather_inference(spark, sf)


@register("drop_tail_per_key_split", with_views("SELECT * FROM wx_inf", "wx_inf"))
def q_drop_tail_split(spark, sf):
    """The latest row of every weather key removed by exact position (no one-task-per-key window)."""
    raw = tv.weather_inference_raw(spark, sf)
    prepared = raw.select(
        to_ts("timestamp", TS).alias("timestamp_utc"),
        tolerant_double("TA_PT1H_AVG").alias("temperature"),
        key_from_prefix(normalize_name("city"), weather.WEATHER_KEYS).alias("weather_key"),
    )
    return index.drop_tail_positional(prepared, 1, "timestamp_utc", ["weather_key"])


@register("hourly_features", with_views("SELECT * FROM feat", "feat"))
def q_hourly_features(spark, sf):
    return _features(spark, sf)


@register("inference_features_since", with_views("SELECT * FROM feat_inf", "feat_inf"))
def q_inference_features_since(spark, sf):
    """Features of the 48 h inference window computed from a pruned scan (window start minus
    lookback and head padding) instead of the whole history; equal on the gap-free hourly grid."""
    feats = features.hourly_features(tv.consumption_long(spark, sf), scale=2, since=tv.INFER_START, ts_type=TS, gap_free=True)
    return splits.split_window(feats, tv.INFER_START, tv.INFER_END, ts_type=TS)


@register("inference_features_pruned", with_views("SELECT * FROM feat_inf", "feat_inf"))
def q_inference_features_pruned(spark, sf):
    """ACTION. Inference features from the days that the day counts show to be needed (a fortnight of the month)."""
    long = tv.consumption_long(spark, sf)
    counts = index.day_counts(long, "timestamp_utc", ["group_id"])
    feats = features.hourly_features(long, scale=2, since=tv.INFER_START, ts_type=TS, day_counts=counts)
    return splits.split_window(feats, tv.INFER_START, tv.INFER_END, ts_type=TS)


@register("hourly_features_per_group", with_views("SELECT * FROM feat", "feat"))
def q_hourly_features_per_group(spark, sf):
    """Same result through the single-shuffle plan (one window per group)."""
    return features.hourly_features(tv.consumption_long(spark, sf), scale=2, block_rows=None)


@register("hourly_features_blocked", with_views("SELECT * FROM feat", "feat"))
def q_hourly_features_blocked(spark, sf):
    """Same result as ``hourly_features`` through the blocked (hot-group-safe) plan."""
    return features.hourly_features(tv.consumption_long(spark, sf), scale=2, block_rows=512)


SUPPLIER_ORACLE = (
    "SELECT supplier_id, day, quantity, quantity_lag_1, quantity_lag_7, quantity_lag_28, "
    "CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(100 AS DOUBLE)) END AS rolling_mean_7, "
    "CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / CAST(100 AS DOUBLE) END AS rolling_std_7 "
    "FROM (SELECT *, lag(quantity, 1) OVER w AS quantity_lag_1, lag(quantity, 7) OVER w AS quantity_lag_7, "
    "lag(quantity, 28) OVER w AS quantity_lag_28, sum(x) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS s, "
    "sum(x * x) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS q, count(x) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS n, "
    "row_number() OVER w AS rn FROM (SELECT *, CAST(round(quantity * 100) AS BIGINT) AS x FROM supplier_daily) "
    "WINDOW w AS (PARTITION BY supplier_id ORDER BY day)) WHERE rn > 28"
)


def _supplier_apply(d: DataFrame, ks, order) -> DataFrame:
    d = d.withColumns(windows.lag_columns("quantity", (1, 7, 28), order, ks))
    return windows.rolling_moments(d, "quantity", 7, 1, order, ks, scale=2, mean_name="rolling_mean_7", std_name="rolling_std_7")


@register("supplier_daily_features", with_views(SUPPLIER_ORACLE, "supplier_daily"))
def q_supplier_daily(spark, sf):
    d = _supplier_apply(tv.supplier_daily(spark, sf), ["supplier_id"], "day")
    return windows.drop_head(d, 28, "day", ["supplier_id"])


@register("supplier_rolling_168", with_views(
    "SELECT supplier_id, day, quantity, "
    "CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(100 AS DOUBLE)) END AS rolling_mean_168, "
    "CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / CAST(100 AS DOUBLE) END AS rolling_std_168 "
    "FROM (SELECT *, sum(x) OVER w AS s, sum(x * x) OVER w AS q, count(x) OVER w AS n "
    "FROM (SELECT *, CAST(round(quantity * 100) AS BIGINT) AS x FROM supplier_daily) "
    "WINDOW w AS (PARTITION BY supplier_id ORDER BY day ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING))", "supplier_daily"))
def q_supplier_rolling(spark, sf):
    """The reference's trailing frame (168 rows before) on the largest derived series."""
    return windows.rolling_moments(tv.supplier_daily(spark, sf), "quantity", 168, 1, "day", ["supplier_id"], scale=2)


@register("supplier_daily_features_blocked", with_views(SUPPLIER_ORACLE, "supplier_daily"))
def q_supplier_daily_blocked(spark, sf):
    """Positional index per supplier (month buckets), then 64-row blocks with 28 rows of history."""
    daily = tv.supplier_daily(spark, sf, dealt=False)
    indexed = index.row_index(daily, "day", ["supplier_id"], bucket=F.date_trunc("month", "day"))
    out = index.blocked(indexed, ["supplier_id"], 28, 64, _supplier_apply)
    return out.filter(F.col(index.IDX) > 28).drop(index.IDX)


# ---------------------------------------------------------------- splits


@register("split_half_open", with_views("SELECT * FROM feat_train", "feat_train"))
def q_split(spark, sf):
    return _split(spark, sf).train


@register("null_target_inference", with_views(
    "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS target_consumption) FROM feat_inf", "feat_inf"))
def q_null_target(spark, sf):
    return _split(spark, sf).inference


@register("weather_features", with_views("SELECT * FROM wx_train_feat", "wx_train_feat"))
def q_weather_features(spark, sf):
    return _weather_training(spark, sf)


@register("weather_features_split", with_views("SELECT * FROM wx_train_feat", "wx_train_feat"))
def q_weather_features_split(spark, sf):
    """Same result as ``weather_features`` through the split plan (day-bucket fill, blocked lags)."""
    long = weather.build_weather_long(tv.weather_landing(spark, sf), "source_table")
    obs = weather.prepare_weather_training(long, ts_type=TS)
    feats = weather.weather_features(obs, tv.WX_MIN, tv.WX_MAX, ts_type=TS, block_rows=256)
    return index.drop_tail_positional(feats, weather.FORECAST_HORIZON, "timestamp_utc", ["weather_key"])


@register("forward_fill_split", with_views(
    "SELECT *, last_value(temperature IGNORE NULLS) OVER (PARTITION BY weather_key ORDER BY timestamp_utc "
    "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temperature_filled FROM wx_inf_dense", "wx_inf_dense"))
def q_forward_fill_split(spark, sf):
    dense = spine.densify(_weather_inference(spark, sf), ["weather_key"], tv.WX_MIN, tv.WX_MAX, ts_type=TS)
    return index.forward_fill_split(dense, "temperature", "timestamp_utc", ["weather_key"], out="temperature_filled")


# ---------------------------------------------------------------- joins and gold


@register("join_group_dim", with_views(
    f"SELECT {FC}, {GROUP_COLS} FROM feat c LEFT JOIN groups g ON c.group_id = g.group_id", "feat", "groups"))
def q_join_group_dim(spark, sf):
    dim = _groups(spark, sf)
    return _features(spark, sf).join(joins.bounded(dim), "group_id", "left")


@register("join_price_calendar", with_views(
    f"SELECT {FC}, p.price_lag_24, p.price_lag_48, p.price_lag_168, {CAL_COLS} FROM feat c "
    "LEFT JOIN price_feat p ON c.timestamp_utc = p.timestamp_utc LEFT JOIN cal_hourly cal ON c.timestamp_utc = cal.timestamp_utc",
    "feat", "price_feat", "cal_hourly"))
def q_join_price_calendar(spark, sf):
    cal = _calendar_hourly(spark, sf).select("timestamp_utc", *gold.CALENDAR_COLUMNS)
    p = _price_features(spark, sf)
    out = _features(spark, sf).join(joins.bounded(p), "timestamp_utc", "left")
    return out.join(joins.bounded(cal), "timestamp_utc", "left")


@register("join_weather_composite", with_views(
    f"SELECT {FC}, b.weather_key, w.temperature_missing_flag, w.temp_lag_24, w.temp_lag_48, w.temp_lag_168 FROM feat_train c "
    "LEFT JOIN bridge b ON c.group_id = b.group_id "
    "LEFT JOIN wx_train_feat w ON c.timestamp_utc = w.timestamp_utc AND b.weather_key = w.weather_key",
    "feat_train", "bridge", "wx_train_feat"))
def q_join_weather(spark, sf):
    fact = _split(spark, sf).train.join(joins.bounded(tv.bridge(spark, sf)), "group_id", "left")
    wx = _weather_training(spark, sf)
    return fact.join(joins.bounded(wx), ["timestamp_utc", "weather_key"], "left")


GOLD_WITH_WEATHER_SQL = (
    f"SELECT {FC}, {GROUP_COLS}, b.weather_key, p.price_lag_24, p.price_lag_48, p.price_lag_168, "
    f"w.temperature_missing_flag, w.temp_lag_24, w.temp_lag_48, w.temp_lag_168, {CAL_COLS} "
    "FROM feat_train c LEFT JOIN groups g ON c.group_id = g.group_id LEFT JOIN bridge b ON c.group_id = b.group_id "
    f"LEFT JOIN (SELECT * FROM price_feat WHERE timestamp_utc < TIMESTAMP '{tv.INFER_START}') p ON c.timestamp_utc = p.timestamp_utc "
    "LEFT JOIN wx_train_feat w ON c.timestamp_utc = w.timestamp_utc AND b.weather_key = w.weather_key "
    f"LEFT JOIN (SELECT * FROM cal_trim WHERE timestamp_utc < TIMESTAMP '{tv.INFER_START}') cal ON c.timestamp_utc = cal.timestamp_utc"
)


def gold_hourly_with_weather(spark, sf) -> DataFrame:
    cal_train, _ = calendar.split_calendar_hourly(_calendar_hourly(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    price_train, _ = price.split_price(_price_features(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    return gold.build_gold(
        _split(spark, sf).train, _groups(spark, sf), cal_train, price=price_train,
        weather=_weather_training(spark, sf), bridge=tv.bridge(spark, sf), weather_mode="join",
    )


register("gold_hourly_with_weather", with_views(
    GOLD_WITH_WEATHER_SQL, "feat_train", "groups", "bridge", "price_feat", "wx_train_feat", "cal_trim"))(gold_hourly_with_weather)


@register("gold_hourly_weather_null", with_views(
    f"SELECT c.timestamp_utc, c.group_id, CAST(NULL AS DOUBLE) AS target_consumption, "
    + ", ".join(f"c.{c}" for c in features.FEATURE_COLUMNS)
    + f", {GROUP_COLS}, b.weather_key, p.price_lag_24, p.price_lag_48, p.price_lag_168, "
    "CAST(NULL AS INTEGER) AS temperature_missing_flag, CAST(NULL AS DOUBLE) AS temp_lag_24, "
    f"CAST(NULL AS DOUBLE) AS temp_lag_48, CAST(NULL AS DOUBLE) AS temp_lag_168, {CAL_COLS} "
    "FROM feat_inf c LEFT JOIN groups g ON c.group_id = g.group_id LEFT JOIN bridge b ON c.group_id = b.group_id "
    f"LEFT JOIN (SELECT * FROM price_feat WHERE timestamp_utc >= TIMESTAMP '{tv.INFER_START}' AND timestamp_utc < TIMESTAMP '{tv.INFER_END}') p "
    "ON c.timestamp_utc = p.timestamp_utc "
    f"LEFT JOIN (SELECT * FROM cal_trim WHERE timestamp_utc >= TIMESTAMP '{tv.INFER_START}' AND timestamp_utc < TIMESTAMP '{tv.INFER_END}') cal "
    "ON c.timestamp_utc = cal.timestamp_utc",
    "feat_inf", "groups", "bridge", "price_feat", "cal_trim"))
def q_gold_weather_null(spark, sf):
    _, cal_inf = calendar.split_calendar_hourly(_calendar_hourly(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    _, price_inf = price.split_price(_price_features(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    return gold.build_gold(
        _split(spark, sf).inference, _groups(spark, sf), cal_inf, price=price_inf,
        bridge=tv.bridge(spark, sf), weather_mode="null",
    )


@register("gold_hourly_without_weather", with_views(
    f"SELECT {FC}, {GROUP_COLS}, p.price_lag_24, p.price_lag_48, p.price_lag_168, {CAL_COLS} "
    "FROM feat_train c LEFT JOIN groups g ON c.group_id = g.group_id "
    f"LEFT JOIN (SELECT * FROM price_feat WHERE timestamp_utc < TIMESTAMP '{tv.INFER_START}') p ON c.timestamp_utc = p.timestamp_utc "
    f"LEFT JOIN (SELECT * FROM cal_trim WHERE timestamp_utc < TIMESTAMP '{tv.INFER_START}') cal ON c.timestamp_utc = cal.timestamp_utc",
    "feat_train", "groups", "price_feat", "cal_trim"))
def q_gold_without_weather(spark, sf):
    cal_train, _ = calendar.split_calendar_hourly(_calendar_hourly(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    price_train, _ = price.split_price(_price_features(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    return gold.build_gold(_split(spark, sf).train, _groups(spark, sf), cal_train, price=price_train, weather_mode="none")


@register("gold_hourly_without_weather_sql", ORACLES["gold_hourly_without_weather"])
def q_gold_without_weather_sql(spark, sf):
    """The without-weather training set through Spark SQL; Spark alone chooses the joins, no job while building."""
    cal_train, _ = calendar.split_calendar_hourly(_calendar_hourly(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    price_train, _ = price.split_price(_price_features(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    return _sql_gold(spark, {"consumption": _split(spark, sf).train, "groups": _groups(spark, sf), "calendar": cal_train,
                             "price": price_train}, weather_mode="none")


@register("gold_monthly", with_views(
    f"SELECT c.timestamp_utc, c.group_id, c.target_consumption, {GROUP_COLS}, {CAL_COLS} FROM cons c "
    "LEFT JOIN groups g ON c.group_id = g.group_id LEFT JOIN cal_hourly cal ON c.timestamp_utc = cal.timestamp_utc",
    "cons", "groups", "cal_hourly"))
def q_gold_monthly(spark, sf):
    return gold.build_gold(tv.consumption_long(spark, sf), _groups(spark, sf), _calendar_hourly(spark, sf),
                           hourly_features=False)


# ---------------------------------------------------------------- tables that forecasts are made and scored on

_IN_WINDOW = f"timestamp_utc >= TIMESTAMP '{tv.INFER_START}' AND timestamp_utc < TIMESTAMP '{tv.INFER_END}'"
_FC_NULL = FC.replace("c.target_consumption", "CAST(NULL AS DOUBLE) AS target_consumption")
_INF_DIMS = (
    "LEFT JOIN groups g ON c.group_id = g.group_id LEFT JOIN bridge b ON c.group_id = b.group_id "
    f"LEFT JOIN (SELECT * FROM price_feat WHERE {_IN_WINDOW}) p ON c.timestamp_utc = p.timestamp_utc "
    f"LEFT JOIN (SELECT * FROM cal_trim WHERE {_IN_WINDOW}) cal ON c.timestamp_utc = cal.timestamp_utc"
)


def _inference_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Calendar and price rows of the inference window."""
    return (calendar.split_calendar_hourly(_calendar_hourly(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)[1],
            price.split_price(_price_features(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)[1])


@register("weather_inference_features", with_views("SELECT * FROM wx_inf_feat", "wx_inf_feat"))
def q_weather_inference_features(spark, sf):
    return weather.weather_features(_weather_inference(spark, sf), tv.WX_MIN, tv.WX_MAX, ts_type=TS)


@register("gold_hourly_inference_with_weather", with_views(
    f"SELECT {_FC_NULL}, {GROUP_COLS}, b.weather_key, p.price_lag_24, p.price_lag_48, p.price_lag_168, "
    f"w.temperature_missing_flag, w.temp_lag_24, w.temp_lag_48, w.temp_lag_168, {CAL_COLS} FROM feat_inf c {_INF_DIMS} "
    "LEFT JOIN wx_inf_feat w ON c.timestamp_utc = w.timestamp_utc AND b.weather_key = w.weather_key",
    "feat_inf", "groups", "bridge", "price_feat", "cal_trim", "wx_inf_feat"))
def q_gold_inference_with_weather(spark, sf):
    """ACTION (the sides are counted)."""
    cal_inf, price_inf = _inference_sides(spark, sf)
    return gold.build_gold(
        _split(spark, sf).inference, _groups(spark, sf), cal_inf, price=price_inf,
        weather=q_weather_inference_features(spark, sf), bridge=tv.bridge(spark, sf), weather_mode="join")


@register("gold_hourly_inference_without_weather", with_views(
    f"SELECT {_FC_NULL}, {GROUP_COLS}, p.price_lag_24, p.price_lag_48, p.price_lag_168, {CAL_COLS} FROM feat_inf c {_INF_DIMS}",
    "feat_inf", "groups", "bridge", "price_feat", "cal_trim"))
def q_gold_inference_without_weather(spark, sf):
    """ACTION (the sides are counted)."""
    cal_inf, price_inf = _inference_sides(spark, sf)
    return gold.build_gold(_split(spark, sf).inference, _groups(spark, sf), cal_inf, price=price_inf, weather_mode="none")


@register("gold_monthly_inference", with_views(
    f"SELECT c.timestamp_utc, c.group_id, CAST(NULL AS DOUBLE) AS target_consumption, {GROUP_COLS}, {CAL_COLS} FROM ("
    "SELECT k.group_id, u.t AS timestamp_utc FROM (SELECT DISTINCT group_id FROM cons) k CROSS JOIN unnest(generate_series("
    f"TIMESTAMP '{tv.INFER_START}', TIMESTAMP '{tv.FUTURE_END}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS u(t)) c "
    "LEFT JOIN groups g ON c.group_id = g.group_id LEFT JOIN cal_hourly cal ON c.timestamp_utc = cal.timestamp_utc",
    "cons", "groups", "cal_hourly"))
def q_gold_monthly_inference(spark, sf):
    """The future grid from the inference start on (two days of it have calendar rows). ACTION (the sides are counted)."""
    grid = features.monthly_train_inference(tv.consumption_long(spark, sf), tv.INFER_START, tv.FUTURE_END, ts_type=TS)[1]
    return gold.build_gold(grid, _groups(spark, sf), _calendar_hourly(spark, sf), hourly_features=False)


@register("hourly_actuals", with_views("SELECT * FROM feat_inf", "feat_inf"))
def q_hourly_actuals(spark, sf):
    return _split(spark, sf).actuals


@register("hourly_baseline", with_views("SELECT * FROM feat_base", "feat_base"))
def q_hourly_baseline(spark, sf):
    return _split(spark, sf).baseline


@register("price_inference", with_views(f"SELECT * FROM price_feat WHERE {_IN_WINDOW}", "price_feat"))
def q_price_inference(spark, sf):
    return _inference_sides(spark, sf)[1]


@register("calendar_inference", with_views(
    'SELECT "desc", working_day, timestamp_utc, hour_of_day, day_of_week, is_weekend, is_holiday, month, day_of_year '
    f"FROM cal_trim WHERE {_IN_WINDOW}", "cal_trim"))
def q_calendar_inference(spark, sf):
    return _inference_sides(spark, sf)[0]


def _sql_gold(spark, frames: dict[str, DataFrame], **kwargs) -> DataFrame:
    """``gold.gold_sql`` over the frames: the statement names them as arguments, no view is left behind."""
    text = gold.gold_sql(**{k: "{%s}" % k for k in frames}, **kwargs)
    return spark.sql(text, **frames)


@register("gold_hourly_with_weather_sql", ORACLES["gold_hourly_with_weather"])
def q_gold_with_weather_sql(spark, sf):
    """The with-weather training set through Spark SQL; Spark alone chooses the joins, no job while building."""
    cal_train, _ = calendar.split_calendar_hourly(_calendar_hourly(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    price_train, _ = price.split_price(_price_features(spark, sf), tv.INFER_START, tv.INFER_END, ts_type=TS)
    return _sql_gold(spark, {"consumption": _split(spark, sf).train, "groups": _groups(spark, sf), "calendar": cal_train,
                             "price": price_train, "weather": _weather_training(spark, sf), "bridge": tv.bridge(spark, sf)},
                     weather_mode="join")


@register("gold_hourly_weather_null_sql", ORACLES["gold_hourly_weather_null"])
def q_gold_weather_null_sql(spark, sf):
    cal_inf, price_inf = _inference_sides(spark, sf)
    return _sql_gold(spark, {"consumption": _split(spark, sf).inference, "groups": _groups(spark, sf), "calendar": cal_inf,
                             "price": price_inf, "bridge": tv.bridge(spark, sf)}, weather_mode="null")


@register("gold_monthly_sql", ORACLES["gold_monthly"])
def q_gold_monthly_sql(spark, sf):
    return _sql_gold(spark, {"consumption": tv.consumption_long(spark, sf), "groups": _groups(spark, sf),
                             "calendar": _calendar_hourly(spark, sf)}, hourly_features=False)


# ---------------------------------------------------------------- evaluation


@register("seasonal_naive_baseline", with_views(
    "SELECT timestamp_utc + INTERVAL 7 DAY AS timestamp_utc, group_id, target_consumption AS baseline_consumption FROM feat_base",
    "feat_base"))
def q_seasonal_naive(spark, sf):
    return evaluate.seasonal_naive(_split(spark, sf).baseline)


def _metrics_sql(models: dict[str, str]) -> str:
    preds = " UNION ALL ".join(
        f"SELECT timestamp_utc, group_id, '{m}' AS model, {c} AS predicted_consumption FROM feat_inf" for m, c in models.items()
    )
    rows = (
        f"SELECT p.model, p.predicted_consumption - a.target_consumption AS pe, b.target_consumption - a.target_consumption AS be, "
        "a.target_consumption AS act FROM (" + preds + ") p "
        "JOIN feat_inf a ON p.timestamp_utc = a.timestamp_utc AND p.group_id = a.group_id "
        "JOIN feat_base b ON b.timestamp_utc + INTERVAL 7 DAY = a.timestamp_utc AND b.group_id = a.group_id"
    )
    agg = (
        "SELECT model, avg(abs(pe)) AS pm, avg(abs(be)) AS bm, "
        "avg(CASE WHEN act <> 0 THEN abs(pe / act) * 100 END) AS pp, avg(CASE WHEN act <> 0 THEN abs(be / act) * 100 END) AS bp "
        f"FROM ({rows}) GROUP BY model"
    )
    return (
        "SELECT model, round(pm, 9) AS prediction_MAE, round(bm, 9) AS baseline_MAE, round(pp, 9) AS prediction_MAPE_percent, "
        "round(bp, 9) AS baseline_MAPE_percent, round(CASE WHEN bp <> 0 THEN 100 * (bp - pp) / bp END, 9) AS FVA_percent "
        f"FROM ({agg})"
    )


@register("evaluate_forecast", with_views(_metrics_sql({"lag_336": "consumption_lag_336"}), "feat_inf", "feat_base"))
def q_evaluate(spark, sf):
    split = _split(spark, sf)
    preds = split.actuals.select("timestamp_utc", "group_id", F.lit("lag_336").alias("model"),
                                 F.col("consumption_lag_336").alias("target_consumption"))
    return _rounded(evaluate.evaluate(preds, split.actuals, split.baseline), METRIC_COLS)


# Three forecasters that SQL can express: model name -> feature column.
MODELS = {"lag_336": "consumption_lag_336", "rolling_mean_168": "rolling_mean_168", "lag_48": "consumption_lag_48"}


@register("model_comparison", with_views(_metrics_sql(MODELS), "feat_inf", "feat_base"))
def q_model_comparison(spark, sf):
    split = _split(spark, sf)
    return _rounded(evaluate.evaluate_columns(split.actuals, MODELS, split.baseline), METRIC_COLS)


# ---------------------------------------------------------------- monthly deliverables


@register("monthly_totals", with_views(
    "SELECT group_id, date_trunc('month', timestamp_utc) AS measured_at, CAST(SUM(target_consumption) AS DOUBLE) AS monthly_consumption, "
    "'actual' AS source FROM orders_long GROUP BY 1, 2", "orders_long"))
def q_monthly_totals(spark, sf):
    return deliver.monthly_totals(tv.orders_long(spark, sf), "actual", ts_type=TS)


def _monthly_pivot_sql(cond: str) -> str:
    return (
        f"SELECT measured_at, {pivot_cols('m')} FROM (SELECT group_id, date_trunc('month', timestamp_utc) AS measured_at, "
        f"CAST(SUM(target_consumption) AS DOUBLE) AS m FROM orders_long WHERE {cond} GROUP BY 1, 2) GROUP BY measured_at"
    )


@register("monthly_combined", with_views(
    _monthly_pivot_sql(f"timestamp_utc < TIMESTAMP '{tv.MONTHLY_CUTOFF}'") + " UNION ALL "
    + _monthly_pivot_sql(f"timestamp_utc >= TIMESTAMP '{tv.MONTHLY_CUTOFF}'"), "orders_long"))
def q_monthly_combined(spark, sf):
    o = tv.orders_long(spark, sf)
    history = splits.before(o, tv.MONTHLY_CUTOFF, ts_type=TS)
    predicted = o.filter(F.col("timestamp_utc") >= F.lit(tv.MONTHLY_CUTOFF).cast(TS))
    return deliver.monthly_deliverables(history, predicted, ts_type=TS)[2]


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


# ---------------------------------------------------------------- payloads and learning


@register("weather_xml_parse", with_views(
    "SELECT timestamp, city, TA_PT1H_AVG, '1.0' AS WS_PT1H_AVG, '0.0' AS PRA_PT1H_ACC FROM wx_inf_raw", "wx_inf_raw"))
def q_weather_xml(spark, sf):
    """Land the inference feed as one WaterML document per (city, day, parameter), parse it back."""
    raw = tv.weather_inference_raw(spark, sf)
    long = raw.select(
        "city", "timestamp", F.substring("timestamp", 1, 10).alias("day"),
        F.explode(F.map_from_arrays(
            F.array(*[F.lit(p) for p in payloads.WEATHER_PARAMETERS]),
            F.array(*[F.col(p) for p in payloads.WEATHER_PARAMETERS]),
        )).alias("param", "value"),
    )
    docs = long.groupBy("city", "day", "param").agg(
        F.sort_array(F.collect_list(F.struct("timestamp", "value"))).alias("pts")
    ).select(
        "city",
        payloads.timeseries_xml(F.concat(F.lit("obs-obs-1-1-"), F.col("param")), F.col("pts.timestamp"), F.col("pts.value")).alias("xml"),
    )
    return payloads.weather_xml_rows(docs)


def _gbt_forecast(spark, sf) -> DataFrame:
    """Boosted trees trained on the hourly training set (without weather), validated from the cutoff, then refitted;
    predicts the 48 h inference window. ACTION: ten rounds, this query's parameter (the library's default is 1000)."""
    from loadcast.plans import ml

    infer = q_gold_inference_without_weather(spark, sf)
    model = ml.train_forecaster(q_gold_without_weather_sql(spark, sf), ml.categorical_columns(False),
                                cutoff=tv.VALID_CUTOFF, max_iter=10)
    return model.predict(infer).select("timestamp_utc", "group_id", "target_consumption")


register("gbt_forecast")(_gbt_forecast)


@register("gbt_forecast_rows", with_views("SELECT timestamp_utc, group_id, TRUE AS finite FROM feat_inf", "feat_inf"))
def q_gbt_forecast_rows(spark, sf):
    """Every hour and group of the forecast, and whether its value is a finite number. ACTION as ``gbt_forecast``."""
    value = F.col("target_consumption")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return _gbt_forecast(spark, sf).select("timestamp_utc", "group_id", finite.alias("finite"))


_CODED = ("group_id", "desc", *groups.GROUP_ATTRIBUTES)


def _codes_sql() -> str:
    """Labels in ascending order numbered from 0; NULL gets the number after the last."""
    labels = ", ".join(
        f'k_{c} AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM '
        f'(SELECT DISTINCT CAST("{c}" AS VARCHAR) AS label FROM train) WHERE label IS NOT NULL)' for c in _CODED)
    codes = ", ".join(f"CAST(coalesce(k_{c}.code, (SELECT count(*) FROM k_{c})) AS INTEGER) AS {c}_code" for c in _CODED)
    joins_ = " ".join(f'LEFT JOIN k_{c} ON CAST(c."{c}" AS VARCHAR) = k_{c}.label' for c in _CODED)
    train = ORACLES["gold_hourly_without_weather"]
    return f"WITH train AS ({train}), {labels} SELECT c.timestamp_utc, c.group_id, {codes} FROM train c {joins_}"


@register("category_codes", _codes_sql())
def q_category_codes(spark, sf):
    """Codes of the categorical features over the hourly training set. ACTION (labels are indexed)."""
    from loadcast.plans import ml

    return ml.category_codes(q_gold_without_weather_sql(spark, sf), _CODED, ["timestamp_utc", "group_id"])


# Features of the boosted trees below; ``lag_48_known`` is missing in every fifth hour, so the missing direction is learned.
_BOOSTED = ("consumption_lag_48", "consumption_lag_336", "rolling_mean_168", "lag_48_known")
_BINS, _UNIT, _STEP, _TREES, _MIN_ROWS = 32, 2.0 ** -20, 0.1, 3, 20


def _boosted_sql() -> str:
    """Best-first trees of three leaves, by definition: every threshold of every feature, missing values on either side."""
    k = len(_BOOSTED)
    unit = f"CAST({_UNIT!r} AS DOUBLE)"
    parts = [
        "raw AS (SELECT *, CASE WHEN hour(timestamp_utc) % 5 <> 0 THEN consumption_lag_48 END AS lag_48_known FROM feat_train)",
        "lims AS (SELECT " + ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(_BOOSTED)) + " FROM raw)",
        "x0 AS (SELECT [" + ", ".join(
            f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 + len(list_filter(range(1, {_BINS}), "
            f"lambda e: lo{i} + (hi{i} - lo{i}) * CAST(e AS DOUBLE) / {_BINS} < {c})) END" for i, c in enumerate(_BOOSTED))
        + "] AS x, target_consumption AS y FROM raw, lims WHERE target_consumption IS NOT NULL)",
        f"g0 AS (SELECT x, y, CAST(sum(CAST(round(y / {unit}) AS BIGINT)) OVER () AS DOUBLE) / count(*) OVER () * {unit} AS f FROM x0)",
    ]

    def best(rows: str, name: str) -> None:
        part = lambda s, n: f"CAST({s} AS DOUBLE) * CAST({s} AS DOUBLE) / CAST({n} AS DOUBLE)"
        parts.append(f"{name}_c AS (SELECT node, feature, x[feature + 1] AS bin, count(*) AS n, sum(g) AS s FROM {rows}, range({k}) r(feature) GROUP BY ALL)")
        parts.append(f"{name}_w AS (SELECT node, feature, bin, sum(n) OVER a AS n, sum(s) OVER a AS s, sum(n) OVER w AS cn, sum(s) OVER w AS cs, "
                     f"coalesce(sum(n) FILTER (bin = 0) OVER a, 0) AS mn, coalesce(sum(s) FILTER (bin = 0) OVER a, 0) AS ms FROM {name}_c "
                     "WINDOW a AS (PARTITION BY node, feature), w AS (PARTITION BY node, feature ORDER BY bin))")
        parts.append(f"{name}_t AS (SELECT node, feature, bin, n, s, false AS missing_left, cn - mn AS nl, cs - ms AS sl FROM {name}_w "
                     f"UNION ALL SELECT node, feature, bin, n, s, true, cn, cs FROM {name}_w)")
        parts.append(f"{name} AS (SELECT *, {part('sl', 'nl')} + {part('(s - sl)', '(n - nl)')} - {part('s', 'n')} AS gain FROM {name}_t "
                     f"WHERE nl >= {_MIN_ROWS} AND n - nl >= {_MIN_ROWS} "
                     "QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin, missing_left) = 1)")

    left = "(x[feature + 1] <= bin AND (missing_left OR x[feature + 1] > 0))"
    out = []
    for t in range(_TREES):
        parts.append(f"r{t} AS (SELECT *, 0 AS node, CAST(round((f - y) / {unit}) AS BIGINT) AS g FROM g{t})")
        best(f"r{t}", f"b{t}")
        parts.append(f"s{t} AS (SELECT r.x, r.y, r.f, r.g, CASE WHEN {left} THEN 1 ELSE 2 END AS node FROM r{t} r, b{t} b)")
        best(f"s{t}", f"d{t}")
        parts.append(f"e{t} AS (SELECT * FROM d{t} WHERE gain > 0 ORDER BY gain DESC, node LIMIT 1)")
        parts.append(f"l{t} AS (SELECT s.x, s.y, s.f, s.g, CASE WHEN s.node <> e.node THEN s.node WHEN {left} THEN 3 ELSE 4 END AS leaf FROM s{t} s, e{t} e)")
        parts.append(f"v{t} AS (SELECT leaf, -CAST(sum(g) AS DOUBLE) / count(*) * {unit} * CAST({_STEP} AS DOUBLE) AS value FROM l{t} GROUP BY leaf)")
        parts.append(f"g{t + 1} AS (SELECT x, y, f + value AS f FROM l{t} JOIN v{t} USING (leaf))")
        out += [f"SELECT {t} AS tree, * FROM b{t}", f"SELECT {t}, * FROM e{t}"]
    names = "[" + ", ".join(f"'{c}'" for c in _BOOSTED) + "]"
    body = (f"SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, {names}[feature + 1] AS feature, CAST(bin AS INTEGER) AS bin, "
            f"missing_left, CAST(n AS BIGINT) AS n FROM ({' UNION ALL '.join(out)})")
    return with_views("SELECT * FROM feat_train", "feat_train").replace("\nSELECT * FROM feat_train", ",\n" + ",\n".join(parts) + "\n" + body)


@register("boosted_splits", _boosted_sql())
def q_boosted_splits(spark, sf):
    """Splits of the first boosted trees, leaf by leaf, over the whole hourly training features. ACTION (the fit)."""
    from loadcast.plans import boosting

    hour = F.hour(F.col("timestamp_utc").cast("timestamp"))
    train = _split(spark, sf).train.withColumn("lag_48_known", F.when(hour % 5 != 0, F.col("consumption_lag_48")))
    edges = boosting.bin_edges(train, _BOOSTED, _BINS, equal_width=True)
    model = boosting.fit(train, _BOOSTED, "target_consumption", rounds=_TREES, max_leaves=3, step=_STEP, column_share=1.0,
                         min_rows=_MIN_ROWS, edges=edges, unit=_UNIT)
    return boosting.splits_table(spark, model)
