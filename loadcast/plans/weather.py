"""Weather: landing tables -> long table, inference/training preparation, complete hourly features."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions import assemble_timestamp, key_from_prefix, normalize_name, tolerant_double, to_ts
from loadcast.operators import index, spine, windows

# The weather keys (3-letter station/city prefixes), in their documented order.
WEATHER_KEYS = ("HEL", "TUR", "TAM", "JOE", "JYV", "KUO", "LAH", "LAP", "OUL", "ROV", "VAA", "HAM", "ESP", "SEI", "VAN", "POR")
# Temperature lags (hours), history rows dropped, training tail dropped.
TEMP_LAGS = (24, 48, 168)
MIN_HISTORY_ROWS = 336
FORECAST_HORIZON = 48

# Landing-table column names.
STATION = "Havaintoasema"
YEAR, MONTH, DAY = "Vuosi", "Kuukausi", "Päivä"
TIME_UTC = "Aika [UTC]"
TEMPERATURE = "Lämpötilan keskiarvo [°C]"
PRECIPITATION = "Tunnin sademäärä [mm]"
WIND = "Keskituulen nopeus [m/s]"


def build_weather_long(landing: DataFrame, name_col: str, prefixes: Sequence[str] = WEATHER_KEYS) -> DataFrame:
    """All landing tables as one long table: ``weather_key`` from the case-insensitive prefix of
    the source name (table or file name column), tolerant temperature, ``hour`` as text.
    Sources matching no prefix are dropped (they would not have been loaded)."""
    key = key_from_prefix(F.col(name_col), prefixes)
    return (
        landing.select(
            STATION, YEAR, MONTH, DAY,
            F.col(f"`{TIME_UTC}`").cast("string").alias("hour"),
            tolerant_double(F.col(f"`{TEMPERATURE}`")).alias("temperature"),
            key.alias("weather_key"),
        )
        .filter(F.col("weather_key").isNotNull())
    )


def check_prefix_coverage(long: DataFrame, prefixes: Sequence[str] = WEATHER_KEYS) -> list[str]:
    """ACTION (bounded by the number of prefixes): prefixes without any source. Raises when none matched."""
    known = F.col("weather_key").isin(list(prefixes))
    found = {r[0] for r in long.filter(known).select("weather_key").distinct().collect()}
    if not found:
        raise ValueError(f"no weather source for any of {', '.join(prefixes)}")
    missing = [p for p in prefixes if p not in found]
    for p in missing:
        warnings.warn(f"no weather source for prefix {p}", stacklevel=2)
    return missing


def prepare_weather_inference(raw: DataFrame, ts_type: str = "timestamp", prefixes: Sequence[str] = WEATHER_KEYS,
                              drop_latest: int = 1, split: bool = False) -> DataFrame:
    """Key by normalised city prefix (NULL for unknown cities), tolerant temperature, parsed
    timestamp; drop the latest ``drop_latest`` rows of every key. ``split``: as in ``drop_latest_horizon``."""
    prepared = raw.select(
        to_ts("timestamp", ts_type).alias("timestamp_utc"),
        tolerant_double("TA_PT1H_AVG").alias("temperature"),
        key_from_prefix(normalize_name("city"), prefixes).alias("weather_key"),
    )
    return drop_latest_horizon(prepared, drop_latest, split)


def prepare_weather_training(long: DataFrame, ts_type: str = "timestamp") -> DataFrame:
    """Timestamp assembled from the date parts and ``H:mm`` text; parts and station dropped."""
    ts = assemble_timestamp(F.col(YEAR), F.col(MONTH), F.col(DAY), F.col("hour"), ts_type)
    return long.select(ts.alias("timestamp_utc"), "temperature", "weather_key")


def weather_features(
    obs: DataFrame, min_ts, max_ts, min_history_rows: int = MIN_HISTORY_ROWS, ts_type: str = "timestamp",
    block_rows: int | None = None,
) -> DataFrame:
    """Complete hourly weather features per key over ``[min_ts, max_ts]`` (inclusive):
    key x hour grid left-joined with observations, ``temperature_missing_flag``, forward
    fill, lags 24/48/168 of the filled series, raw columns dropped, first rows per key removed.

    Default: per-key windows (a weather key holds one row per hour of the span).
    ``block_rows``: the split plan - forward fill per (key, day) with carried-in values, lags
    per (key, block) with 168 rows of history, head drop by exact position."""
    lag_names = [f"temp_lag_{k}" for k in TEMP_LAGS]
    dense = spine.densify(obs, ["weather_key"], min_ts, max_ts, ts_type=ts_type)
    flagged = dense.withColumn("temperature_missing_flag", F.when(F.col("temperature").isNull(), 1).otherwise(0))
    if block_rows is None:
        filled = windows.forward_fill(flagged, "temperature", keys=["weather_key"], out="temperature_filled")
        # lags and the head-drop position share one Window node (the fill must come first)
        lagged = filled.withColumns({
            **windows.lag_columns("temperature_filled", TEMP_LAGS, "timestamp_utc", ["weather_key"], names=lag_names),
            "_pos": F.row_number().over(windows.spec(["weather_key"], "timestamp_utc")),
        })
        trimmed = lagged.filter(F.col("_pos") > min_history_rows)
    else:
        filled = index.forward_fill_split(flagged, "temperature", "timestamp_utc", ["weather_key"], out="temperature_filled")
        indexed = index.row_index(filled, "timestamp_utc", ["weather_key"])

        def apply(d: DataFrame, ks: list[str], o: str) -> DataFrame:
            return d.withColumns(windows.lag_columns("temperature_filled", TEMP_LAGS, o, ks, names=lag_names))

        lagged = index.blocked(indexed, ["weather_key"], max(TEMP_LAGS), block_rows, apply)
        trimmed = lagged.filter(F.col(index.IDX) > min_history_rows)
    return trimmed.select("weather_key", "timestamp_utc", "temperature_missing_flag", *lag_names)


def drop_latest_horizon(df: DataFrame, horizon: int = FORECAST_HORIZON, split: bool = False) -> DataFrame:
    """Remove the latest ``horizon`` rows of every key. One task per key, right for many short keys;
    ``split`` counts positions per (key, day) instead, so that no key (the NULL key of unknown cities
    included) is one task."""
    drop = index.drop_tail_positional if split else windows.drop_tail
    return drop(df, horizon, "timestamp_utc", ["weather_key"])
