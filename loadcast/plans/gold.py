"""Gold datasets: the consumption grain left-joined with group metadata, the group->weather
bridge, price lags, weather features and calendar features.

The fact side keeps its grain (one row per group and hour). Every other input is a
dimension or a global series whose size is bounded by (groups) or (hours in the span);
each is broadcast when the size estimate of its plan is at most ``max_dim_bytes`` (tables: no job runs for it) or, for a side
still to be computed, when its counted rows are few (it is persisted and runs once), so the fact rows are not shuffled for those joins. Weather is keyed by (hour, weather_key):
broadcast when under the bound, otherwise one shuffle on that composite key, past which the rows without a weather key go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.operators.joins import MAX_BYTES, bounded_all, left_join_sparse
from loadcast.plans.features import FEATURE_COLUMNS
from loadcast.plans.groups import GROUP_ATTRIBUTES
from loadcast.sources.writers import publish

PRICE_COLUMNS = ("price_lag_24", "price_lag_48", "price_lag_168")
WEATHER_COLUMNS = ("temperature_missing_flag", "temp_lag_24", "temp_lag_48", "temp_lag_168")
CALENDAR_COLUMNS = ("working_day", "desc", "is_weekend", "is_holiday", "hour_of_day", "day_of_week", "month", "day_of_year")


def build_gold(
    consumption: DataFrame,
    groups: DataFrame,
    calendar: DataFrame,
    price: DataFrame | None = None,
    weather: DataFrame | None = None,
    bridge: DataFrame | None = None,
    weather_mode: str = "none",
    hourly_features: bool = True,
    max_dim_bytes: int = MAX_BYTES,
    weather_salts: int = 1,
) -> DataFrame:
    """``weather_mode``: ``'join'`` (with weather), ``'null'`` (bridge joined, weather columns
    NULL - the 'weather unknown at inference' variant), ``'none'`` (no weather columns).
    ``hourly_features=False`` gives the monthly layout (target only, no price). ``weather_salts``: tasks per weather key and hour where
    the weather is too large to broadcast. Building starts no job when
    the sides are tables."""
    ts, gid = "timestamp_utc", "group_id"
    fact_cols = [ts, gid, "target_consumption", *(FEATURE_COLUMNS if hourly_features else ())]
    out = consumption.select(*fact_cols)

    sides = {"groups": groups.select(gid, *GROUP_ATTRIBUTES), "calendar": calendar.select(ts, *CALENDAR_COLUMNS)}
    if weather_mode in ("join", "null"):
        sides["bridge"] = bridge.select(gid, "weather_key")
    if price is not None:
        sides["price"] = price.select(ts, *PRICE_COLUMNS)
    if weather_mode == "join":
        sides["weather"] = weather.select(ts, "weather_key", *WEATHER_COLUMNS)
    small = bounded_all(sides, max_dim_bytes)

    out = out.join(small["groups"], gid, "left")
    if "bridge" in small:
        out = out.join(small["bridge"], gid, "left")
    if "price" in small:
        out = out.join(small["price"], ts, "left")
    if weather_mode == "join":
        out = left_join_sparse(out, small["weather"], [ts, "weather_key"], weather_salts, max_dim_bytes)
    elif weather_mode == "null":
        out = out.withColumns({
            "temperature_missing_flag": F.lit(None).cast("int"),
            **{c: F.lit(None).cast("double") for c in WEATHER_COLUMNS[1:]},
        })
    out = out.join(small["calendar"], ts, "left")

    cols = [*fact_cols, *GROUP_ATTRIBUTES]
    if weather_mode in ("join", "null"):
        cols.append("weather_key")
    if price is not None:
        cols.extend(PRICE_COLUMNS)
    if weather_mode in ("join", "null"):
        cols.extend(WEATHER_COLUMNS)
    cols.extend(CALENDAR_COLUMNS)
    return out.select(*cols)


def gold_sql(
    consumption: str, groups: str, calendar: str, price: str | None = None, weather: str | None = None,
    bridge: str | None = None, weather_mode: str = "none", hourly_features: bool = True,
) -> str:
    """The same dataset as ``build_gold`` as one Spark SQL statement over named tables or views
    (for SQL-first users and ``CREATE TABLE ... AS``). Catalyst plans it like the DataFrame form.
    Create the dimension views from ``joins.bounded_all(...)`` outputs: the broadcast hint of a
    proven-small side is part of the view's plan, so the SQL joins broadcast exactly like
    ``build_gold``; otherwise the size estimates and AQE decide."""
    fact = ["timestamp_utc", "group_id", "target_consumption", *(FEATURE_COLUMNS if hourly_features else ())]
    sel = [f"c.{c}" for c in fact] + [f"g.{c}" for c in GROUP_ATTRIBUTES]
    joins = [f"LEFT JOIN {groups} g ON c.group_id = g.group_id"]
    if weather_mode in ("join", "null"):
        sel.append("b.weather_key")
        joins.append(f"LEFT JOIN {bridge} b ON c.group_id = b.group_id")
    if price is not None:
        sel += [f"p.{c}" for c in PRICE_COLUMNS]
        joins.append(f"LEFT JOIN {price} p ON c.timestamp_utc = p.timestamp_utc")
    if weather_mode == "join":
        sel += [f"w.{c}" for c in WEATHER_COLUMNS]
        joins.append(f"LEFT JOIN {weather} w ON c.timestamp_utc = w.timestamp_utc AND b.weather_key = w.weather_key")
    elif weather_mode == "null":
        sel += ["CAST(NULL AS INT) AS temperature_missing_flag"] + [f"CAST(NULL AS DOUBLE) AS {c}" for c in WEATHER_COLUMNS[1:]]
    sel += [f"cal.`{c}`" for c in CALENDAR_COLUMNS]
    joins.append(f"LEFT JOIN {calendar} cal ON c.timestamp_utc = cal.timestamp_utc")
    return "SELECT " + ", ".join(sel) + f" FROM {consumption} c " + " ".join(joins)


def create_gold_table(spark, target: str, select_sql: str, fmt: str = "parquet") -> None:
    """``CREATE OR REPLACE`` of a table as a select, in one catalog step: see ``writers.publish``."""
    publish(spark.sql(select_sql), target, fmt)
