"""Daily calendar -> hourly calendar features, and its splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions import calendar_parts
from loadcast.operators import index, splits

MIN_HISTORY_ROWS = 336


def expand_calendar_hourly(raw: DataFrame, date_col: str = "timestamp", ts_type: str = "timestamp") -> DataFrame:
    """One row per hour of every calendar day (the day is read as UTC midnight), with
    hour_of_day, ISO day_of_week, is_weekend, is_holiday, month, day_of_year. Other raw
    columns (desc, working_day, ...) pass through."""
    day = F.col(date_col).cast("date").cast("timestamp").cast(ts_type)
    hours = F.sequence(day, day + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))
    others = [c for c in raw.columns if c != date_col]
    hourly = raw.select(*others, F.explode(hours).alias("timestamp_utc"))
    return hourly.withColumns(calendar_parts("timestamp_utc", "desc"))


def split_calendar_hourly(hourly: DataFrame, start, end, min_history_rows: int = MIN_HISTORY_ROWS,
                          ts_type: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Drop the first ``min_history_rows`` hours (distributed index, no single partition), then
    train ``< start`` and inference ``[start, end)``."""
    trimmed = index.drop_head_positional(hourly, min_history_rows, "timestamp_utc")
    return splits.before(trimmed, start, ts_type=ts_type), splits.split_window(trimmed, start, end, ts_type=ts_type)
