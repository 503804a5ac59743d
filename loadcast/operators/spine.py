"""Hourly time spines, key x time grids, densification and future grids.

Grids are generated per key with ``explode(sequence(...))`` (a generator fused into the scan
of the key table), never with a cartesian join. The key table is tiny (distinct keys), and
each key's row expands into its own hours in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _ts(value, ts_type: str) -> Column:
    return value.cast(ts_type) if isinstance(value, Column) else F.lit(value).cast(ts_type)


def hour_sequence(start, end, step: str = "1 hour", end_exclusive: bool = False, ts_type: str = "timestamp") -> Column:
    """``sequence(start, end, step)``; ``end_exclusive`` stops one step before ``end``."""
    lo, hi = _ts(start, ts_type), _ts(end, ts_type)
    if end_exclusive:
        hi = hi - F.expr(f"INTERVAL {step}")
    return F.sequence(lo, hi, F.expr(f"INTERVAL {step}"))


def time_spine(
    spark: SparkSession, start, end, step: str = "1 hour", end_exclusive: bool = False,
    name: str = "timestamp_utc", ts_type: str = "timestamp",
) -> DataFrame:
    """Single-column spine between two literal bounds (inclusive unless ``end_exclusive``)."""
    return spark.range(1).select(F.explode(hour_sequence(start, end, step, end_exclusive, ts_type)).alias(name))


def spine_between(
    bounds: DataFrame, start_col: str, end_col: str, step: str = "1 hour",
    name: str = "timestamp_utc", ts_type: str = "timestamp",
) -> DataFrame:
    """Spine from bounds held in a one-row DataFrame (e.g. the min/max of the data)."""
    return bounds.select(F.explode(hour_sequence(F.col(start_col), F.col(end_col), step, False, ts_type)).alias(name))


def key_time_grid(
    keys: DataFrame, start, end, step: str = "1 hour", end_exclusive: bool = False,
    name: str = "timestamp_utc", ts_type: str = "timestamp",
) -> DataFrame:
    """Every key of ``keys`` (distinct rows) x every hour in the bounds, generated per key."""
    key_cols = keys.columns
    return keys.select(*key_cols, F.explode(hour_sequence(start, end, step, end_exclusive, ts_type)).alias(name))


def densify(
    df: DataFrame, keys: Sequence[str], start, end, ts: str = "timestamp_utc",
    step: str = "1 hour", ts_type: str = "timestamp",
) -> DataFrame:
    """Left-join the observations onto the full key x hour grid: missing hours become rows with
    NULL values. Duplicate observations of a cell are kept (one grid row per observation)."""
    grid = key_time_grid(df.select(*keys).distinct(), start, end, step, name=ts, ts_type=ts_type)
    return grid.join(df, on=[*keys, ts], how="left")


def future_grid(
    df: DataFrame, keys: Sequence[str], start, end, ts: str = "timestamp_utc",
    value: str = "target_consumption", step: str = "1 hour", ts_type: str = "timestamp",
) -> DataFrame:
    """Distinct keys of ``df`` x hours in ``[start, end)`` with a NULL ``value`` column."""
    grid = key_time_grid(df.select(*keys).distinct(), start, end, step, end_exclusive=True, name=ts, ts_type=ts_type)
    return grid.withColumn(value, F.lit(None).cast("double"))
