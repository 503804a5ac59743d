"""Half-open time splits and NULL-ing of targets / exogenous columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lit_ts(value, ts_type: str):
    return F.lit(value).cast(ts_type)


def before(df: DataFrame, cutoff, ts: str = "timestamp_utc", ts_type: str = "timestamp") -> DataFrame:
    """Rows with ``ts < cutoff`` (pushed to the scan when applied directly over a table)."""
    return df.filter(F.col(ts) < _lit_ts(cutoff, ts_type))


def split_window(df: DataFrame, start, end, ts: str = "timestamp_utc", ts_type: str = "timestamp") -> DataFrame:
    """Rows with ``start <= ts < end``."""
    return df.filter((F.col(ts) >= _lit_ts(start, ts_type)) & (F.col(ts) < _lit_ts(end, ts_type)))


def null_columns(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """Replace columns by typed NULLs, keeping their position and (given) type."""
    return df.withColumns({c: F.lit(None).cast(dtype) for c in cols})


def null_exogenous(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Blank exogenous features (``{column: type}``): the 'weather unknown at inference' variant."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in cols.items()})
