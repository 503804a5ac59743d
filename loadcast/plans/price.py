"""Global (un-keyed) price series: parse, positional lags, head drop, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions import decimal_comma_to_double, to_ts
from loadcast.operators import index, splits

# Price lags (rows) and history rows dropped.
PRICE_LAGS = (24, 48, 168)
MIN_HISTORY_ROWS = 336


def clean_price(raw: DataFrame, ts_type: str = "timestamp", on_error: str = "fail") -> DataFrame:
    """``measured_at`` -> ``timestamp_utc``; decimal-comma ``eur_per_mwh`` -> double."""
    return raw.select(
        to_ts("measured_at", ts_type).alias("timestamp_utc"),
        decimal_comma_to_double("eur_per_mwh", on_error).alias("eur_per_mwh"),
    )


def price_lag_features(clean: DataFrame, lags=PRICE_LAGS, block_rows: int = 4096, mode: str = "rows") -> DataFrame:
    """``price_lag_k`` = price k rows earlier over the whole (un-keyed) series (``mode='rows'``,
    distributed positional index, no single-partition window) or the price k hours earlier
    (``mode='time'``, shifted equi-joins); the current price is dropped."""
    names = [f"price_lag_{k}" for k in lags]
    if mode == "time":
        from loadcast.operators.windows import temporal_lags

        return temporal_lags(clean, "eur_per_mwh", lags, names=names).drop("eur_per_mwh")
    out = index.positional_lags(clean, "eur_per_mwh", lags, "timestamp_utc", (), names, block_rows=block_rows)
    return out.drop("eur_per_mwh")


def drop_initial_rows(df: DataFrame, n: int = MIN_HISTORY_ROWS, ts: str = "timestamp_utc") -> DataFrame:
    """Remove the first ``n`` rows of the whole series (distributed)."""
    return index.drop_head_positional(df, n, ts)


def price_features(raw: DataFrame, ts_type: str = "timestamp", min_history_rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Parse, lag and trim in one plan (the lags and the index share the series' day buckets)."""
    names = [f"price_lag_{k}" for k in PRICE_LAGS]
    clean = clean_price(raw, ts_type)
    indexed = index.row_index(clean, "timestamp_utc")

    from loadcast.operators.windows import lag_columns

    def apply(d, ks, o):
        return d.withColumns(lag_columns("eur_per_mwh", PRICE_LAGS, o, ks, names=names))

    out = index.blocked(indexed, [], max(PRICE_LAGS), 4096, apply)
    return out.filter(F.col(index.IDX) > min_history_rows).drop(index.IDX, "eur_per_mwh")


def split_price(df: DataFrame, start, end, ts_type: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    return splits.before(df, start, ts_type=ts_type), splits.split_window(df, start, end, ts_type=ts_type)
