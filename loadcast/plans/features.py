"""Consumption features (lags, trailing moments), head trimming and the hourly/monthly splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.operators import index, spine, splits, windows

# Target lags (hours), trailing window, history rows dropped per group.
TARGET_LAGS = (48, 168, 336)
ROLLING_WINDOW = 168
MIN_HISTORY_ROWS = 336
# Rows per block of the default (skew-safe) plan: bounds the rows one window task buffers.
DEFAULT_BLOCK_ROWS = 1 << 16

FEATURE_COLUMNS = (
    "consumption_lag_48", "consumption_lag_168", "consumption_lag_336",
    "rolling_mean_168", "rolling_std_168", "lag_diff_48_168", "lag_diff_168_336",
)


def hourly_features(
    long: DataFrame, keys=("group_id",), ts: str = "timestamp_utc", value: str = "target_consumption",
    lags=TARGET_LAGS, window: int = ROLLING_WINDOW, gap: int = 1, min_history_rows: int = MIN_HISTORY_ROWS,
    scale: int | None = None, exact: bool | None = None, block_rows: int | None = DEFAULT_BLOCK_ROWS,
    densify: tuple | None = None, ts_type: str = "timestamp", since=None, step_hours: int = 1,
    gap_free: bool = False, wide: bool | None = None, day_counts: DataFrame | None = None, day_column: str | None = None,
) -> DataFrame:
    """Positional lags (default 48/168/336), trailing mean/std over the 168 rows before each row
    (``gap=1``; ``gap=48`` gives a leak-free variant for a 48 h horizon), lag differences,
    then the first ``min_history_rows`` rows of each group removed. ``scale``, ``exact`` and ``wide`` choose how the
    statistics are summed (see ``windows.rolling_moments``).

    Default plan (``block_rows`` set): exact positions per group from a (group, day) row
    number plus per-day offsets, then windows per (group, block of ``block_rows`` positions)
    with 336 rows of history copied in - a hot group is split into bounded tasks and the
    parallelism does not depend on the number of groups. Two shuffles of the rows.
    ``block_rows=None``: one exchange by group, one sort, one Window node - the cheaper plan
    when groups are many and each is small (e.g. one row per group and hour).
    ``densify=(start, end)``: fill the hourly grid first, so lags are temporal on gapped data.
    ``since``: only rows from ``since`` on are wanted. Lags and the head drop count rows, so on series
    with gaps no number of hours bounds what they need: the whole history is computed and filtered.
    ``day_counts`` (``index.day_counts`` of the same series, a stored table) bounds it exactly, gaps or not: per group, the day that
    holds the last row the windows of ``since`` look back to, and the number of rows before that day. ACTION: the earliest of
    these days is read, so the filter reaches the scan as a literal (on ``day_column``, too, where the table is partitioned by one).
    ``gap_free=True`` (the caller's statement: one row per group and step) lets the input be filtered to
    ``ts >= since - (longest lookback + head rows) * step`` before any shuffle (pushed to the scan when
    ``ts`` is a stored column); with ``densify`` the keys still come from the whole input, so it is not used."""
    keys = list(keys)
    if since is not None and day_counts is not None and densify is None and block_rows is not None:
        lo = F.lit(since).cast(ts_type)
        pruned = index.prune_history(long, day_counts, ts, keys, lo, max(max(lags), window + gap), day_column)
        out = hourly_features(pruned, keys, ts, value, lags, window, gap, min_history_rows, scale, exact, block_rows,
                              ts_type=ts_type, wide=wide)
        return out.filter(F.col(ts) >= lo)
    if since is not None:
        lo = F.lit(since).cast(ts_type)
        if gap_free and densify is None:
            pad = (max(max(lags), window + gap) + min_history_rows) * step_hours
            long = long.filter(F.col(ts) >= lo - F.expr(f"INTERVAL {pad} HOURS"))
        out = hourly_features(long, keys, ts, value, lags, window, gap, min_history_rows, scale, exact, block_rows,
                              densify, ts_type, wide=wide)
        return out.filter(F.col(ts) >= lo)
    if densify is not None:  # temporal lags: every group gets every hour of the span (missing hours -> NULL rows)
        long = spine.densify(long, keys, densify[0], densify[1], ts, ts_type=ts_type)
    form, scale, wide = windows.moment_form(long, value, scale, exact, wide)
    lag_names = [f"consumption_lag_{k}" for k in lags]
    # differences of consecutive lags (defaults: lag_diff_48_168, lag_diff_168_336)
    diffs = {f"lag_diff_{a}_{b}": F.col(f"consumption_lag_{a}") - F.col(f"consumption_lag_{b}")
             for a, b in zip(lags, lags[1:])}

    def window_columns(ks: list[str], order: str, with_position: bool) -> dict:
        cols = windows.lag_columns(value, lags, order, ks, names=lag_names)
        if form == "prefix":
            cols.update(windows.moment_prefix_columns(value, window, gap, order, ks, scale, wide, "t"))
        if with_position:
            cols["_pos"] = F.row_number().over(windows.spec(ks, order))
        return cols

    def finish(staged: DataFrame, ks: list[str], order: str) -> DataFrame:
        if form == "prefix":
            staged = staged.withColumns(
                windows.moments_from_prefix("t", scale, f"rolling_mean_{window}", f"rolling_std_{window}")
            ).drop("_s_t", "_q_t", "_n_t", "_b_t")
        else:
            staged = windows.rolling_moments(staged, value, window, gap, order, ks, exact=False if form == "sliding" else None,
                                             position=order if order == index.IDX else None)
        return staged.withColumns(diffs)

    def apply(df: DataFrame, ks: list[str], order: str) -> DataFrame:
        return finish(df.withColumns(window_columns(ks, order, False)), ks, order)

    if block_rows is None:
        # every window expression in one projection -> one Window node over one sort
        staged = finish(long.withColumns(window_columns(keys, ts, True)), keys, ts)
        return staged.filter(F.col("_pos") > min_history_rows).drop("_pos")
    indexed = index.row_index(long, ts, keys)
    if index.SKIPPED in long.columns:  # positions in the whole series
        indexed = indexed.withColumn(index.IDX, F.col(index.IDX) + F.col(index.SKIPPED)).drop(index.SKIPPED)
    out = index.blocked(indexed, keys, max(max(lags), window + gap), block_rows, apply)
    return out.filter(F.col(index.IDX) > min_history_rows).drop(index.IDX)


@dataclass
class HourlySplit:
    train: DataFrame
    inference: DataFrame
    actuals: DataFrame
    baseline: DataFrame


def split_hourly(
    features: DataFrame, inference_start, inference_end, baseline_start, baseline_end,
    ts: str = "timestamp_utc", ts_type: str = "timestamp", value: str = "target_consumption",
) -> HourlySplit:
    """Train ``< inference_start``; inference ``[start, end)`` with the target NULLed; actuals the
    same window with the target; baseline ``[baseline_start, baseline_end)``.
    Features are computed before the target is NULLed, so rolling stats inside the inference
    window include earlier hours of that window (reference behaviour; use ``gap`` to avoid)."""
    window = splits.split_window(features, inference_start, inference_end, ts, ts_type)
    return HourlySplit(
        train=splits.before(features, inference_start, ts, ts_type),
        inference=splits.null_columns(window, [value]),
        actuals=window,
        baseline=splits.split_window(features, baseline_start, baseline_end, ts, ts_type),
    )


def monthly_train_inference(
    long: DataFrame, future_start, future_end, keys=("group_id",), ts: str = "timestamp_utc",
    value: str = "target_consumption", ts_type: str = "timestamp",
) -> tuple[DataFrame, DataFrame]:
    """History unchanged, plus an hourly future grid ``[future_start, future_end)`` for every
    group with a NULL target."""
    grid = spine.future_grid(long, list(keys), future_start, future_end, ts, value, ts_type=ts_type)
    return long, grid.select(*keys, ts, value)
