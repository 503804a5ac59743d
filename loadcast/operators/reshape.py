"""Wide <-> long reshapes (unpivot, pivot) and the ordered id list a pivot needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions.parse import to_ts


def to_long(
    df: DataFrame,
    id_col: str = "measured_at",
    key_name: str = "group_id",
    value_name: str = "target_consumption",
    key_type: str = "int",
    value_type: str = "double",
    ts_name: str = "timestamp_utc",
    ts_type: str = "timestamp",
    value_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Unpivot one-column-per-key data into ``(ts, key, value)``. NULL cells stay as rows.

    Value columns default to every column except ``id_col`` (discovered from the schema,
    no action). Runs as an Expand node fused into the scan stage: no shuffle."""
    cols = list(value_cols) if value_cols is not None else [c for c in df.columns if c != id_col]
    typed = df.select(
        to_ts(F.col(id_col), ts_type).alias(ts_name),
        *[F.col(f"`{c}`").cast(value_type).alias(c) for c in cols],
    )
    long = typed.unpivot([ts_name], cols, key_name, value_name)
    return long.select(ts_name, F.col(key_name).cast(key_type).alias(key_name), value_name)


def sorted_distinct_ids(df: DataFrame, key: str = "group_id", max_ids: int | None = None) -> list:
    """ACTION: ascending distinct keys, collected - they become the columns of a pivot, so their number is the
    caller's. With ``max_ids`` the distinct count is checked first (an aggregate, nothing funnelled) and more
    keys raise instead of reaching the driver; pass the ids to the pivot where they are known."""
    distinct = df.select(key).distinct()
    if max_ids is not None and distinct.count() > max_ids:
        raise ValueError(f"more than {max_ids} distinct {key} values: too many pivot columns")
    return [r[0] for r in distinct.orderBy(key).collect()]


def to_wide(
    df: DataFrame,
    row: str,
    col: str,
    value: str,
    ids: Sequence | None = None,
    agg: str = "max",
) -> DataFrame:
    """Pivot ``(row, col, value)`` to one row per ``row`` and one column per ``col`` id.

    Pass ``ids`` (the ordered column list) so the pivot runs no extra distinct job; a missing
    cell is NULL. ``agg='max'`` is deterministic; ``'first'`` is equal when each cell holds
    at most one row. Partial aggregation runs map-side, so the shuffle carries at most one
    row per (task, row) pair."""
    fn = {"max": F.max, "first": F.first, "sum": F.sum, "min": F.min}[agg]
    grouped = df.groupBy(row)
    pivoted = grouped.pivot(col, list(ids)) if ids is not None else grouped.pivot(col)
    return pivoted.agg(fn(value))
