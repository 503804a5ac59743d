"""Deliverables: monthly totals, wide pivots, actual+predicted union, decimal-comma text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from loadcast.functions import double_to_decimal_comma, trunc_ts
from loadcast.operators.reshape import sorted_distinct_ids, to_wide


def monthly_totals(df: DataFrame, source_label: str, ts_type: str = "timestamp",
                   value: str = "target_consumption") -> DataFrame:
    """``(group_id, measured_at = month start, monthly_consumption, source)``: partial sums
    map-side, one shuffle on (group, month). Decimal inputs are summed exactly, output double."""
    month = trunc_ts("month", "timestamp_utc", ts_type)
    return (
        df.groupBy("group_id", month.alias("measured_at"))
        .agg(F.sum(value).cast("double").alias("monthly_consumption"))
        .withColumn("source", F.lit(source_label))
    )


def hourly_deliverable(predictions: DataFrame, ids: Sequence | None = None) -> DataFrame:
    """One row per hour (``measured_at``), one column per group (ordered ids)."""
    ids = list(ids) if ids is not None else sorted_distinct_ids(predictions)
    wide = to_wide(predictions, "timestamp_utc", "group_id", "target_consumption", ids)
    return wide.withColumnRenamed("timestamp_utc", "measured_at").orderBy("measured_at")


def monthly_deliverables(history: DataFrame, predictions: DataFrame, ids: Sequence | None = None,
                         ts_type: str = "timestamp") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(actuals wide, predictions wide, combined = actuals UNION ALL predictions). Column ids
    come from the predictions, so groups without predictions are left out of the actuals too."""
    ids = list(ids) if ids is not None else sorted_distinct_ids(predictions)
    actual = to_wide(monthly_totals(history, "actual", ts_type), "measured_at", "group_id", "monthly_consumption", ids)
    pred = to_wide(monthly_totals(predictions, "predicted", ts_type), "measured_at", "group_id", "monthly_consumption", ids)
    return actual, pred, actual.unionByName(pred)


def decimal_comma_projection(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Every float/double/decimal column as text with a decimal comma; other columns unchanged.
    (Decimal columns are included on purpose: ``decimal(p,s)`` is a fractional type too.)"""
    fractional = (DoubleType, FloatType, DecimalType)
    return df.select(*[
        double_to_decimal_comma(F.col(f"`{f.name}`"), scale).alias(f.name)
        if isinstance(f.dataType, fractional) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
