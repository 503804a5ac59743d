"""Group metadata: split the pipe-delimited label into six trimmed attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loadcast.functions import label_parts

# The six attributes of a group label, in label order.
GROUP_ATTRIBUTES = ("macro_region", "region", "municipality", "segment", "product_type", "consumption_bucket")


def parse_groups(raw: DataFrame, label: str = "group_label") -> DataFrame:
    """``group_id`` (and any other column) + the six attributes; a short label leaves NULLs."""
    keep = [c for c in raw.columns if c != label]
    return raw.select(*keep, *label_parts(label, GROUP_ATTRIBUTES))
