"""Column-level helpers. All return ``Column`` expressions built from ``pyspark.sql.functions``."""

from loadcast.functions.calendar import calendar_parts, iso_day_of_week
from loadcast.functions.parse import (
    assemble_timestamp,
    decimal_comma_to_double,
    double_to_decimal_comma,
    key_from_prefix,
    label_parts,
    normalize_name,
    to_ts,
    tolerant_double,
    trunc_ts,
)

__all__ = [
    "assemble_timestamp",
    "calendar_parts",
    "decimal_comma_to_double",
    "double_to_decimal_comma",
    "iso_day_of_week",
    "key_from_prefix",
    "label_parts",
    "normalize_name",
    "to_ts",
    "tolerant_double",
    "trunc_ts",
]
