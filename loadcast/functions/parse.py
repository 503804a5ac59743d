"""Parsing and normalisation expressions (strings, numbers, timestamps)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters folded by the name normaliser, and their ASCII replacements.
ACCENTED = "äöå"
ASCII_FOR_ACCENTED = "aoa"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c: str | Column, ts_type: str = "timestamp") -> Column:
    """Strict cast of a string/timestamp column to ``timestamp`` (session TZ) or ``timestamp_ntz``.
    NTZ goes through ``timestamp`` so an explicit offset in the text (``Z``, ``+02:00``) is applied
    (the session zone is pinned to UTC, so zone-less text keeps its wall clock)."""
    ts = _col(c).cast("timestamp")
    return ts.cast("timestamp_ntz") if ts_type == "timestamp_ntz" else ts.cast(ts_type)


def trunc_ts(unit: str, c: str | Column, ts_type: str = "timestamp") -> Column:
    """``date_trunc`` that keeps the requested timestamp flavour (``date_trunc`` always returns LTZ)."""
    return F.date_trunc(unit, _col(c)).cast(ts_type)


def decimal_comma_to_double(c: str | Column, on_error: str = "fail") -> Column:
    """``"12,5"`` -> 12.5. Every comma becomes a dot. ``on_error='null'`` turns junk into NULL instead of failing."""
    dotted = F.regexp_replace(_col(c).cast("string"), ",", ".")
    return dotted.try_cast("double") if on_error == "null" else dotted.cast("double")


def double_to_decimal_comma(c: str | Column, scale: int | None = None) -> Column:
    """Number -> text with a decimal comma. ``scale=None`` keeps Spark's own double rendering
    (which may be scientific, e.g. ``1,0E-5``); ``scale=k`` renders fixed ``k`` decimals."""
    text = _col(c).cast("string") if scale is None else F.format_number(_col(c), scale)
    if scale is not None:
        text = F.regexp_replace(text, ",", "")  # drop format_number's thousands separators
    return F.regexp_replace(text, r"\.", ",")


def tolerant_double(c: str | Column, nan_as_null: bool = False) -> Column:
    """``try_cast(x as double)``: junk such as ``'-'`` becomes NULL; ``'NaN'`` stays NaN unless ``nan_as_null``."""
    v = _col(c).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v) if nan_as_null else v


def normalize_name(c: str | Column) -> Column:
    """Trim, lower-case, fold accented letters to ASCII (covers upper-case accents through ``lower``)."""
    return F.translate(F.lower(F.trim(_col(c))), ACCENTED, ASCII_FOR_ACCENTED)


def key_from_prefix(name: str | Column, prefixes: Sequence[str]) -> Column:
    """Map a (normalised) name to the first prefix it starts with, case-insensitively; NULL when none does."""
    upper = F.upper(_col(name))
    lengths = {len(p) for p in prefixes}
    if len(lengths) == 1:  # equal-length prefixes: one substring + IN test instead of a CASE chain
        head = F.substring(upper, 1, lengths.pop())
        return F.when(head.isin([p.upper() for p in prefixes]), head)
    return F.coalesce(*[F.when(upper.startswith(p.upper()), F.lit(p)) for p in prefixes])


def label_parts(c: str | Column, names: Sequence[str], sep_regex: str = r"\|") -> list[Column]:
    """Split a delimited label and return one trimmed column per name; missing parts are NULL."""
    parts = F.split(_col(c), sep_regex)
    return [F.trim(F.get(parts, i)).alias(n) for i, n in enumerate(names)]


def assemble_timestamp(year, month, day, hour_minute, ts_type: str = "timestamp") -> Column:
    """``concat_ws(' ', concat_ws('-', y, m, d), 'H:mm')`` parsed leniently (unpadded parts are fine).
    A NULL part or malformed text gives NULL rather than an error."""
    text = F.concat_ws(" ", F.concat_ws("-", _col(year), _col(month), _col(day)), _col(hour_minute))
    return F.try_to_timestamp(text).cast(ts_type)
