"""Calendar parts derived from an hourly timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar descriptions that are *not* holidays.
NON_HOLIDAY_DESCRIPTIONS = ("weekend", "working day")
# ISO weekday numbers of Saturday and Sunday.
WEEKEND_ISO_DAYS = (6, 7)


def iso_day_of_week(ts: str | Column) -> Column:
    """ISO weekday, Monday=1 .. Sunday=7."""
    return F.weekday(ts) + 1


def calendar_parts(ts: str = "timestamp_utc", desc: str = "desc") -> dict[str, Column]:
    """hour_of_day, day_of_week, is_weekend, is_holiday, month, day_of_year.

    ``is_holiday`` is 1 when the description is neither weekend nor working day; a NULL
    description gives 0 (an unknown condition falls to ELSE)."""
    dow = iso_day_of_week(ts)
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": dow,
        "is_weekend": F.when(dow.isin(*WEEKEND_ISO_DAYS), 1).otherwise(0),
        "is_holiday": F.when(~F.col(desc).isin(*NON_HOLIDAY_DESCRIPTIONS), 1).otherwise(0),
        "month": F.month(ts),
        "day_of_year": F.dayofyear(ts),
    }
