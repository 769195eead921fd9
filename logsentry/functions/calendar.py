"""Calendar features of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First weekend day (Monday is 0), first and last business hour.
WEEKEND_START_DAY = 5
BUSINESS_DAY_START = 9
BUSINESS_DAY_END = 17


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= WEEKEND_START_DAY).cast("int")


def is_business_hours(ts: Column) -> Column:
    """1 from 9:00 to 17:59."""
    return F.hour(ts).between(BUSINESS_DAY_START, BUSINESS_DAY_END).cast("int")


def create_time_features(df: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """Add hour, day_of_week (Monday 0), day, month, minute, is_weekend, is_business_hours."""
    t = F.col(ts)
    return df.withColumns({
        "hour": F.hour(t),
        "day_of_week": F.weekday(t),
        "day": F.dayofmonth(t),
        "month": F.month(t),
        "minute": F.minute(t),
        "is_weekend": is_weekend(t),
        "is_business_hours": is_business_hours(t),
    })
