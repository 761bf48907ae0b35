"""Calendar features and the expected-volume curve."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Opening hours (inclusive), weekend days (1 = Sunday), month end.
BUSINESS_HOURS = (8, 18)
EVENING_HOURS = (19, 22)
WEEKEND_DAYS = (1, 7)
MONTH_END_DAY = 25

# Volume by time of day and the month-end peak on day 31.
BUSINESS_VOLUME = 1.5
EVENING_VOLUME = 1.2
NIGHT_VOLUME = 0.3
MONTH_END_PEAK = 2.5


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, rounded down; NTZ values are read as session time."""
    return F.unix_timestamp(ts.cast("timestamp"))


def _indicator(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def is_weekend(ts: Column) -> Column:
    return _indicator(F.dayofweek(ts).isin(*WEEKEND_DAYS))


def is_business_hours(ts: Column) -> Column:
    return _indicator(F.hour(ts).between(*BUSINESS_HOURS))


def is_end_of_month(ts: Column) -> Column:
    return _indicator(F.dayofmonth(ts) >= MONTH_END_DAY)


def volume_multiplier(ts: Column) -> Column:
    """Expected volume relative to an average hour."""
    days_in = (F.dayofmonth(ts) - MONTH_END_DAY).cast("double")
    rise = F.when(
        F.dayofmonth(ts) >= MONTH_END_DAY,
        1.0 + (MONTH_END_PEAK - 1.0) * (days_in / (31 - MONTH_END_DAY)),
    ).otherwise(1.0)
    hour = F.hour(ts)
    by_hour = (
        F.when(hour.between(*BUSINESS_HOURS), BUSINESS_VOLUME)
        .when(hour.between(*EVENING_HOURS), EVENING_VOLUME)
        .otherwise(NIGHT_VOLUME)
    )
    return rise * by_hour
