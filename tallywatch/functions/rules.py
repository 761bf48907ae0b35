"""Rule predicates and alert reasons."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywatch.schema import DEFAULT_CONFIG, RiskConfig


def exceeds(value: Column, threshold: float) -> Column:
    """Strictly above the threshold; null counts as not above."""
    return F.coalesce(value > F.lit(threshold), F.lit(False))


def either(rule_flag: Column, model_flag: Column) -> Column:
    """Three-valued OR: unknown only if neither side is true and one is null."""
    return rule_flag | model_flag


def newer_than(ts: Column, as_of: datetime, days: int = 7) -> Column:
    """Event time inside the last ``days`` days before ``as_of``."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return ts.cast("timestamp_ntz") > start


def below_score(score: Column, threshold: float = -0.1) -> Column:
    """Anomaly by a fixed score threshold instead of the model's own cut."""
    return score < F.lit(threshold)


# Reason texts and their limits, in output order.
REASON_AMOUNT = "High amount transaction"
REASON_LOCATION = "Unusual location"
REASON_TIME = "Unusual time of day"
REASON_DEVIATION = "Amount deviates from user's average"
REASON_RAPID = "Rapid succession transactions"
QUIET_BEFORE_HOUR, QUIET_AFTER_HOUR = 6, 22
MAX_DEVIATION = 2.0
MIN_GAP_HOURS = 1


def reasons(
    has_previous: Column | None = None, config: RiskConfig = DEFAULT_CONFIG
) -> Column:
    """Array of reason texts from the feature columns of a row.

    A user's first transaction has a gap of 0 hours and so counts as rapid, unless
    ``has_previous`` tells which rows really follow another one.
    """
    hour = F.col("hour_of_day")
    rapid = F.col("time_since_last_txn") < MIN_GAP_HOURS
    if has_previous is not None:
        rapid = rapid & has_previous
    return F.array_compact(F.array(
        F.when(F.col("amount") > config.max_amount, REASON_AMOUNT),
        F.when(F.col("distance_from_nairobi") > config.max_distance_km, REASON_LOCATION),
        F.when((hour < QUIET_BEFORE_HOUR) | (hour > QUIET_AFTER_HOUR), REASON_TIME),
        F.when(F.col("amount_deviation") > MAX_DEVIATION, REASON_DEVIATION),
        F.when(rapid, REASON_RAPID),
    ))
