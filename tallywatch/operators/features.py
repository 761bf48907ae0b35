"""The twelve model features, their defaults, and standard scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions import clock
from tallywatch.operators.history import (
    ROW_ID,
    TIME,
    gap_hours,
    relative_deviation,
    with_history,
)
from tallywatch.operators.skew import DEFAULT_POLICY, SkewPolicy
from tallywatch.schema import FEATURES
from tallywatch.session import materialize


def with_calendar(df: DataFrame) -> DataFrame:
    ts = F.col(TIME)
    return df.withColumns({
        "hour_of_day": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "day_of_month": F.dayofmonth(ts),
        "is_weekend": clock.is_weekend(ts),
        "is_business_hours": clock.is_business_hours(ts),
        "is_end_of_month": clock.is_end_of_month(ts),
    })


def add_missing_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Feature columns the table lacks, as 0."""
    missing = [name for name in features if name not in df.columns]
    return df.withColumns({name: F.lit(0.0) for name in missing}) if missing else df


def fill_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Nulls in the feature columns that exist become 0."""
    return df.fillna(0, subset=[name for name in features if name in df.columns])


def prepare_features(
    df: DataFrame, row_id: str = ROW_ID, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Calendar and history features, then null fill and defaults.

    ``df`` should carry the rule columns; without a distance that feature is 0.
    ``gap_seconds`` is kept: it is null exactly for first transactions.
    """
    return add_feature_columns(with_history(df, row_id, policy))


def add_feature_columns(history: DataFrame) -> DataFrame:
    """All features from rows that carry gap, user count and user mean."""
    full = with_calendar(history).withColumns({
        "time_since_last_txn": gap_hours(F.col("gap_seconds")),
        "amount_deviation": relative_deviation(F.col("amount"), F.col("user_avg_amount")),
    })
    return add_missing_features(fill_features(full))


def scale_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0.

    ``df`` is stored once, then read for the moments and for the rows, so that whatever made it
    does not run twice. Means and deviations are one scalar subquery.
    """
    df = materialize(df)
    moments = df.agg(F.struct(
        *[F.avg(name).alias(f"mean_{name}") for name in features],
        *[F.stddev_pop(name).alias(f"std_{name}") for name in features],
    ).alias("moments")).scalar()

    def scaled(name: str):
        std = moments[f"std_{name}"]
        return (F.col(name) - moments[f"mean_{name}"]) / F.when(std == 0, 1.0).otherwise(std)

    return df.withColumns({name: scaled(name) for name in features})
