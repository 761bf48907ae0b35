"""Table schemas, feature names and rule settings shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Field names and types of the transaction record.
TRANSACTION = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
    ])),
    T.StructField("type", T.StringType()),
])

CORRUPT = "_corrupt"
TRANSACTION_OR_CORRUPT = T.StructType(
    [*TRANSACTION.fields, T.StructField(CORRUPT, T.StringType())]
)

# The fields a search document may carry, in index order.
# Timestamps travel as ISO-8601 text, the hour as two digits.
DOCUMENT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("transaction_timestamp", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ])),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("type", T.StringType()),
    T.StructField("is_flagged", T.BooleanType()),
    T.StructField("is_high_amount", T.BooleanType()),
    T.StructField("is_location_outlier", T.BooleanType()),
    T.StructField("distance_from_nairobi", T.DoubleType()),
    T.StructField("hour", T.StringType()),
    T.StructField("total_transactions", T.LongType()),
    T.StructField("total_volume", T.DoubleType()),
    T.StructField("flagged_count", T.LongType()),
    T.StructField("avg_amount", T.DoubleType()),
    T.StructField("max_amount", T.DoubleType()),
    T.StructField("min_amount", T.DoubleType()),
    T.StructField("document_type", T.StringType()),
])

# Model inputs, in model order.
FEATURES = [
    "amount",
    "hour_of_day",
    "day_of_week",
    "day_of_month",
    "distance_from_nairobi",
    "user_transaction_count",
    "user_avg_amount",
    "amount_deviation",
    "time_since_last_txn",
    "is_weekend",
    "is_business_hours",
    "is_end_of_month",
]


@dataclass(frozen=True)
class RiskConfig:
    """Rule thresholds; the defaults are fixed values of the rule set."""

    center_lat: float = -1.286389
    center_long: float = 36.817223
    earth_radius_km: float = 6371.0
    mask_radius_deg: float = 0.1
    max_amount: float = 10000.0
    max_distance_km: float = 50.0
    max_window_count: int = 5
    window: str = "60 seconds"
    slide: str = "30 seconds"


DEFAULT_CONFIG = RiskConfig()
