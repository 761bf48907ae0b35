"""Data-quality rules: one-pass violation counts and a quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted ranges of a transaction record.
MIN_AMOUNT = 100.0
MAX_LATITUDE = 90.0
MAX_LONGITUDE = 180.0
TRANSFER_TYPES = ("transfer",)


def quality_rules(allowed_types: tuple[str, ...] = TRANSFER_TYPES) -> dict[str, Column]:
    """Rule name to the condition a good row meets. A missing value only fails ``has_*``."""
    def absent_or(name: str, condition: Column) -> Column:
        return F.col(name).isNull() | condition

    timestamp = F.col("timestamp")
    return {
        "has_user_id": F.col("user_id").isNotNull(),
        "has_amount": F.col("amount").isNotNull(),
        "has_timestamp": timestamp.isNotNull(),
        "has_location": F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
        "has_type": F.col("type").isNotNull(),
        "amount_in_range": absent_or("amount", F.col("amount") >= MIN_AMOUNT),
        "known_type": absent_or("type", F.col("type").isin(*allowed_types)),
        "latitude_in_range": absent_or("latitude", F.abs("latitude") <= MAX_LATITUDE),
        "longitude_in_range": absent_or("longitude", F.abs("longitude") <= MAX_LONGITUDE),
        "timestamp_parses": timestamp.isNull() | timestamp.try_cast("timestamp").isNotNull(),
    }


def quality_report(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Violations per rule, one pass over the rows."""
    rules = rules or quality_rules()
    counts = df.agg(
        F.count("*").alias("checked"),
        *[F.count_if(~condition).alias(name) for name, condition in rules.items()],
    )
    return counts.unpivot(["checked"], list(rules), "rule", "violations").select(
        "rule", "violations", "checked"
    )


def split_quarantine(
    df: DataFrame, rules: dict[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with the names of the broken rules."""
    rules = rules or quality_rules()
    broken = F.array_compact(
        F.array(*[F.when(~condition, F.lit(name)) for name, condition in rules.items()])
    )
    checked = df.withColumn("broken_rules", broken)
    return (
        checked.filter(F.size("broken_rules") == 0).drop("broken_rules"),
        checked.filter(F.size("broken_rules") > 0),
    )
