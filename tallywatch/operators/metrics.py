"""Aggregates over transactions: windows, hourly totals, dashboards, statistics.

Every aggregate is partial before its shuffle, so a hot user, hour or window adds no more
to a shuffle than one row per task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.clock import volume_multiplier
from tallywatch.functions.rules import exceeds
from tallywatch.schema import DEFAULT_CONFIG, RiskConfig
from tallywatch.session import materialize


def user_window_counts(df: DataFrame, config: RiskConfig = DEFAULT_CONFIG) -> DataFrame:
    """Transactions per user and sliding event-time window."""
    return (
        df.groupBy(F.window("transaction_timestamp", config.window, config.slide), "user_id")
        .agg(F.count("*").alias("transaction_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "user_id",
            "transaction_count",
        )
    )


def frequent_users(df: DataFrame, config: RiskConfig = DEFAULT_CONFIG) -> DataFrame:
    """Windows in which a user has more transactions than allowed."""
    return user_window_counts(df, config).filter(
        F.col("transaction_count") > config.max_window_count
    ).withColumn("is_high_frequency", F.lit(True))


def hourly_metrics(df: DataFrame) -> DataFrame:
    """Totals per hour of day over all dates, in hour order."""
    return (
        df.groupBy(F.hour("transaction_timestamp").alias("hour"))
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("amount").alias("total_volume"),
            F.count_if("is_flagged").alias("flagged_count"),
            F.avg("amount").alias("avg_amount"),
            F.max("amount").alias("max_amount"),
            F.min("amount").alias("min_amount"),
        )
        .orderBy("hour")
    )


def hourly_chart(df: DataFrame, size: int = 24) -> DataFrame:
    """The first ``size`` hours of the day."""
    return hourly_metrics(df).orderBy("hour").limit(size)


def fraud_type_breakdown(df: DataFrame) -> DataFrame:
    """Overlapping counts per rule over flagged rows, and rows with a user."""
    counts = df.filter("is_flagged").agg(
        F.count_if("is_high_amount").alias("high_amount"),
        F.count_if("is_location_outlier").alias("location_outlier"),
        F.count("user_id").alias("total_flagged"),
    )
    return counts.unpivot(
        [], ["high_amount", "location_outlier", "total_flagged"], "bucket", "doc_count"
    )


def fraud_rate(df: DataFrame) -> DataFrame:
    """Flagged and total transactions and their ratio."""
    return df.agg(
        F.count_if("is_flagged").alias("flagged"),
        F.count("*").alias("total"),
        F.avg(F.col("is_flagged").cast("int")).alias("fraud_rate"),
    )


def _calendar_hours(df: DataFrame) -> DataFrame:
    """Count and volume per calendar hour; one row per hour that has data."""
    ts_type = df.schema["transaction_timestamp"].dataType
    hour_start = F.date_trunc("hour", "transaction_timestamp").cast(ts_type)
    return (
        df.filter(F.col("transaction_timestamp").isNotNull())
        .groupBy(hour_start.alias("hour_start"))
        .agg(
            F.count("*").alias("doc_count"),
            F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_volume"),
        )
    )


def _bounds(hours: DataFrame) -> DataFrame:
    """First and last hour that have data, and how many hours lie between; one row, none
    without data."""
    ends = hours.agg(F.min("hour_start").alias("first"), F.max("hour_start").alias("last"))
    return ends.filter(F.col("first").isNotNull()).withColumn(
        "n_hours", F.expr("timestampdiff(HOUR, first, last)") + 1
    )


def _all_hours(hours: DataFrame) -> DataFrame:
    """Every hour of the covered period: the days are dealt over the tasks, each of which
    lists the hours of its own days."""
    days = _bounds(hours).select(
        "first", "last",
        F.explode(F.sequence(
            F.date_trunc("day", "first").cast(hours.schema["hour_start"].dataType), "last",
            F.expr("INTERVAL 1 DAY"),
        )).alias("day"),
    ).repartition("day")
    in_day = F.sequence(F.col("day"), F.expr("day + INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))
    return days.select("first", "last", F.explode(in_day).alias("hour_start")).filter(
        F.col("hour_start").between(F.col("first"), F.col("last"))
    ).select("hour_start")


def date_histogram(
    df: DataFrame, first: datetime | None = None, last: datetime | None = None
) -> DataFrame:
    """Count and volume per calendar hour, with empty hours inside the period as 0.

    The period runs from the first to the last transaction. ``first`` and ``last`` leave out
    times before and after them, so that a stray date does not add years of empty hours.
    The hours that have data are stored first, so the transactions are read once.
    """
    time = F.col("transaction_timestamp")
    if first is not None:
        df = df.filter(time >= F.lit(first))
    if last is not None:
        df = df.filter(time <= F.lit(last))
    hours = materialize(_calendar_hours(df))
    return _all_hours(hours).join(hours, "hour_start", "left").select(
        "hour_start",
        F.coalesce("doc_count", F.lit(0)).alias("doc_count"),
        F.coalesce("total_volume", F.lit(0.0)).alias("total_volume"),
    )


def volume_vs_expected(
    df: DataFrame, first: datetime | None = None, last: datetime | None = None
) -> DataFrame:
    """Hourly counts against the mean hour times the expected-volume multiplier.

    The mean is one scalar: all transactions of the period by its number of hours.
    """
    hours = date_histogram(df, first, last)
    mean = hours.agg(F.sum("doc_count") / F.count("*")).scalar()
    return hours.withColumn(
        "expected_count", mean * volume_multiplier(F.col("hour_start"))
    ).withColumn(
        "volume_ratio",
        F.when(F.col("expected_count") > 0, F.col("doc_count") / F.col("expected_count")),
    )


def top_users(df: DataFrame, size: int = 10) -> DataFrame:
    """Users with the most flagged transactions, with their flagged volume."""
    return (
        df.filter("is_flagged")
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count("*").alias("doc_count"), F.sum("amount").alias("total_amount"))
        .orderBy(F.desc("doc_count"), "user_id")
        .limit(size)
    )


def hotspots(df: DataFrame, row_id: str = "event_id", size: int = 100) -> DataFrame:
    """Flagged location outliers, farthest first."""
    return (
        df.filter(F.col("is_flagged") & F.col("is_location_outlier"))
        .orderBy(F.desc("distance_from_nairobi"), row_id)
        .limit(size)
    )


def alert_list(df: DataFrame, row_id: str = "event_id", size: int = 1000) -> DataFrame:
    """Flagged transactions in row-id order, one page of ``size``."""
    return df.filter("is_flagged").orderBy(row_id).limit(size)


def dataset_stats(df: DataFrame, config: RiskConfig = DEFAULT_CONFIG) -> DataFrame:
    high = F.count_if(exceeds(F.col("amount"), config.max_amount))
    total = F.count("*")
    return df.agg(
        total.alias("total_transactions"),
        high.alias("high_amount"),
        F.when(total > 0, high / total * 100).alias("high_amount_pct"),
    )


def repeat_users(df: DataFrame) -> DataFrame:
    """Users with more than one transaction."""
    return (
        df.groupBy("user_id")
        .agg(F.count("*").alias("transaction_count"))
        .filter(F.col("transaction_count") > 1)
    )
