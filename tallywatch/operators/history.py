"""Per-user history: gap to the previous transaction, counts, means, recipients.

Ordinary users are handled by one window pass (one shuffle on the user). A hot user is
never gathered in one task: its rows are collapsed to one row per second before any
window runs, so a window group has at most 86,400 rows, and its count and mean come from a
partial aggregation and a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.clock import epoch_seconds
from tallywatch.operators.skew import (
    DEFAULT_POLICY,
    KeyTable,
    SkewPolicy,
    join_on,
    with_key_aggregates,
)

USER = "user_id"
TIME = "transaction_timestamp"
ROW_ID = "event_id"
SECONDS_PER_DAY = 86_400


def user_aggregates() -> dict[str, Column]:
    return {
        "user_transaction_count": F.count("*"),
        "user_avg_amount": F.avg("amount"),
    }


def with_user_stats(rows: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Adds each user's transaction count and mean amount."""
    return with_key_aggregates(rows, [USER], user_aggregates(), policy)


def with_user_count(rows: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Adds each user's transaction count only."""
    return with_key_aggregates(
        rows, [USER], {"user_transaction_count": F.count("*")}, policy
    )


def with_history(
    rows: DataFrame,
    row_id: str = ROW_ID,
    policy: SkewPolicy = DEFAULT_POLICY,
    users: KeyTable | None = None,
) -> DataFrame:
    """Adds ``gap_seconds`` (null for a first transaction), user count and user mean.

    ``users`` may hold the user sizes if they are known already.
    """
    users = users or KeyTable(rows, [USER], user_aggregates(), policy)
    if not users.has_hot_keys:
        return history_of_ordinary_users(rows, row_id)
    ordinary, hot = users.split(rows)
    known = F.broadcast(users.hot.select(USER, *user_aggregates()))
    return history_of_ordinary_users(ordinary, row_id).unionByName(
        history_of_hot_users(hot, known, row_id)
    )


def history_of_hot_users(rows: DataFrame, users: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """The same for rows of hot users only; ``users`` has their ``user_aggregates``."""
    return _collapsed_gaps(join_on(rows, users, [USER]), row_id)


def history_of_ordinary_users(rows: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """The same in one window pass; a user's rows must fit one task."""
    user = Window.partitionBy(USER)
    seconds = epoch_seconds(F.col(TIME))
    previous = F.lag(seconds, 1).over(user.orderBy(TIME, row_id))
    return rows.select(
        "*",
        (seconds - previous).alias("gap_seconds"),
        *[column.over(user).alias(name) for name, column in user_aggregates().items()],
    )


def _collapsed_gaps(rows: DataFrame, row_id: str) -> DataFrame:
    """Same gaps as the window, for rows of hot users.

    Gaps are whole seconds, so only the first row of each second has a non-zero gap: the
    distance to the user's previous distinct second, which lies on the same day or is the
    last one of an earlier day.
    """
    day = F.floor(F.col("_second") / SECONDS_PER_DAY)
    rows = rows.withColumn("_second", epoch_seconds(F.col(TIME)))
    within_day = F.lag("_second", 1).over(Window.partitionBy(USER, "_day").orderBy("_second"))
    seconds = (
        rows.groupBy(USER, day.alias("_day"), "_second")
        .agg(F.min(F.struct(TIME, row_id)).alias("_first"))
        .withColumn("_previous", within_day)
    )
    before_day = F.lag("_last", 1).over(Window.partitionBy(USER).orderBy("_day"))
    days = (
        rows.groupBy(USER, day.alias("_day"))
        .agg(F.max("_second").alias("_last"))
        .select(USER, "_day", before_day.alias("_before"))
    )
    firsts = join_on(seconds, days, [USER, "_day"]).select(
        USER,
        "_second",
        F.col(f"_first.{row_id}").alias(row_id),
        (F.col("_second") - F.coalesce("_previous", "_before")).alias("_gap"),
        F.lit(True).alias("_is_first"),
    )
    # The row id spreads this join evenly; user and second only guard repeated ids.
    joined = join_on(rows, firsts, [row_id, USER, "_second"])
    gap = (
        F.when(F.col("_second").isNull(), F.lit(None).cast("long"))
        .when(F.col("_is_first"), F.col("_gap"))
        .otherwise(F.lit(0).cast("long"))
    )
    return joined.withColumn("gap_seconds", gap).drop("_second", "_gap", "_is_first")


def gap_hours(gap_seconds: Column) -> Column:
    """Gap in hours; 0 for a user's first transaction."""
    return F.coalesce(gap_seconds / F.lit(3600.0), F.lit(0.0))


def relative_deviation(amount: Column, mean: Column) -> Column:
    """Distance from the user's mean as a share of it; 0 unless the mean is positive."""
    return F.when(mean > 0, (amount - mean) / mean).otherwise(F.lit(0.0))


def with_recipient_features(
    rows: DataFrame, recipient: str = "recipient_id", policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Adds how often the user paid this recipient, and whether it was only once."""
    frequency = {"recipient_frequency": F.count("*")}
    return with_key_aggregates(rows, [USER, recipient], frequency, policy).withColumn(
        "is_new_recipient", F.when(F.col("recipient_frequency") == 1, 1).otherwise(0)
    )
