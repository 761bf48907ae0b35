"""Transactions stored so that later jobs need not move or read them: bucketed by user, and
partitioned by day.

A bucketed history is written once and read by many jobs: windows and joins on the user find
the rows of a user together and shuffle nothing. A bucket is one task, so users that are hot by
the skew policy are kept beside it, in a plain table, and take the paths that split them.

A daily table lets filters on the day skip whole folders: filters on constants when the query is
planned, filters that come from another table (a calendar) when it runs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.rules import newer_than
from tallywatch.operators.history import (
    ROW_ID,
    TIME,
    USER,
    history_of_hot_users,
    history_of_ordinary_users,
    user_aggregates,
)
from tallywatch.operators.skew import (
    DEFAULT_POLICY,
    KeyTable,
    SkewPolicy,
    broadcast_if_small,
    join_on,
)

BUCKETS = 64
DAY = "day"
CALENDAR_DAYS = 100_000
"""Most days of a calendar that is broadcast."""


def write_bucketed(
    rows: DataFrame, name: str, path: str, key: str, order: list[str], buckets: int,
    mode: str = "overwrite",
) -> DataFrame:
    """A table whose files hold whole buckets of ``key``, sorted. The session's catalog knows
    the buckets; ``open_bucketed`` tells another session."""
    spark = rows.sparkSession
    # dealt as the buckets are, so that each has one file
    dealt = rows.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(*order).option(
        "path", path).mode(mode).saveAsTable(name)
    return spark.table(name)


def open_bucketed(
    spark: SparkSession, name: str, path: str, key: str, order: list[str], buckets: int
) -> DataFrame:
    """Enter a table that ``write_bucketed`` wrote into this session's catalog."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY ({', '.join(f'`{c}`' for c in order)}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


@dataclass
class HistoryTable:
    """Transactions bucketed by user; those of hot users in a plain table beside them."""

    spark: SparkSession
    name: str
    path: str
    buckets: int = BUCKETS
    row_id: str = ROW_ID

    @classmethod
    def write(
        cls, rows: DataFrame, path: str, name: str | None = None, buckets: int = BUCKETS,
        row_id: str = ROW_ID, policy: SkewPolicy = DEFAULT_POLICY,
    ) -> HistoryTable:
        name = name or f"history_{uuid.uuid4().hex}"
        table = cls(rows.sparkSession, name, path.rstrip("/"), buckets, row_id)
        users = KeyTable(rows, [USER], policy=policy)
        ordinary, hot = users.split(rows) if users.has_hot_keys else (rows, rows.limit(0))
        write_bucketed(
            ordinary, name, f"{table.path}/ordinary", USER, [USER, TIME, row_id], buckets)
        hot.write.mode("overwrite").parquet(f"{table.path}/hot")
        hot.select(USER).distinct().write.mode("overwrite").parquet(f"{table.path}/hot_users")
        return table

    @classmethod
    def open(
        cls, spark: SparkSession, path: str, name: str | None = None, buckets: int = BUCKETS,
        row_id: str = ROW_ID,
    ) -> HistoryTable:
        """The table below ``path``, written by another session with as many buckets."""
        name = name or f"history_{uuid.uuid4().hex}"
        table = cls(spark, name, path.rstrip("/"), buckets, row_id)
        open_bucketed(
            spark, name, f"{table.path}/ordinary", USER, [USER, TIME, row_id], buckets)
        return table

    @property
    def ordinary(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def hot(self) -> DataFrame:
        return self.spark.read.schema(self.ordinary.schema).parquet(f"{self.path}/hot")

    @property
    def has_hot_users(self) -> bool:
        return not self.spark.read.parquet(f"{self.path}/hot_users").isEmpty()

    def append(self, rows: DataFrame) -> None:
        """Add rows; those of the users that were hot at the last ``write`` go to their table.
        A user that has become hot since stays in its bucket until the next one."""
        users = F.broadcast(self.spark.read.parquet(f"{self.path}/hot_users"))
        rows = rows.select(self.ordinary.columns)
        write_bucketed(
            join_on(rows, users, [USER], "left_anti"), self.name, f"{self.path}/ordinary", USER,
            [USER, TIME, self.row_id], self.buckets, mode="append")
        join_on(rows, users, [USER], "left_semi").write.mode("append").parquet(f"{self.path}/hot")

    def with_history(self) -> DataFrame:
        """All rows with gap, user count and user mean. Ordinary users' rows are not moved."""
        if not self.has_hot_users:
            return history_of_ordinary_users(self.ordinary, self.row_id)
        hot = self.hot
        # one row per hot user: at most ``max_hot_keys``
        known = F.broadcast(hot.groupBy(USER).agg(
            *[column.alias(name) for name, column in user_aggregates().items()]))
        return history_of_ordinary_users(self.ordinary, self.row_id).unionByName(
            history_of_hot_users(hot, known, self.row_id))

    def with_profiles(self, profiles: DataFrame, hot_profiles: DataFrame) -> DataFrame:
        """All rows with their user's profile. ``profiles`` has one row per user and is bucketed
        like the history, so neither side is moved; ``hot_profiles`` are those of the hot
        users, which ``split_profiles`` takes from them."""
        ordinary = self.ordinary.join(profiles, USER, "left")
        if not self.has_hot_users:
            return ordinary
        return ordinary.unionByName(self.hot.join(F.broadcast(hot_profiles), USER, "left"))

    def split_profiles(self, profiles: DataFrame) -> DataFrame:
        """The profiles of hot users, of whom there are at most ``max_hot_keys``."""
        hot = F.broadcast(self.spark.read.parquet(f"{self.path}/hot_users"))
        return profiles.join(hot, USER, "left_semi")


# -- by day -------------------------------------------------------------------------------


def write_daily(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per day. A day of many rows is written by several tasks; rows without time
    have a folder of their own."""
    daily = rows.withColumn(DAY, F.to_date(TIME))
    daily.hint("rebalance", DAY).write.partitionBy(DAY).mode(mode).parquet(path)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def recent_days(daily: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``; only folders that may hold some are
    read."""
    first = (as_of - timedelta(days=days)).date()
    return daily.filter(F.col(DAY) >= F.lit(first)).filter(newer_than(F.col(TIME), as_of, days))


def write_calendar(daily: DataFrame, path: str) -> None:
    """One row for every day that the table has, with what is known of days."""
    daily.select(DAY).distinct().filter(F.col(DAY).isNotNull()).select(
        DAY,
        F.dayofmonth(DAY).alias("day_of_month"),
        F.dayofweek(DAY).alias("day_of_week"),
    ).coalesce(1).write.mode("overwrite").parquet(path)


def on_days(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows of the days in ``calendar``, whose filter decides at run time which folders are
    read. Spark prunes behind comparisons, not behind a column that is a flag by itself."""
    days = broadcast_if_small(calendar.select(DAY), CALENDAR_DAYS)
    return daily.join(days, DAY, "left_semi")
