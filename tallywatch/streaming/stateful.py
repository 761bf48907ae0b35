"""Per-user features that only look back, computed inside the stream.

State per user: the totals so far, and the rows that the watermark has not passed yet. When it
passes them, a timer fires, the rows are taken in event-time order, added to the totals and sent
on. So neither the order of files nor the size of batches matters, no row is read twice, and a
restart goes on from the state. Rows that come behind the watermark are dropped by Spark, which
counts them (``numRowsDroppedByWatermark``); ``delay`` says how late a row may be.

A user's rows of one batch go through one task, in Arrow batches, and a timer holds the user's
rows of one ``delay`` in memory. For tables with a user too large for that, ``causal.py``
computes the same features over gathered rows, with hot users split.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from tallywatch.operators.history import ROW_ID, TIME, USER
from tallywatch.session import ship_package

HEARTBEAT = "__heartbeat__"
"""Reserved user: its rows only move the watermark."""
BEGIN, END = datetime(1970, 1, 1), datetime(2200, 1, 1)
TOTALS = "row_count long, amount_count long, amount_sum double, last_second long"


class RunningTotals(StatefulProcessor):
    """Count and mean up to and including each row, and seconds since the user's last row."""

    def __init__(self, row_id: str, id_type: str, idle_ms: int | None = None):
        self.row_id, self.id_type, self.idle_ms = row_id, id_type, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", TOTALS)
        # one entry holds the rows of a part, so a state call does not move rows one by one
        self.waiting = handle.getListState(
            "waiting", f"micros binary, amounts binary, ids array<{self.id_type}>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] == HEARTBEAT:
            return
        earliest, packed = None, []
        for part in rows:
            ids = part[self.row_id].tolist()
            micros = part["event_micros"].to_numpy(np.float64, na_value=np.nan)
            timeless = np.isnan(micros)
            if timeless.any():  # no place in the order: sent on at once, without features
                none = np.zeros(int(timeless.sum()))
                yield self.out(
                    key[0], [i for i, t in zip(ids, timeless) if t], none, none, none, none == 0)
            if not timeless.all():
                amounts = part["amount"].to_numpy(np.float64, na_value=np.nan)[~timeless]
                ids = [i for i, t in zip(ids, timeless) if not t]
                times = part["event_micros"].to_numpy()[~timeless].astype(np.int64)
                packed.append((times.tobytes(), amounts.tobytes(), ids))
                first = int(times.min())
                earliest = first if earliest is None else min(first, earliest)
        if packed:
            self.waiting.appendList(packed)
            self.handle.registerTimer(earliest // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, rest, later = [], [], None
        for times, amounts, ids in self.waiting.get():
            micros, values = np.frombuffer(times, np.int64), np.frombuffer(amounts, np.float64)
            now = micros <= passed
            if now.any():
                ready.append((micros[now], values[now], [i for i, n in zip(ids, now) if n]))
            if not now.all():
                first = int(micros[~now].min())
                later = first if later is None else min(first, later)
                rest.append((micros[~now].tobytes(), values[~now].tobytes(),
                             [i for i, n in zip(ids, now) if not n]))
        totals = self.totals.get()
        if ready:
            micros, values = (np.concatenate([part[i] for part in ready]) for i in (0, 1))
            totals, found = self.advance(
                key[0], totals, micros, values, [i for part in ready for i in part[2]])
            self.totals.update(totals)
            yield found
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        if rest:
            self.handle.registerTimer(later // 1000)
        elif self.idle_ms is not None and totals is not None:
            gone = totals[3] * 1000 + self.idle_ms
            if gone * 1000 <= passed:
                self.totals.clear()
            elif ready:
                self.handle.registerTimer(gone)

    def advance(self, user, totals, micros, values, ids: list) -> tuple[tuple, pd.DataFrame]:
        """Add rows in order and give each the totals up to it."""
        count, amounts, total, last = totals or (0, 0, 0.0, None)
        times = micros.tolist()
        order = sorted(range(len(ids)), key=lambda i: (times[i], ids[i]))
        second, values = micros[order] // 1_000_000, values[order]
        known = ~np.isnan(values)
        counts = count + np.arange(1, len(ids) + 1)
        seen = amounts + np.cumsum(known)
        # added up one after the other, as without the totals before
        sums = np.cumsum(np.concatenate([[total], np.where(known, values, 0.0)]))[1:]
        means = np.divide(sums, seen, out=np.full(len(ids), np.nan), where=seen > 0)
        first = second[0] if last is None else last
        gaps = np.diff(second, prepend=first)
        timeless = np.zeros(len(ids), bool)
        found = self.out(
            user, [ids[i] for i in order], counts, means, gaps, timeless, last is None)
        return (int(counts[-1]), int(seen[-1]), float(sums[-1]), int(second[-1])), found

    def out(self, user, ids: list, counts, means, gaps, empty, begins=False) -> pd.DataFrame:
        """Rows with their features; none where ``empty``, no gap in the first if it ``begins``
        the user's rows."""
        without_gap = empty.copy()
        without_gap[:1] |= begins
        return pd.DataFrame({
            USER: pd.Series([user] * len(ids), dtype=object),
            self.row_id: pd.Series(ids, dtype=object),
            "user_count_so_far": pd.arrays.IntegerArray(counts.astype(np.int64), empty),
            "user_avg_so_far": np.where(empty, np.nan, means),
            "seconds_since_last": pd.arrays.IntegerArray(gaps.astype(np.int64), without_gap),
        })

    def close(self) -> None:
        pass


def causal_stream(
    parsed: DataFrame, delay: str, idle_days: int | None = None, row_id: str = ROW_ID
) -> DataFrame:
    """Features of every row, in append mode, as soon as the watermark has passed it.

    Row ids break ties in time and must not be null; amounts may be. A row without event time
    gets no features and is no part of later ones. With ``idle_days`` the totals of a user
    without rows for so long are forgotten, and counting begins anew; otherwise every user's
    totals (four numbers) stay.
    """
    ship_package(parsed.sparkSession)
    rows = parsed.select(
        F.col(USER).cast("string").alias(USER), row_id, F.col("amount").cast("double"),
        F.col(TIME).cast("timestamp").alias(TIME),
    ).withWatermark(TIME, delay).withColumn("event_micros", F.unix_micros(TIME))
    id_type = rows.schema[row_id].dataType.simpleString()
    idle_ms = None if idle_days is None else idle_days * 86_400_000
    schema = StructType.fromDDL(
        f"{USER} string, {row_id} {id_type}, user_count_so_far long, user_avg_so_far double, "
        "seconds_since_last long")
    return rows.groupBy(USER).transformWithStateInPandas(
        statefulProcessor=RunningTotals(row_id, id_type, idle_ms),
        outputStructType=schema, outputMode="append", timeMode="EventTime")


# -- the end of a finite stream ----------------------------------------------------------

BEAT = f"{TIME} timestamp"


def write_heartbeat(spark: SparkSession, folder: str, at: datetime = BEGIN) -> None:
    """Tell the stream that reads ``folder`` that event time has come to ``at``. ``END`` lets all
    waiting rows out; nothing can follow it."""
    seconds = F.timestamp_seconds(F.lit(int((at - BEGIN).total_seconds())))
    spark.range(1).select(seconds.alias(TIME)).coalesce(1).write.mode("append").parquet(folder)


def with_heartbeats(parsed: DataFrame, folder: str, row_id: str = ROW_ID) -> DataFrame:
    """The columns that the features need, with the heartbeats of a folder among the rows. The
    folder must hold one."""
    rows = parsed.select(
        F.col(USER).cast("string").alias(USER), row_id, F.col("amount").cast("double"),
        F.col(TIME).cast("timestamp").alias(TIME))
    beats = parsed.sparkSession.readStream.schema(BEAT).parquet(folder).select(
        F.lit(HEARTBEAT).alias(USER), F.lit(0).cast(rows.schema[row_id].dataType).alias(row_id),
        F.lit(None).cast("double").alias("amount"), TIME)
    return rows.unionByName(beats)
