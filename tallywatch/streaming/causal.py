"""Per-user features that only look back, over rows that a stream has gathered.

The stream writes each micro-batch to a folder of its own. Features are computed over the
gathered rows in event-time order, so they do not depend on the order in which rows came.

Ordinary users take one window pass. Rows of hot users are range-partitioned by (user, time,
row id), which cuts a hot user into even runs; running values are computed per run and
shifted by the totals of the earlier runs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tallywatch.functions.clock import epoch_seconds
from tallywatch.operators.history import ROW_ID, TIME, USER
from tallywatch.operators.skew import (
    DEFAULT_POLICY,
    KEY_ROWS,
    KeyTable,
    SkewPolicy,
    attach,
    join_on,
)
from tallywatch.session import materialize
from tallywatch.streaming.queries import BatchWriter


def _running(window: WindowSpec) -> list[Column]:
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return [
        F.count("*").over(so_far).alias("_rows"),
        F.count("amount").over(so_far).alias("_amounts"),
        F.coalesce(F.sum("amount").over(so_far), F.lit(0.0)).alias("_sum"),
        F.lag("_second", 1).over(window).alias("_previous"),
    ]


def _run_hot_users(rows: DataFrame, row_id: str, n_runs: int) -> DataFrame:
    """Running values for hot users; no group is larger than one of ``n_runs`` ranges."""
    placed = materialize(
        rows.repartitionByRange(n_runs, USER, TIME, row_id).withColumn(
            "_run", F.spark_partition_id()
        )
    )
    runs = placed.groupBy(USER, "_run").agg(
        F.count("*").alias("r"),
        F.count("amount").alias("a"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("s"),
        F.max("_second").alias("l"),
    )
    earlier = Window.partitionBy(USER).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        USER,
        "_run",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_shift_{c}") for c in "ras"],
        F.max("l").over(earlier).alias("_shift_l"),
    )
    inside = placed.select("*", *_running(Window.partitionBy(USER, "_run").orderBy(TIME, row_id)))
    joined = join_on(inside, shifts, [USER, "_run"])
    return joined.withColumns({
        "_rows": F.col("_rows") + F.col("_shift_r"),
        "_amounts": F.col("_amounts") + F.col("_shift_a"),
        "_sum": F.col("_sum") + F.col("_shift_s"),
        "_previous": F.coalesce("_previous", "_shift_l"),
    }).drop("_run", "_shift_r", "_shift_a", "_shift_s", "_shift_l")


def causal_features(
    transactions: DataFrame,
    state: DataFrame | None = None,
    row_id: str = ROW_ID,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> tuple[DataFrame, DataFrame]:
    """Count and mean up to and including each row, and seconds since the user's last row.

    ``state`` holds the users' totals before these rows. Also returns the totals after them,
    for the users that occur.
    """
    ts = F.col(TIME).cast("timestamp")
    rows = transactions.select(
        USER, row_id, "amount", ts.alias(TIME), epoch_seconds(ts).alias("_second")
    )
    users = KeyTable(
        rows,
        [USER],
        {
            "row_count": F.count("*"),
            "amount_count": F.count("amount"),
            "amount_sum": F.coalesce(F.sum("amount"), F.lit(0.0)),
            "last_second": F.max("_second"),
        },
        policy,
    )
    before = _known_users(state, users)
    by_user = Window.partitionBy(USER).orderBy(TIME, row_id)
    if users.has_hot_keys:
        ordinary, hot = users.split(rows)
        n_runs = 2 * (users.n_hot_rows // users.row_limit + 1)
        running = ordinary.select("*", *_running(by_user)).unionByName(
            _run_hot_users(hot, row_id, n_runs)
        )
    else:
        running = rows.select("*", *_running(by_user))
    joined = attach(running, before, users.n_keys, users, row_id)
    amounts = F.col("_amounts") + F.coalesce("amount_count", F.lit(0))
    features = joined.select(
        USER,
        row_id,
        (F.col("_rows") + F.coalesce("row_count", F.lit(0))).alias("user_count_so_far"),
        F.when(
            amounts > 0, (F.col("_sum") + F.coalesce("amount_sum", F.lit(0.0))) / amounts
        ).alias("user_avg_so_far"),
        (F.col("_second") - F.coalesce("_previous", "last_second")).alias("seconds_since_last"),
    )
    return features, merge_states(users.table.drop(KEY_ROWS), before)


def _known_users(state: DataFrame | None, users: KeyTable) -> DataFrame:
    """State rows of the users that occur; the state is filtered, not shuffled, if those are
    few."""
    if state is None:
        return users.table.drop(KEY_ROWS).filter(F.lit(False))
    names = users.table.select(USER)
    if users.is_small:
        names = F.broadcast(names)
    return join_on(state, names, [USER], "left_semi")


def merge_states(*states: DataFrame) -> DataFrame:
    """Totals of several row sets taken together."""
    merged = states[0]
    for state in states[1:]:
        merged = merged.unionByName(state)
    return merged.groupBy(USER).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("amount_count").alias("amount_count"),
        F.sum("amount_sum").alias("amount_sum"),
        F.max("last_second").alias("last_second"),
    )


def stage_writer(root: str) -> BatchWriter:
    """``foreachBatch`` function: the rows of a batch in a folder of their own, replaced if the
    batch runs again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return write


def staged_features(
    spark: SparkSession,
    root: str,
    until: datetime | None = None,
    row_id: str = ROW_ID,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Features of all staged rows with event times before ``until``.

    Rows are ordered by event time and row id, so neither the order of files nor the size of
    batches matters.
    """
    rows = spark.read.parquet(root).drop("batch_id")
    if until is not None:
        rows = rows.filter(F.col(TIME) < F.lit(until))
    return causal_features(rows, None, row_id, policy)[0]


def late_rows(spark: SparkSession, root: str, delay_seconds: int) -> DataFrame:
    """Staged rows that came more than ``delay_seconds`` behind the latest event time of the
    batches before theirs, with ``seconds_late``. They are part of the features like all
    others, and change those of rows after them that were read earlier."""
    rows = spark.read.parquet(root)
    second = epoch_seconds(F.col(TIME).cast("timestamp"))
    # one row per batch, so one task may see all of them
    earlier = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("batch_id").agg(F.max(second).alias("_latest")).select(
        F.col("batch_id").alias("_batch"), F.max("_latest").over(earlier).alias("_before"))
    behind = F.col("_before") - second - F.lit(delay_seconds)
    return rows.join(before, rows["batch_id"] == before["_batch"]).withColumn(
        "seconds_late", behind).drop("_batch", "_before").filter(F.col("seconds_late") > 0)
