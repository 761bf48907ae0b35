"""Profile joins and model scoring of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.clock import epoch_seconds
from tallywatch.operators.features import add_feature_columns
from tallywatch.operators.history import ROW_ID, TIME, USER, user_aggregates, with_history
from tallywatch.operators.model import AnomalyModel
from tallywatch.operators.rules import apply_rules
from tallywatch.operators.skew import (
    DEFAULT_POLICY,
    KeyTable,
    SkewPolicy,
    attach,
    broadcast_if_small,
    join_on,
)
from tallywatch.plans.scoring import with_enhanced_flag
from tallywatch.schema import DEFAULT_CONFIG, RiskConfig
from tallywatch.streaming.queries import BatchWriter, fan_out


def build_profiles(history: DataFrame) -> DataFrame:
    """One row per user: transactions so far, their mean amount and last time."""
    return history.groupBy(USER).agg(
        F.count("*").alias("profile_count"),
        F.count("amount").alias("profile_amounts"),
        F.sum("amount").alias("profile_sum"),
        F.max(epoch_seconds(F.col(TIME))).alias("profile_last_second"),
    )


def with_profiles(
    stream: DataFrame, profiles: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Stream-static left join, null-safe; profiles are broadcast if they are few enough."""
    return join_on(stream, broadcast_if_small(profiles, policy.broadcast_keys), [USER])


def profile_batch_writer(
    profiles: DataFrame,
    write: BatchWriter,
    row_id: str = ROW_ID,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> BatchWriter:
    """``foreachBatch`` function for the same join with any number of profiles and hot users."""
    n_profiles = profiles.count()

    def join_batch(batch: DataFrame, batch_id: int) -> None:
        users = KeyTable(batch, [USER], policy=policy)
        write(attach(batch, profiles, n_profiles, users, row_id), batch_id)

    return fan_out(join_batch)


def features_with_profiles(
    batch: DataFrame,
    profiles: DataFrame,
    row_id: str = ROW_ID,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Features of a micro-batch as if its users' profile history preceded it.

    The profile table is only filtered by the users of the batch, not shuffled, as long as
    those are few enough to broadcast.
    """
    users = KeyTable(
        batch,
        [USER],
        {
            **user_aggregates(),
            "batch_amounts": F.count("amount"),
            "batch_sum": F.sum("amount"),
        },
        policy,
    )
    if users.is_small:
        profiles = join_on(profiles, F.broadcast(users.table.select(USER)), [USER], "left_semi")

    def both(now: str, past: str):
        return F.coalesce(now, F.lit(0)) + F.coalesce(past, F.lit(0))

    amounts = both("batch_amounts", "profile_amounts")
    totals = join_on(users.table, profiles, [USER]).select(
        USER,
        both("user_transaction_count", "profile_count").alias("user_transaction_count"),
        F.when(amounts > 0, both("batch_sum", "profile_sum") / amounts).alias("user_avg_amount"),
        "profile_last_second",
    )
    own_history = with_history(batch, row_id, policy, users).drop(
        "user_transaction_count", "user_avg_amount"
    )
    rows = attach(own_history, totals, users.n_keys, users, row_id)
    since_profile = epoch_seconds(F.col(TIME)) - F.col("profile_last_second")
    return add_feature_columns(
        rows.withColumn("gap_seconds", F.coalesce("gap_seconds", since_profile)).drop(
            "profile_last_second"
        )
    )


def scoring_batch_writer(
    model: AnomalyModel,
    profiles: DataFrame,
    write: BatchWriter,
    config: RiskConfig = DEFAULT_CONFIG,
    policy: SkewPolicy = DEFAULT_POLICY,
    follow: bool = False,
) -> BatchWriter:
    """``foreachBatch`` function: rules, features, score and enhanced flag, then ``write``.

    With ``follow`` every batch begins with a look at the model's folder, and is scored as a
    whole by the version that is current then.
    """
    def score_batch(batch: DataFrame, batch_id: int) -> None:
        if follow:
            model.refresh(batch.sparkSession)
        features = features_with_profiles(
            apply_rules(batch, config), profiles, model.row_id, policy
        )
        write(with_enhanced_flag(model.score(features)), batch_id)

    return fan_out(score_batch)
