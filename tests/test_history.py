"""Hot keys: every skew path must give the plain result, and keep its groups small."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch.functions.clock import epoch_seconds
from tallywatch.operators.features import prepare_features
from tallywatch.operators.history import (
    with_history,
    with_recipient_features,
    with_user_count,
    with_user_stats,
)
from tallywatch.operators.rules import apply_rules
from tallywatch.operators.skew import KeyTable, SkewPolicy, attach, broadcast_if_small
from tallywatch.schema import FEATURES

# Salted joins and collapsed gaps already for a handful of rows.
TINY = SkewPolicy(broadcast_keys=0, hot_rows=20, max_hot_keys=1000)
SHUFFLED = SkewPolicy(broadcast_keys=0)
BROADCAST = SkewPolicy()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one user, a third to the null user; many ties."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        user = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"u{rng.randrange(60)}"
        if i % 9 == 0:
            ts = start + timedelta(days=3, seconds=5, microseconds=i % 4)
        elif i % 50 == 7:
            ts = None
        else:
            ts = start + timedelta(seconds=rng.randrange(10 * 86400) // 4 * 4,
                                   microseconds=rng.randrange(3))
        amount = None if i % 41 == 0 else float(rng.randrange(20000))
        rows.append((i, user, amount, ts, f"r{rng.randrange(5)}", -1.3, 36.8))
    return spark.createDataFrame(
        rows,
        "event_id long, user_id string, amount double, transaction_timestamp timestamp_ntz, "
        "recipient_id string, latitude double, longitude double",
    ).repartition(7).cache()


def by_id(df, *columns):
    result = {}
    for row in df.collect():
        assert row.event_id not in result
        result[row.event_id] = tuple(
            round(row[c], 6) if isinstance(row[c], float) else row[c] for c in columns
        )
    return result


def expected_history(rows):
    user = Window.partitionBy("user_id")
    second = epoch_seconds(F.col("transaction_timestamp"))
    order = user.orderBy("transaction_timestamp", "event_id")
    return rows.select(
        "event_id",
        (second - F.lag(second).over(order)).alias("gap_seconds"),
        F.count("*").over(user).alias("user_transaction_count"),
        F.avg("amount").over(user).alias("user_avg_amount"),
    )


@pytest.mark.parametrize("policy", [TINY, SHUFFLED, BROADCAST])
def test_history_is_exact_under_skew(skewed, policy):
    columns = ["gap_seconds", "user_transaction_count", "user_avg_amount"]
    assert by_id(with_history(skewed, policy=policy), *columns) == by_id(
        expected_history(skewed), *columns
    )


@pytest.mark.parametrize("policy", [TINY, SHUFFLED, BROADCAST])
def test_attached_statistics_are_exact_under_skew(skewed, policy):
    expected = expected_history(skewed)
    columns = ["user_transaction_count", "user_avg_amount"]
    assert by_id(with_user_stats(skewed, policy=policy), *columns) == by_id(expected, *columns)
    assert by_id(with_user_count(skewed, policy=policy), columns[0]) == by_id(
        expected, columns[0]
    )
    pairs = skewed.withColumn(
        "n", F.count("*").over(Window.partitionBy("user_id", "recipient_id"))
    )
    found = with_recipient_features(skewed, policy=policy)
    assert by_id(found, "recipient_frequency") == by_id(pairs, "n")
    assert found.filter((F.col("is_new_recipient") == 1) != (F.col("recipient_frequency") == 1)
                        ).count() == 0


def test_hot_keys_are_found_and_bounded(skewed):
    table = KeyTable(skewed, ["user_id"], policy=TINY)
    assert {r.user_id for r in table.hot.collect()} == {"hot", None}
    assert table.has_hot_keys
    assert not KeyTable(skewed, ["user_id"]).has_hot_keys


def test_salted_join_splits_a_hot_key_and_keeps_unmatched_rows(skewed, spark):
    sizes = KeyTable(skewed, ["user_id"], policy=TINY)
    profiles = spark.createDataFrame([("hot", 1), ("u1", 2)], "user_id string, tier int")
    joined = attach(skewed, profiles, 10**9, sizes, "event_id")
    assert joined.count() == skewed.count()
    tiers = {(r.user_id, r.tier) for r in joined.select("user_id", "tier").distinct().collect()}
    assert ("hot", 1) in tiers and ("u1", 2) in tiers and (None, None) in tiers
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_features_have_no_nulls_and_no_extra_rows(skewed):
    for policy in (TINY, BROADCAST):
        features = prepare_features(apply_rules(skewed), policy=policy)
        assert features.count() == 900
        nulls = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FEATURES]).first()
        assert set(nulls) == {0}


def test_features_without_distance_default_to_zero(skewed):
    features = prepare_features(skewed)
    assert {r[0] for r in features.select("distance_from_nairobi").distinct().collect()} == {0.0}


def test_broadcast_needs_a_small_table(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(spark.range(10), 10))
    assert not hinted(broadcast_if_small(spark.range(11), 10))
