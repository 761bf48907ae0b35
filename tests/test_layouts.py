"""Bucketed histories and daily tables: plans, files read, hot users, growth."""

import re
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallywatch.operators.features import add_feature_columns, prepare_features
from tallywatch.operators.history import with_history
from tallywatch.operators.rules import apply_rules
from tallywatch.operators.skew import SkewPolicy
from tallywatch.plans.tables import orders_as_transactions, transactions
from tallywatch.sources.layouts import (
    HistoryTable,
    on_days,
    read_daily,
    recent_days,
    write_bucketed,
    write_calendar,
    write_daily,
)

COLUMNS = ["event_id", "gap_seconds", "user_transaction_count", "user_avg_amount"]
HOT = SkewPolicy(broadcast_keys=0, hot_rows=60, max_hot_keys=10**6)


def executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def found(df):
    rows = df.withColumn("user_avg_amount", F.round("user_avg_amount", 6)).select(*COLUMNS)
    return {r.event_id: tuple(r) for r in rows.collect()}


@pytest.fixture(scope="module")
def rows(spark, data):
    return apply_rules(transactions(spark, data))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_features_of_a_bucketed_history_shuffle_nothing(spark, rows, tmp_path):
    table = HistoryTable.write(rows, str(tmp_path), buckets=4)
    features = add_feature_columns(table.with_history())
    plan = executed(features)
    assert "Exchange" not in plan and "Window" in plan and "Bucketed: true" in plan
    assert "Exchange hashpartitioning(user_id" in executed(prepare_features(rows))
    assert found(table.with_history()) == found(with_history(rows))


def test_profiles_bucketed_alike_join_in_place(spark, data, tmp_path, no_broadcast):
    orders = orders_as_transactions(spark, data)
    table = HistoryTable.write(orders, str(tmp_path / "orders"), buckets=4)
    profiles = write_bucketed(
        spark.read.parquet(f"{data}/customer.parquet").select(
            F.col("c_custkey").alias("user_id"), "c_mktsegment"),
        f"{table.name}_profiles", str(tmp_path / "profiles"), "user_id", ["user_id"], 4)
    joined = table.with_profiles(profiles, table.split_profiles(profiles))
    plan = executed(joined)
    assert "Exchange" not in plan and re.search("SortMergeJoin|ShuffledHashJoin", plan)
    assert joined.count() == orders.count() == joined.filter("c_mktsegment IS NOT NULL").count()


def test_hot_users_are_kept_beside_the_buckets(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"u{i % 20}", None if i % 11 == 0 else float(i),
          datetime(2024, 1, 1 + i % 9, i % 24, 0, i % 7)) for i in range(300)]
        + [(900, None, 3.0, datetime(2024, 1, 2)), (901, "late", 1.0, None)],
        "event_id long, user_id string, amount double, transaction_timestamp timestamp_ntz")
    table = HistoryTable.write(rows, str(tmp_path / "t"), buckets=3, policy=HOT)
    assert table.has_hot_users and table.hot.select("user_id").distinct().count() == 1
    assert table.ordinary.filter("user_id = 'hot'").count() == 0
    assert found(table.with_history()) == found(with_history(rows))
    profiles = write_bucketed(
        spark.createDataFrame([("hot", 1), ("u3", 2), ("none", 3)], "user_id string, level int"),
        f"{table.name}_p", str(tmp_path / "p"), "user_id", ["user_id"], 3)
    joined = table.with_profiles(profiles, table.split_profiles(profiles))
    plain = rows.join(profiles, "user_id", "left").select("event_id", "level")
    assert sorted(joined.select("event_id", "level").collect()) == sorted(plain.collect())
    more = spark.createDataFrame(
        [(1000, "hot", 5.0, datetime(2024, 2, 1)), (1001, "u3", 6.0, datetime(2024, 2, 1)),
         (1002, "new", 7.0, datetime(2024, 2, 1))], rows.schema)
    table.append(more)
    assert found(table.with_history()) == found(with_history(rows.unionByName(more)))
    again = HistoryTable.open(spark.newSession(), str(tmp_path / "t"), buckets=3)
    assert found(again.with_history()) == found(with_history(rows.unionByName(more)))


def test_empty_history(spark, rows, tmp_path):
    table = HistoryTable.write(rows.limit(0), str(tmp_path), buckets=2)
    assert table.with_history().collect() == []


@pytest.fixture(scope="module")
def daily(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily"))
    timeless = rows.filter("event_id = 5").withColumn(
        "transaction_timestamp", F.lit(None).cast("timestamp_ntz")).withColumn(
        "event_id", F.lit(-1).cast("long"))
    write_daily(rows.unionByName(timeless), f"{path}/rows")
    write_calendar(read_daily(spark, f"{path}/rows"), f"{path}/calendar")
    return path


def days_read(df):
    files = df.select(F.input_file_name().alias("f")).distinct().collect()
    return {re.search(r"day=([^/]+)", r.f).group(1) for r in files}


def test_a_constant_filter_skips_folders(spark, daily):
    recent = recent_days(read_daily(spark, f"{daily}/rows"), datetime(2024, 1, 20), days=3)
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-17", executed(recent))
    pruned = read_daily(spark, f"{daily}/rows").filter(F.col("day") >= date(2024, 1, 17))
    all_days = {r.day for r in spark.read.parquet(f"{daily}/calendar").collect()}
    assert days_read(pruned) == {str(d) for d in all_days if d >= date(2024, 1, 17)}
    scanned = [n for n in pruned.inputFiles()]
    assert all("day=" in n for n in scanned)


def test_a_calendar_skips_folders_at_run_time(spark, daily, tmp_path):
    shutil.copytree(f"{daily}/rows", tmp_path / "rows")
    calendar = spark.read.parquet(f"{daily}/calendar").filter("day_of_month >= 25")
    rows = read_daily(spark, str(tmp_path / "rows"))
    chosen = on_days(rows, calendar)
    expected = rows.filter("day(day) >= 25").count()
    wanted = {str(r.day) for r in calendar.collect()}
    # whoever opens a file of another day fails
    for folder in (tmp_path / "rows").glob("day=*"):
        if folder.name.removeprefix("day=") not in wanted:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"junk" * 100)
            for file in folder.glob(".*.crc"):
                file.unlink()
    assert "dynamicpruningexpression" in executed(chosen)
    assert chosen.count() == expected > 0 and 0 < len(wanted) < 10
    with pytest.raises(Exception, match="(?i)parquet|junk|read"):
        on_days(rows, spark.read.parquet(f"{daily}/calendar")).collect()


def test_rows_without_time_have_their_own_folder(spark, daily, rows):
    whole = read_daily(spark, f"{daily}/rows")
    assert whole.filter("day IS NULL").select("event_id").collect() == [(-1,)]
    assert whole.count() == rows.count() + 1
