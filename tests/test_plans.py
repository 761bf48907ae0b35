"""Physical plans: pushdown, pruning, shuffles and code generation."""

import re
from datetime import datetime

import pytest

from tallywatch.operators.metrics import date_histogram
from tallywatch.operators.skew import KeyTable, attach
from tallywatch.plans import catalog
from tallywatch.session import fresh_path, materialize, remove_tables, shared_dir


def executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def read_columns(plan):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)))


@pytest.mark.parametrize("name, columns", [
    ("hourly_metrics", {"event_id", "ts", "value"}),
    ("dataset_stats", {"value"}),
    ("repeat_users", {"user_id"}),
    ("user_frequency", {"user_id", "ts"}),
    ("train_split", {"event_id"}),
])
def test_scans_read_only_needed_columns(spark, data, name, columns):
    assert read_columns(executed(catalog.QUERIES[name](spark, data))) == columns


def test_time_filter_reaches_the_scan(spark, data):
    plan = executed(catalog.recent_transactions(spark, data))
    assert "GreaterThan(ts,2024-01-24" in plan


@pytest.mark.parametrize("name", ["hourly_metrics", "user_frequency", "fraud_rate"])
def test_aggregates_are_partial_before_the_shuffle(spark, data, name):
    plan = executed(catalog.QUERIES[name](spark, data))
    assert "partial_count" in plan and "EvalPython" not in plan


def test_features_need_one_shuffle_of_the_rows(spark, data):
    plan = executed(catalog.feature_table(spark, data))
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", plan)) == 1
    assert "EvalPython" not in plan


@pytest.mark.parametrize("name", ["user_stats", "user_count_join", "amount_deviation"])
def test_few_users_are_broadcast_and_rows_stay_in_place(spark, data, name):
    plan = executed(catalog.QUERIES[name](spark, data))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(user_id" not in plan


@pytest.mark.parametrize("name", ["fraud_hotspots", "alert_list", "top_fraud_users"])
def test_top_k_is_not_a_full_sort(spark, data, name):
    assert "TakeOrderedAndProject" in executed(catalog.QUERIES[name](spark, data))


def test_each_row_is_scored_once(spark, data):
    scored = catalog.hybrid_scores(spark, data)
    assert executed(scored.filter("is_enhanced_fraud")).count("ArrowEvalPython") == 1
    importance = executed(catalog.feature_importance(spark, data))
    assert importance.count("ArrowEvalPython") == 1


def test_scaling_computes_the_windows_once(spark, data):
    """Features are stored first, so the plan that scales has no window, sort or shuffle of rows."""
    plan = executed(catalog.scaled_features(spark, data))
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_many_keys_take_a_window_and_are_not_broadcast(spark, data):
    plan = executed(catalog.recipient_features(spark, data))
    assert "Window" in plan and "BroadcastHashJoin" not in plan


def test_key_sizes_are_not_read_for_a_certain_broadcast(spark, data):
    rows = catalog.orders_as_transactions(spark, data)
    sizes = KeyTable(rows, ["user_id"])
    attach(rows, rows.select("user_id").distinct().limit(10), 10, sizes, "event_id").collect()
    assert "_sizes" not in vars(sizes)


@pytest.mark.parametrize("name", ["date_histogram", "volume_vs_expected"])
def test_hours_are_not_gathered_in_one_task(spark, data, name):
    """The only single rows are the first and last hour, and the mean."""
    plan = executed(catalog.QUERIES[name](spark, data))
    assert "Window" not in plan
    for found in re.finditer(r"Exchange SinglePartition", plan):
        below = plan[found.end():].splitlines()[1:4]
        assert any("partial_" in line for line in below), below


def test_a_stray_date_can_be_left_out(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5), 1.0), (datetime(2024, 1, 1, 8), 2.0),
         (datetime(2124, 1, 1), 3.0), (None, 9.0)],
        "transaction_timestamp timestamp_ntz, amount double")
    kept = date_histogram(rows, last=datetime(2030, 1, 1)).orderBy("hour_start").collect()
    assert [(r.hour_start.hour, r.doc_count, r.total_volume) for r in kept] == [
        (5, 1, 1.0), (6, 0, 0.0), (7, 0, 0.0), (8, 1, 2.0)]
    assert date_histogram(rows).count() == 876_572
    assert date_histogram(rows.filter("false")).collect() == []


def test_no_query_has_a_cross_join(spark, data):
    for name in ("broadcast_rules", "scaled_features", "volume_vs_expected", "profile_lookup"):
        plan = executed(catalog.QUERIES[name](spark, data))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_stored_tables_prune_columns_and_can_be_removed(spark):
    stored = materialize(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert read_columns(executed(stored.select("twice"))) == {"twice"}
    folder = fresh_path(spark, "gone")
    spark.range(3).write.parquet(folder)
    remove_tables(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)
