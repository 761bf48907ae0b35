"""Every operator as a named query over the given tables.

Each query takes a session and a table folder and returns flat columns. The matching SQL is
in ``oracle.py`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions import clock
from tallywatch.functions.geo import distance_km, masked_location
from tallywatch.functions.hashing import in_training_split
from tallywatch.functions.rules import below_score, newer_than, reasons
from tallywatch.operators import evaluation, history, metrics, quality
from tallywatch.operators.features import (
    add_feature_columns,
    add_missing_features,
    fill_features,
    prepare_features,
    scale_features,
    with_calendar,
)
from tallywatch.operators.forest import fit_nodes
from tallywatch.operators.model import AnomalyModel
from tallywatch.operators.quantile import bracket_from, column_sketches, exact_quantile
from tallywatch.operators.rules import apply_rule_table, apply_rules, flagged, search
from tallywatch.operators.skew import KeyTable, attach
from tallywatch.plans.scoring import (
    hybrid_scoring,
    join_scores,
    train_model,
    train_test_split,
    with_enhanced_flag,
)
from tallywatch.plans.tables import (
    orders_as_transactions,
    read_table,
    transaction_stream,
    transactions,
    wire_columns,
)
from tallywatch.schema import DEFAULT_CONFIG, FEATURES
from tallywatch.session import STATE_STORE, fresh_path, ship_package
from tallywatch.sinks.committed import read_documents, stream_documents
from tallywatch.sinks.documents import flagged_documents, hourly_documents
from tallywatch.sinks.records import append_jsonl, keyed_records
from tallywatch.sources.files import read_jsonl, read_lookup_table
from tallywatch.sources.layouts import (
    HistoryTable,
    on_days,
    read_daily,
    recent_days,
    write_bucketed,
    write_calendar,
    write_daily,
)
from tallywatch.sources.parse import parse_records, slim
from tallywatch.streaming.figures import StreamFigures, observed
from tallywatch.streaming.causal import stage_writer, staged_features
from tallywatch.streaming.stateful import END, causal_stream, with_heartbeats, write_heartbeat
from tallywatch.streaming.queries import (
    alert_stream,
    frequency_stream,
    hourly_stream,
    open_windows,
    read_changes,
    read_snapshot,
    snapshot_writer,
    start,
)

Query = Callable[[SparkSession, str], DataFrame]

# On these tables 60-second windows never exceed the limit, so windows are a day long.
DAILY = replace(DEFAULT_CONFIG, window="1 day", slide="12 hours")
AS_OF = datetime(2024, 1, 31)
LAST_UPDATE = datetime(2024, 1, 29)
RULE_COLUMNS = [
    "distance_from_nairobi", "is_high_amount", "is_location_outlier", "is_flagged"
]


def _ruled(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(transactions(spark, folder))


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- parsing and shaping -------------------------------------------------------------------


def json_parse(spark, folder):
    rows = wire_columns(transactions(spark, folder))
    records = keyed_records(rows).select(
        F.encode("value", "UTF-8").alias("value"), F.current_timestamp().alias("timestamp")
    )
    return parse_records(records).select(
        "user_id", "amount", "timestamp", "type", "latitude", "longitude",
        F.col("transaction_timestamp").cast("timestamp_ntz").alias("transaction_timestamp"),
    )


def jsonl_scan(spark, folder):
    """Writes the records as JSON lines with every 50th cut short, and reads them back."""
    path = fresh_path(spark, "jsonl")
    rows = wire_columns(transactions(spark, folder))
    append_jsonl(rows.filter(F.col("event_id") % 50 != 0), path)
    cut = keyed_records(rows.filter(F.col("event_id") % 50 == 0)).select(
        F.expr("left(value, length(value) - 3)").alias("value")
    )
    cut.write.mode("append").text(path)
    return read_jsonl(spark, path).select(
        "user_id", "amount", "timestamp", "type",
        F.col("location.lat").alias("latitude"), F.col("location.long").alias("longitude"),
    )


def keyed_json_records(spark, folder):
    return keyed_records(wire_columns(transactions(spark, folder)))


def slim_projection(spark, folder):
    rows = transactions(spark, folder).withColumn("kafka_timestamp", F.current_timestamp())
    return slim(rows).select("event_id", "user_id", "amount", "transaction_timestamp", "type")


def geo_mask(spark, folder):
    rows = transactions(spark, folder).select(
        "event_id", masked_location(F.col("event_id")).alias("location")
    )
    return rows.select(
        "event_id",
        F.col("location.lat").alias("latitude"),
        F.col("location.long").alias("longitude"),
    )


def feature_backfill(spark, folder):
    partial = with_calendar(transactions(spark, folder)).withColumn(
        "distance_from_nairobi",
        F.when(F.col("latitude").isNotNull(), distance_km(F.col("latitude"), F.col("longitude"))),
    )
    return fill_features(add_missing_features(partial)).select("event_id", *FEATURES)


def flagged_docs(spark, folder):
    return _flat(flagged_documents(flagged(_ruled(spark, folder)), "event_id"))


def flagged_docs_committed(spark, folder):
    """The same from the stream sink that commits batches."""
    path = fresh_path(spark, "documents")
    stream = flagged_documents(alert_stream(transaction_stream(spark, folder)), "event_id")
    writer = stream_documents(stream, f"{path}/data")
    start(writer, f"{path}/checkpoint", None, available_now=True).awaitTermination()
    return _flat(read_documents(spark, f"{path}/data", stream.schema))


def _flat(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("_id").alias("doc_id"), "user_id", "amount", "transaction_timestamp",
        F.col("location.lat").alias("location_lat"), F.col("location.lon").alias("location_lon"),
        "latitude", "longitude", "type", "is_flagged", "is_high_amount", "is_location_outlier",
        "distance_from_nairobi", "document_type",
    )


def hourly_docs(spark, folder):
    documents = hourly_documents(metrics.hourly_metrics(_ruled(spark, folder)), stamped=False)
    return _rounded(
        documents.withColumnRenamed("_id", "doc_id"), 2, "total_volume", "avg_amount"
    )


# -- rules ---------------------------------------------------------------------------------


def haversine_distance(spark, folder):
    return _ruled(spark, folder).select("event_id", "distance_from_nairobi")


def rule_flags(spark, folder):
    return _ruled(spark, folder).select("event_id", *RULE_COLUMNS)


def flagged_transactions(spark, folder):
    return flagged(_ruled(spark, folder)).select(
        "event_id", "user_id", "amount", "transaction_timestamp", *RULE_COLUMNS
    )


def calendar_features(spark, folder):
    return with_calendar(transactions(spark, folder)).select(
        "event_id", "hour_of_day", "day_of_week", "day_of_month",
        "is_weekend", "is_business_hours", "is_end_of_month",
    )


def volume_multiplier(spark, folder):
    return transactions(spark, folder).select(
        "event_id",
        F.round(clock.volume_multiplier(F.col("transaction_timestamp")), 6).alias("multiplier"),
    )


def alert_reasons(spark, folder):
    features = prepare_features(_ruled(spark, folder))
    return features.select(
        "event_id",
        F.concat_ws(";", reasons()).alias("reasons"),
        F.concat_ws(";", reasons(F.col("gap_seconds").isNotNull())).alias("history_reasons"),
    )


def recent_transactions(spark, folder):
    rows = transactions(spark, folder)
    return rows.filter(newer_than(F.col("transaction_timestamp"), AS_OF)).select(
        "event_id", "user_id", "amount", "transaction_timestamp"
    )


def document_search(spark, folder):
    documents = flagged_documents(flagged(_ruled(spark, folder)), "event_id")
    found = search(documents, document_type="flagged_transaction", is_location_outlier=True)
    return found.select(
        F.col("_id").alias("doc_id"), "user_id", "amount", "is_high_amount", "document_type"
    )


def _synthetic_scores(rows: DataFrame) -> DataFrame:
    """A score of every row that SQL can compute too."""
    score = F.round(F.lit(0.1) - (F.col("event_id") % 20) / F.lit(100.0), 4)
    return rows.select(
        "event_id", score.alias("ml_anomaly_score"), (score < 0).alias("is_ml_anomaly")
    )


def score_threshold(spark, folder):
    scores = _synthetic_scores(transactions(spark, folder))
    return scores.filter(below_score(F.col("ml_anomaly_score"), -0.05)).select(
        "event_id", "ml_anomaly_score"
    )


# -- joins ---------------------------------------------------------------------------------


def _rules_and_scores(spark, folder):
    ruled = _ruled(spark, folder)
    # the left join is about rows without a score: every third has none
    scores = _synthetic_scores(ruled.filter(F.col("event_id") % 3 != 0))
    return join_scores(ruled, scores)


def rules_scores_left_join(spark, folder):
    return _rules_and_scores(spark, folder).select(
        "event_id", "is_flagged", "ml_anomaly_score", "is_ml_anomaly"
    )


def enhanced_flag(spark, folder):
    return with_enhanced_flag(_rules_and_scores(spark, folder)).select(
        "event_id", "is_flagged", "is_ml_anomaly", "is_enhanced_fraud"
    )


def user_count_join(spark, folder):
    return history.with_user_count(transactions(spark, folder)).select(
        "event_id", "user_id", "user_transaction_count"
    )


def broadcast_rules(spark, folder):
    """The rules are written and read as the lookup table that a user would keep."""
    path = fresh_path(spark, "rules")
    spark.createDataFrame(
        [("high_amount", "amount", 10000.0), ("very_high_amount", "amount", 30000.0),
         ("location_outlier", "distance_km", 50.0)],
        "rule_id string, measure string, threshold double",
    ).coalesce(1).write.parquet(path)
    rules = read_lookup_table(spark, path, cache=False)
    return apply_rule_table(_ruled(spark, folder), rules, ["event_id"])


def profile_lookup(spark, folder):
    """Orders as transactions with the customer's profile."""
    rows = orders_as_transactions(spark, folder)
    profiles = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey"
    )
    sizes = KeyTable(rows, ["user_id"])
    return attach(rows, profiles, profiles.count(), sizes, "event_id").select(
        "event_id", "user_id", "amount", "c_mktsegment", "c_nationkey"
    )


# -- aggregates ----------------------------------------------------------------------------


def user_window_counts(spark, folder):
    return metrics.user_window_counts(transactions(spark, folder), DAILY)


def user_frequency(spark, folder):
    return metrics.frequent_users(transactions(spark, folder), DAILY)


def hourly_metrics(spark, folder):
    return _rounded(
        metrics.hourly_metrics(_ruled(spark, folder)), 2, "total_volume", "avg_amount"
    )


def hourly_chart(spark, folder):
    return _rounded(metrics.hourly_chart(_ruled(spark, folder)), 2, "total_volume", "avg_amount")


def fraud_type_breakdown(spark, folder):
    return metrics.fraud_type_breakdown(_ruled(spark, folder))


def fraud_rate(spark, folder):
    return _rounded(metrics.fraud_rate(_ruled(spark, folder)), 6, "fraud_rate")


def date_histogram(spark, folder):
    return _rounded(metrics.date_histogram(transactions(spark, folder)), 2, "total_volume")


def top_fraud_users(spark, folder):
    return _rounded(metrics.top_users(_ruled(spark, folder)), 2, "total_amount")


def volume_vs_expected(spark, folder):
    return _rounded(
        metrics.volume_vs_expected(transactions(spark, folder)),
        6, "expected_count", "volume_ratio",
    ).select("hour_start", "doc_count", "expected_count", "volume_ratio")


def dataset_stats(spark, folder):
    return _rounded(metrics.dataset_stats(transactions(spark, folder)), 6, "high_amount_pct")


def score_stats(spark, folder):
    return _rounded(
        evaluation.score_stats(_synthetic_scores(transactions(spark, folder))),
        6, "mean_score", "std_score", "anomaly_rate",
    )


def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_ruled(spark, folder), prediction="is_flagged")


def classification_report(spark, folder):
    return _rounded(
        evaluation.classification_report(_ruled(spark, folder), prediction="is_flagged"),
        6, "precision", "recall", "f1_score",
    )


def binary_quality(spark, folder):
    return _rounded(
        evaluation.binary_quality(_ruled(spark, folder), prediction="is_flagged"),
        6, "accuracy", "precision", "recall", "f1_score",
    )


def repeat_users(spark, folder):
    return metrics.repeat_users(transactions(spark, folder))


def data_quality(spark, folder):
    rules = quality.quality_rules(allowed_types=("purchase", "view", "click", "signup"))
    return quality.quality_report(wire_columns(transactions(spark, folder)), rules)


def false_positive_by_segment(spark, folder):
    return _rounded(
        evaluation.false_positive_by_segment(_ruled(spark, folder), "type"),
        6, "false_positive_rate",
    )


# -- history and features ------------------------------------------------------------------


def time_since_last(spark, folder):
    return history.with_history(transactions(spark, folder)).select(
        "event_id",
        F.round(history.gap_hours(F.col("gap_seconds")), 6).alias("time_since_last_txn"),
    )


def gap_seconds(spark, folder):
    return history.with_history(transactions(spark, folder)).select("event_id", "gap_seconds")


def user_stats(spark, folder):
    return _rounded(
        history.with_user_stats(transactions(spark, folder)), 6, "user_avg_amount"
    ).select("event_id", "user_id", "user_transaction_count", "user_avg_amount")


def amount_deviation(spark, folder):
    deviation = history.relative_deviation(F.col("amount"), F.col("user_avg_amount"))
    return history.with_user_stats(transactions(spark, folder)).select(
        "event_id", F.round(deviation, 6).alias("amount_deviation")
    )


def recipient_features(spark, folder):
    return history.with_recipient_features(transactions(spark, folder)).select(
        "event_id", "recipient_id", "recipient_frequency", "is_new_recipient"
    )


def feature_table(spark, folder):
    return _rounded(
        prepare_features(_ruled(spark, folder)),
        6, "distance_from_nairobi", "user_avg_amount", "amount_deviation", "time_since_last_txn",
    ).select("event_id", *FEATURES)


def scaled_features(spark, folder):
    features = prepare_features(_ruled(spark, folder)).select("event_id", *FEATURES)
    return _rounded(scale_features(features), 5, *FEATURES)


def feature_table_bucketed(spark, folder):
    """The feature table from a history that is bucketed by user."""
    path = fresh_path(spark, "history")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    history = HistoryTable.write(_ruled(spark, folder), path, buckets=buckets)
    return _rounded(
        add_feature_columns(history.with_history()),
        6, "distance_from_nairobi", "user_avg_amount", "amount_deviation", "time_since_last_txn",
    ).select("event_id", *FEATURES)


def profile_lookup_bucketed(spark, folder):
    """Orders and customers in as many buckets of the customer each."""
    path = fresh_path(spark, "orders")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    history = HistoryTable.write(orders_as_transactions(spark, folder), path, buckets=buckets)
    profiles = write_bucketed(
        read_table(spark, folder, "customer").select(
            F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey"),
        f"{history.name}_profiles", f"{path}/profiles", "user_id", ["user_id"], buckets)
    return history.with_profiles(profiles, history.split_profiles(profiles)).select(
        "event_id", "user_id", "amount", "c_mktsegment", "c_nationkey"
    )


def _daily(spark, folder) -> str:
    path = fresh_path(spark, "daily")
    write_daily(_ruled(spark, folder), f"{path}/rows")
    return path


def recent_transactions_daily(spark, folder):
    """Recent transactions from a table partitioned by day."""
    rows = read_daily(spark, f"{_daily(spark, folder)}/rows")
    return recent_days(rows, AS_OF).select("event_id", "user_id", "amount", "transaction_timestamp")


def hourly_metrics_month_end(spark, folder):
    """Hourly totals of the days that a calendar table calls month end."""
    path = _daily(spark, folder)
    rows = read_daily(spark, f"{path}/rows")
    write_calendar(rows, f"{path}/calendar")
    calendar = spark.read.parquet(f"{path}/calendar").filter("day_of_month >= 25")
    return _rounded(
        metrics.hourly_metrics(on_days(rows, calendar)), 2, "total_volume", "avg_amount")


def date_histogram_daily(spark, folder):
    """The histogram of one week, from a table partitioned by day."""
    rows = read_daily(spark, f"{_daily(spark, folder)}/rows")
    return _rounded(metrics.date_histogram(recent_days(rows, AS_OF)), 2, "total_volume")


# -- top-k, split, cuts --------------------------------------------------------------------


def fraud_hotspots(spark, folder):
    return metrics.hotspots(_ruled(spark, folder)).select(
        "event_id", "user_id", "amount", "distance_from_nairobi"
    )


def alert_list(spark, folder):
    return metrics.alert_list(_ruled(spark, folder)).select(
        "event_id", "user_id", "amount", "is_high_amount", "is_location_outlier"
    )


def train_split(spark, folder):
    return transactions(spark, folder).select(
        "event_id", in_training_split(F.col("event_id")).alias("is_training")
    )


def retrain_decision(spark, folder):
    return _rounded(
        evaluation.retrain_decision(
            _ruled(spark, folder), LAST_UPDATE, AS_OF, prediction="is_flagged"
        ),
        6, "accuracy",
    )


def contamination_cut(spark, folder):
    """The exact 10 % quantile of the amounts, and the rows below it."""
    rows = transactions(spark, folder)
    return _cut(rows, exact_quantile(rows, "amount", 0.1))


def _cut(rows: DataFrame, cut: float | None) -> DataFrame:
    return rows.agg(
        F.round(F.lit(cut).cast("double"), 6).alias("amount_cut"),
        F.count_if(F.col("amount") < F.lit(cut)).alias("below_cut"),
    )


def contamination_cut_narrowed(spark, folder):
    """The same through the rounds that large columns take."""
    rows = transactions(spark, folder)
    return _cut(rows, exact_quantile(rows, "amount", 0.1, small=500))


def contamination_cut_sketched(spark, folder):
    """The same from stored sketches, one per day, and one scan that confirms it."""
    path = fresh_path(spark, "sketches")
    rows = transactions(spark, folder)
    daily = rows.withColumn("day", F.to_date("transaction_timestamp"))
    column_sketches(daily, "amount", "day").write.parquet(path)
    bracket = bracket_from(spark.read.parquet(path), 0.1)
    return _cut(rows, exact_quantile(rows, "amount", 0.1, small=500, bracket=bracket))


# -- streams -------------------------------------------------------------------------------


def alert_stream_result(spark, folder):
    path = fresh_path(spark, "alerts")
    writer = alert_stream(transaction_stream(spark, folder)).writeStream.outputMode("append")
    start(
        writer.format("parquet").option("path", f"{path}/data"), f"{path}/checkpoint", None, True
    ).awaitTermination()
    return spark.read.parquet(f"{path}/data").select(
        "event_id", "user_id", "amount", *RULE_COLUMNS
    )


def _complete_result(spark, stream: DataFrame, label: str) -> DataFrame:
    path = fresh_path(spark, label)
    writer = stream.writeStream.outputMode("complete").foreachBatch(
        snapshot_writer(f"{path}/data")
    )
    start(writer, f"{path}/checkpoint", None, available_now=True).awaitTermination()
    return read_snapshot(spark, f"{path}/data")


def frequency_stream_result(spark, folder):
    stream = frequency_stream(transaction_stream(spark, folder), DAILY)
    return _complete_result(spark, stream, "frequency").withColumns({
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz"),
    })


def frequency_updates_result(spark, folder):
    """The same in update mode: closed windows leave the state, which RocksDB holds."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    path = fresh_path(spark, "updates")
    stream = frequency_stream(transaction_stream(session, folder), DAILY, watermark="400 days")
    writer = stream.writeStream.outputMode("update").foreachBatch(
        snapshot_writer(f"{path}/data")
    )
    start(writer, f"{path}/checkpoint", None, available_now=True).awaitTermination()
    found = read_changes(
        spark, f"{path}/data", ["window_start", "window_end", "user_id"]
    )
    return found.withColumns({
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz"),
    })


def _state_session(spark: SparkSession) -> SparkSession:
    """A session with state in RocksDB, and as many partitions as the given one: each holds a
    store of its own."""
    session = spark.newSession()
    partitions = "spark.sql.shuffle.partitions"
    session.conf.set(partitions, spark.conf.get(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return session


def frequency_state(spark, folder):
    """The open windows that a stopped stream has left in its checkpoint, with their counts."""
    session = _state_session(spark)
    path = fresh_path(spark, "state")
    stream = frequency_stream(transaction_stream(session, folder), DAILY, watermark="400 days")
    writer = stream.writeStream.outputMode("update").foreachBatch(
        snapshot_writer(f"{path}/data")
    )
    start(writer, f"{path}/checkpoint", None, available_now=True).awaitTermination()
    return open_windows(session, f"{path}/checkpoint").withColumns({
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz"),
    })


def hourly_stream_result(spark, folder):
    return _rounded(
        _complete_result(spark, hourly_stream(transaction_stream(spark, folder)), "hourly"),
        2, "total_volume", "avg_amount",
    )


def causal_user_features(spark, folder):
    path = fresh_path(spark, "causal")
    writer = transaction_stream(spark, folder).writeStream.foreachBatch(
        stage_writer(f"{path}/rows")
    )
    start(writer, f"{path}/checkpoint", None, available_now=True).awaitTermination()
    return _rounded(staged_features(spark, f"{path}/rows"), 6, "user_avg_so_far")


def data_quality_stream(spark, folder):
    """The quality report from the counters of the stream that writes the records."""
    rules = quality.quality_rules(allowed_types=("purchase", "view", "click", "signup"))
    path = fresh_path(spark, "observed")
    rows = observed(wire_columns(transaction_stream(spark, folder)), rules)
    query = start(
        rows.writeStream.outputMode("append").format("parquet").option("path", f"{path}/data"),
        f"{path}/checkpoint", None, available_now=True)
    query.awaitTermination()
    return StreamFigures().take(query).quality_report(spark).drop("query")


def causal_user_features_stateful(spark, folder):
    """The same from the stream's own state: one run over the rows, and a second one, from its
    checkpoint, that a last heartbeat lets give out the rows still waiting."""
    session = _state_session(spark)
    path = fresh_path(spark, "stateful")
    write_heartbeat(session, f"{path}/beats")

    def drain() -> None:
        rows = with_heartbeats(transaction_stream(session, folder), f"{path}/beats")
        writer = causal_stream(rows, "400 days").writeStream.outputMode("append")
        start(
            writer.format("parquet").option("path", f"{path}/data"), f"{path}/checkpoint", None,
            available_now=True,
        ).awaitTermination()

    drain()
    write_heartbeat(session, f"{path}/beats", END)
    drain()
    return _rounded(spark.read.parquet(f"{path}/data"), 6, "user_avg_so_far")


# -- model ---------------------------------------------------------------------------------

def _trained(spark: SparkSession, folder: str) -> tuple[AnomalyModel, DataFrame]:
    """Model and test features."""
    ship_package(spark)
    return train_model(transactions(spark, folder), AnomalyModel())


def forest_nodes(spark, folder):
    """The fitted trees, straight from the tasks that grow them."""
    ship_package(spark)
    training, _ = train_test_split(prepare_features(_ruled(spark, folder)))
    return _rounded(fit_nodes(training, training.count(), "event_id"), 6, "threshold")


def forest_leaf_sizes(spark, folder):
    """Each tree's leaves hold its whole sample."""
    leaves = forest_nodes(spark, folder).filter("feature < 0")
    return leaves.groupBy("tree_id").agg(F.sum("n_samples").alias("n_samples"))


def explanation_features(spark, folder):
    """Reasons and feature values that explanations carry, without the scores."""
    model, _ = _trained(spark, folder)
    explained = model.explain(prepare_features(_ruled(spark, folder)))
    values = explained.select(
        "event_id", F.concat_ws(";", "explanations").alias("reasons"), "feature_values.*"
    )
    return _rounded(
        values, 6, "distance_from_nairobi", "user_avg_amount", "amount_deviation",
        "time_since_last_txn",
    )


def hybrid_rule_flags(spark, folder):
    """What hybrid scoring says without its model part."""
    model, _ = _trained(spark, folder)
    scored = hybrid_scoring(transactions(spark, folder), model)
    consistent = F.col("is_enhanced_fraud") == (F.col("is_flagged") | F.col("is_ml_anomaly"))
    return scored.select("event_id", "is_flagged", consistent.alias("is_consistent"))


def training_anomaly_share(spark, folder):
    """The flagged share of the training rows, in whole percent."""
    model, _ = _trained(spark, folder)
    training, _ = train_test_split(prepare_features(_ruled(spark, folder)))
    return model.score(training).agg(
        F.round(100 * F.avg(F.col("is_ml_anomaly").cast("int")), 0).alias("anomaly_percent"),
        F.count("*").alias("n_rows"),
    )


def forest_scores(spark, folder):
    model, _ = _trained(spark, folder)
    return _rounded(model.score(prepare_features(_ruled(spark, folder))).select(
        "event_id", "ml_anomaly_score", "is_ml_anomaly"
    ), 9, "ml_anomaly_score")


def forest_scores_compiled(spark, folder):
    """The same by SQL expressions alone, from a forest read back from its stored node table;
    with the exact sum of path lengths."""
    model, _ = _trained(spark, folder)
    stored = AnomalyModel(fresh_path(spark, "model"))
    model.path = stored.path
    model.save(spark)
    if not stored.load(spark):
        raise ValueError(f"no model at {stored.path}")
    scored = stored.score(
        prepare_features(_ruled(spark, folder)), compiled=True, paths="path_sum")
    return _rounded(scored.select(
        "event_id", "path_sum", "ml_anomaly_score", "is_ml_anomaly"), 9, "ml_anomaly_score")


def model_evaluation(spark, folder):
    model, test = _trained(spark, folder)
    return _rounded(
        model.evaluate(test)["classification_report"], 6, "precision", "recall", "f1_score")


def feature_importance(spark, folder):
    model, test = _trained(spark, folder)
    return _rounded(model.importance(test), 6, "importance")


def explain_anomalies(spark, folder):
    model, _ = _trained(spark, folder)
    explained = model.explain(prepare_features(_ruled(spark, folder)))
    return _rounded(_rounded(explained.select(
        "event_id", "is_anomaly", "anomaly_score",
        F.concat_ws(";", "explanations").alias("explanations"), "feature_values.*",
    ), 9, "anomaly_score"), 6, *FEATURES)


def hybrid_scores(spark, folder):
    model, _ = _trained(spark, folder)
    return _rounded(hybrid_scoring(transactions(spark, folder), model).select(
        "event_id", "is_flagged", "ml_anomaly_score", "is_ml_anomaly", "is_enhanced_fraud"
    ), 9, "ml_anomaly_score")


QUERIES: dict[str, Query] = {
    "json_parse": json_parse,
    "jsonl_scan": jsonl_scan,
    "keyed_json_records": keyed_json_records,
    "slim_projection": slim_projection,
    "geo_mask": geo_mask,
    "feature_backfill": feature_backfill,
    "flagged_documents": flagged_docs,
    "flagged_documents_committed": flagged_docs_committed,
    "hourly_documents": hourly_docs,
    "haversine_distance": haversine_distance,
    "rule_flags": rule_flags,
    "flagged_transactions": flagged_transactions,
    "calendar_features": calendar_features,
    "volume_multiplier": volume_multiplier,
    "alert_reasons": alert_reasons,
    "recent_transactions": recent_transactions,
    "document_search": document_search,
    "score_threshold": score_threshold,
    "rules_scores_left_join": rules_scores_left_join,
    "enhanced_flag": enhanced_flag,
    "user_count_join": user_count_join,
    "broadcast_rules": broadcast_rules,
    "profile_lookup": profile_lookup,
    "user_window_counts": user_window_counts,
    "user_frequency": user_frequency,
    "hourly_metrics": hourly_metrics,
    "hourly_chart": hourly_chart,
    "fraud_type_breakdown": fraud_type_breakdown,
    "fraud_rate": fraud_rate,
    "date_histogram": date_histogram,
    "top_fraud_users": top_fraud_users,
    "volume_vs_expected": volume_vs_expected,
    "dataset_stats": dataset_stats,
    "score_stats": score_stats,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "binary_quality": binary_quality,
    "repeat_users": repeat_users,
    "data_quality": data_quality,
    "false_positive_by_segment": false_positive_by_segment,
    "time_since_last": time_since_last,
    "gap_seconds": gap_seconds,
    "user_stats": user_stats,
    "amount_deviation": amount_deviation,
    "recipient_features": recipient_features,
    "feature_table": feature_table,
    "scaled_features": scaled_features,
    "feature_table_bucketed": feature_table_bucketed,
    "profile_lookup_bucketed": profile_lookup_bucketed,
    "recent_transactions_daily": recent_transactions_daily,
    "hourly_metrics_month_end": hourly_metrics_month_end,
    "date_histogram_daily": date_histogram_daily,
    "fraud_hotspots": fraud_hotspots,
    "alert_list": alert_list,
    "train_split": train_split,
    "retrain_decision": retrain_decision,
    "contamination_cut": contamination_cut,
    "contamination_cut_narrowed": contamination_cut_narrowed,
    "contamination_cut_sketched": contamination_cut_sketched,
    "alert_stream": alert_stream_result,
    "frequency_stream": frequency_stream_result,
    "frequency_updates": frequency_updates_result,
    "frequency_state": frequency_state,
    "hourly_stream": hourly_stream_result,
    "data_quality_stream": data_quality_stream,
    "causal_user_features": causal_user_features,
    "causal_user_features_stateful": causal_user_features_stateful,
    "forest_nodes": forest_nodes,
    "forest_leaf_sizes": forest_leaf_sizes,
    "explanation_features": explanation_features,
    "hybrid_rule_flags": hybrid_rule_flags,
    "training_anomaly_share": training_anomaly_share,
    "forest_scores": forest_scores,
    "forest_scores_compiled": forest_scores_compiled,
    "model_evaluation": model_evaluation,
    "feature_importance": feature_importance,
    "explain_anomalies": explain_anomalies,
    "hybrid_scoring": hybrid_scores,
}
