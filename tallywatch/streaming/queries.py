"""The streaming outputs and the jobs that run them side by side."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallywatch.operators.metrics import frequent_users, hourly_metrics
from tallywatch.operators.rules import apply_rules, flagged
from tallywatch.schema import DEFAULT_CONFIG, RiskConfig
from tallywatch.sinks.documents import (
    BulkClient,
    flagged_documents,
    hourly_documents,
    write_document_files,
    write_documents,
)

BatchWriter = Callable[[DataFrame, int], None]

# How often each output fires.
DOCUMENT_TRIGGER = "10 seconds"
FREQUENCY_TRIGGER = "30 seconds"
HOURLY_TRIGGER = "60 seconds"
CONSOLE_ROWS = 100


def alert_stream(parsed: DataFrame, config: RiskConfig = DEFAULT_CONFIG) -> DataFrame:
    """Flagged transactions; stateless, append mode."""
    return flagged(apply_rules(parsed, config))


def frequency_stream(
    parsed: DataFrame, config: RiskConfig = DEFAULT_CONFIG, watermark: str | None = None
) -> DataFrame:
    """Users above the window count.

    Without ``watermark`` all windows stay in state (complete mode). At scale give one and use
    update mode: closed windows leave the state and later rows are dropped and counted.
    """
    timed = parsed.withColumn(
        "transaction_timestamp", F.col("transaction_timestamp").cast("timestamp")
    )
    if watermark:
        timed = timed.withWatermark("transaction_timestamp", watermark)
    return frequent_users(timed, config)


def hourly_stream(parsed: DataFrame, config: RiskConfig = DEFAULT_CONFIG) -> DataFrame:
    """Totals per hour of day; at most 25 groups of state, complete mode."""
    return hourly_metrics(apply_rules(parsed, config))


# -- writers -----------------------------------------------------------------------------


def start(
    writer: DataStreamWriter, checkpoint: str, every: str | None, available_now: bool = False
) -> StreamingQuery:
    """Start with a checkpoint; ``available_now`` drains the source and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """Several outputs from one micro-batch that is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def snapshot_writer(root: str) -> BatchWriter:
    """Complete-mode results, one folder per batch; ``read_snapshot`` reads the newest."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return write


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete snapshot below ``root``, found from the folder names alone."""
    snapshots = spark.read.parquet(root)
    batch_ids = re.findall(r"batch_id=(\d+)", "\n".join(snapshots.inputFiles()))
    return snapshots.filter(F.col("batch_id") == max(map(int, batch_ids))).drop("batch_id")


def read_changes(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Update-mode results of ``snapshot_writer``: the newest of each key."""
    changes = spark.read.parquet(root)
    values = [c for c in changes.columns if c not in (*keys, "batch_id")]
    return changes.groupBy(*keys).agg(
        F.max_by(F.struct(*values), "batch_id").alias("newest")
    ).select(*keys, "newest.*")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a frequency stream holds in its state as of its last batch: every open window of
    every user with its count, whether above the limit or not. Reads the checkpoint of a stopped
    or running stream; nothing is replayed. The session must use the stream's state store."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("key.user_id").alias("user_id"),
        F.col("value.count").alias("transaction_count"),
    )


def start_console(
    parsed: DataFrame,
    checkpoint: str,
    config: RiskConfig = DEFAULT_CONFIG,
    watermark: str | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Alerts, frequent users and hourly totals on the console."""
    def console(df: DataFrame, mode: str) -> DataStreamWriter:
        return df.writeStream.outputMode(mode).format("console").option("truncate", "false")

    frequency_mode = "update" if watermark else "complete"
    return [
        start(
            console(alert_stream(parsed, config), "append").option("numRows", CONSOLE_ROWS),
            f"{checkpoint}/console_alerts", None, available_now,
        ),
        start(
            console(frequency_stream(parsed, config, watermark), frequency_mode),
            f"{checkpoint}/console_frequency", FREQUENCY_TRIGGER, available_now,
        ),
        start(
            console(hourly_stream(parsed, config), "complete"),
            f"{checkpoint}/console_hourly", HOURLY_TRIGGER, available_now,
        ),
    ]


def start_documents(
    parsed: DataFrame,
    checkpoint: str,
    write_flagged: BatchWriter,
    write_hourly: BatchWriter,
    config: RiskConfig = DEFAULT_CONFIG,
    available_now: bool = False,
    also: Sequence[BatchWriter] = (),
) -> list[StreamingQuery]:
    """Flagged and hourly documents; the writers get shaped documents and the batch id.

    ``also`` are further outputs, such as model scoring. They get all parsed rows of the same
    micro-batch, which is read once. Hourly totals keep state and read by themselves.
    """
    def flagged_batch(batch: DataFrame, batch_id: int) -> None:
        write_flagged(flagged_documents(flagged(apply_rules(batch, config))), batch_id)

    def hourly_batch(batch: DataFrame, batch_id: int) -> None:
        write_hourly(hourly_documents(batch), batch_id)

    rows = parsed.writeStream.outputMode("append").foreachBatch(fan_out(flagged_batch, *also))
    hourly = hourly_stream(parsed, config).writeStream.outputMode("complete")
    return [
        start(rows, f"{checkpoint}/documents_flagged", DOCUMENT_TRIGGER, available_now),
        start(hourly.foreachBatch(hourly_batch), f"{checkpoint}/documents_hourly",
              HOURLY_TRIGGER, available_now),
    ]


def document_file_writers(root: str) -> tuple[BatchWriter, BatchWriter]:
    """A folder per batch for either kind; ``read_newest`` reads the last hourly documents, so
    no reader ever finds a folder that is being replaced by a later batch."""
    def flagged_files(documents: DataFrame, batch_id: int) -> None:
        write_document_files(documents, f"{root}/flagged", batch_id)

    def hourly_files(documents: DataFrame, batch_id: int) -> None:
        write_document_files(documents, f"{root}/hourly", batch_id)

    return flagged_files, hourly_files


def read_newest(spark: SparkSession, root: str) -> DataFrame:
    """JSON documents of the newest batch below ``root``."""
    documents = spark.read.json(root)
    batch_ids = re.findall(r"batch_id=(\d+)", "\n".join(documents.inputFiles()))
    return documents.filter(F.col("batch_id") == max(map(int, batch_ids))).drop("batch_id")


def bulk_writers(
    make_client: Callable[[], BulkClient], **options
) -> tuple[BatchWriter, BatchWriter]:
    """Both kinds of documents to an index, from the executors; see ``write_documents``."""
    def bulk(documents: DataFrame, batch_id: int) -> None:
        write_documents(documents, make_client, **options)

    return bulk, bulk


def start_job(
    parsed: DataFrame,
    output: str,
    checkpoint: str,
    document_root: str | None = None,
    make_client: Callable[[], BulkClient] | None = None,
    bulk_options: dict | None = None,
    **options,
) -> list[StreamingQuery]:
    """All queries of one output mode: ``console`` or ``documents``.

    Documents go to files below ``document_root``, or to the index that ``make_client``
    reaches. ``also`` adds outputs that get all parsed rows.
    """
    if output == "console":
        return start_console(parsed, checkpoint, **options)
    if output == "documents":
        if make_client is not None:
            writers = bulk_writers(make_client, **(bulk_options or {}))
        elif document_root is not None:
            writers = document_file_writers(document_root)
        else:
            raise ValueError("documents need document_root or make_client")
        return start_documents(parsed, checkpoint, *writers, **options)
    raise ValueError(f"unknown output {output!r}")


def wait_for_all(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Block until every query has ended; the first failure stops the others and is raised."""
    try:
        # only these: the session may remember other queries that have failed
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
        spark.streams.resetTerminated()
