"""Transactions as keyed topic records or JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.schema import TRANSACTION

# Delivery settings of the topic producer.
TOPIC_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.retry.backoff.ms": "100",
    "kafka.request.timeout.ms": "30000",
    "kafka.compression.type": "gzip",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.buffer.memory": "33554432",
    "kafka.max.block.ms": "60000",
}


def keyed_records(transactions: DataFrame) -> DataFrame:
    """``key`` = user, ``value`` = JSON of the record with nulls written out."""
    fields = [f.name for f in TRANSACTION]
    return transactions.select(
        F.col("user_id").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def topic_writer_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **TOPIC_OPTIONS}


def write_topic(transactions: DataFrame, bootstrap_servers: str, topic: str) -> None:
    keyed_records(transactions).write.format("kafka").options(
        **topic_writer_options(bootstrap_servers, topic)
    ).save()


def append_jsonl(transactions: DataFrame, path: str) -> None:
    """One JSON object per line, added to what ``path`` already holds."""
    transactions.select(*[f.name for f in TRANSACTION]).write.mode("append").option(
        "ignoreNullFields", "false"
    ).json(path)
