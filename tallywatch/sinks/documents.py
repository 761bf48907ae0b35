"""Search documents: shaping, schema check, and bulk writing from the executors."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.schema import DOCUMENT

FLAGGED = "flagged_transaction"
HOURLY_AGGREGATE = "hourly_aggregate"
DOCUMENT_ID = "_id"

# Documents per request, and tries on connection errors.
BULK_SIZE = 1000
MAX_ATTEMPTS = 3


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def flagged_documents(df: DataFrame, row_id: str = "event_id") -> DataFrame:
    """Scored rows as documents whose ``_id`` is the row id, so that a retry overwrites.

    There is no id made from the content: equal transactions are different documents.
    """
    if row_id not in df.columns:
        raise ValueError(f"documents need the row id column {row_id}")
    shaped = df.withColumns({
        "location": F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")),
        "transaction_timestamp": iso_text(F.col("transaction_timestamp")),
        "document_type": F.lit(FLAGGED),
    })
    fields = [f.name for f in DOCUMENT if f.name in shaped.columns]
    return shaped.select(F.col(row_id).cast("string").alias(DOCUMENT_ID), *fields)


def hourly_documents(metrics: DataFrame, stamped: bool = True) -> DataFrame:
    """Hourly totals as documents whose ``_id`` is the hour: one document per hour, ever."""
    hour = F.lpad(F.col("hour").cast("string"), 2, "0")
    documents = metrics.select(
        F.concat(F.lit("hour-"), F.coalesce(hour, F.lit("unknown"))).alias(DOCUMENT_ID),
        hour.alias("hour"),
        F.col("total_volume").cast("double"),
        F.col("flagged_count").cast("long"),
        F.col("total_transactions").cast("long"),
        F.col("avg_amount").cast("double"),
        F.col("max_amount").cast("double"),
        F.col("min_amount").cast("double"),
        F.lit(HOURLY_AGGREGATE).alias("document_type"),
    )
    if not stamped:
        return documents
    return documents.withColumn("timestamp", iso_text(F.current_timestamp()))


def check_document_schema(df: DataFrame) -> DataFrame:
    """``df`` unchanged; raises if a column is not a document field of the right type."""
    allowed = {field.name: field.dataType for field in DOCUMENT}
    for field in df.schema:
        if field.name == DOCUMENT_ID:
            continue
        if field.name not in allowed:
            raise ValueError(f"{field.name} is not a document field")
        if field.dataType.simpleString() != allowed[field.name].simpleString():
            raise ValueError(
                f"{field.name} is {field.dataType.simpleString()}, "
                f"expected {allowed[field.name].simpleString()}"
            )
    return df


class BulkClient(Protocol):
    """What the writer needs from an index client; created once per task."""

    def bulk(self, documents: list[tuple[str, str]]) -> None:
        """Index ``(id, json)`` pairs; raises ``ConnectionError`` when unreachable."""


def send_with_retry(
    client: BulkClient,
    documents: list[tuple[str, str]],
    attempts: int = MAX_ATTEMPTS,
    pause: Callable[[float], None] = time.sleep,
) -> None:
    """Up to ``attempts`` tries with doubling pauses, on connection errors only."""
    for attempt in range(attempts):
        try:
            return client.bulk(documents)
        except ConnectionError:
            if attempt + 1 == attempts:
                raise
            pause(2**attempt)


def write_documents(
    documents: DataFrame,
    make_client: Callable[[], BulkClient],
    bulk_size: int = BULK_SIZE,
    attempts: int = MAX_ATTEMPTS,
    pause: Callable[[float], None] = time.sleep,
) -> int:
    """Bulk-index from the executors; returns the number of documents.

    A failure that outlives the retries fails the task, and with it the batch.
    """
    body = [c for c in check_document_schema(documents).columns if c != DOCUMENT_ID]
    as_json = documents.select(DOCUMENT_ID, F.to_json(F.struct(*body)).alias("json"))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            pairs = list(zip(batch[DOCUMENT_ID], batch["json"]))
            for start in range(0, len(pairs), bulk_size):
                send_with_retry(client, pairs[start:start + bulk_size], attempts, pause)
            yield pd.DataFrame({"sent": [len(pairs)]})

    return as_json.mapInPandas(send, "sent long").agg(
        F.coalesce(F.sum("sent"), F.lit(0))
    ).first()[0]


def write_document_files(documents: DataFrame, root: str, batch_id: int = 0) -> None:
    """JSON documents by type below ``root``; a repeated batch replaces its own folder."""
    check_document_schema(documents).write.mode("overwrite").partitionBy(
        "document_type"
    ).json(f"{root}/batch_id={batch_id}")
