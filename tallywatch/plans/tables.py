"""The given tables seen as transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.schema import DEFAULT_CONFIG


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a file stream. The glob makes file and folder work alike."""
    schema = read_table(spark, folder, name).schema
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", "1000")
        .parquet(f"{folder}/{name}.parque[t]")
    )


def as_transactions(events: DataFrame) -> DataFrame:
    """Events as transactions: a location derived from the event id, with every 97th
    missing and every 25th about 111 km off (the planted ``is_fraud`` rows)."""
    event = F.col("event_id")
    offset_lat = (event * 37 % 201 - 100) / F.lit(1000.0)
    offset_long = (event * 53 % 201 - 100) / F.lit(1000.0)
    moved = F.when(event % 25 == 0, 1.0).otherwise(0.0)
    located = event % 97 != 0
    return events.select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        (F.col("value") * 100.0).alias("amount"),
        F.col("ts").alias("transaction_timestamp"),
        F.when(located, DEFAULT_CONFIG.center_lat + offset_lat + moved).alias("latitude"),
        F.when(located, DEFAULT_CONFIG.center_long + offset_long).alias("longitude"),
        F.col("event_type").alias("type"),
        F.get_json_object("props", "$.k").alias("recipient_id"),
        (event % 25 == 0).alias("is_fraud"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return as_transactions(read_table(spark, folder, "events"))


def transaction_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Event time as TIMESTAMP, which watermarks and stateful operators need."""
    return as_transactions(stream_table(spark, folder, "events")).withColumn(
        "transaction_timestamp", F.col("transaction_timestamp").cast("timestamp")
    )


def wire_columns(rows: DataFrame) -> DataFrame:
    """Transactions in the record schema: text timestamp and nested location."""
    return rows.withColumns({
        "timestamp": F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "location": F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("long")),
    })


def orders_as_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("double").alias("amount"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("transaction_timestamp"),
    )
