"""Raw records to typed transactions; works on batch tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.schema import CORRUPT, TRANSACTION, TRANSACTION_OR_CORRUPT


ROW_ID = "event_id"
TOPIC_POSITION = ["topic", "partition", "offset"]


def parse_records(
    records: DataFrame, keep_corrupt: bool = False, row_id: str | None = None
) -> DataFrame:
    """``value`` JSON and ``timestamp`` of the bus to transaction columns.

    ``event_id`` is the column ``row_id`` of the records, or topic, partition and offset if
    they carry these: the same for a record that is read again, and different for equal ones.
    A malformed value becomes an all-null row. With ``keep_corrupt`` its text is kept in
    ``_corrupt`` so that it can be routed elsewhere.
    """
    schema = TRANSACTION_OR_CORRUPT if keep_corrupt else TRANSACTION
    options = {"columnNameOfCorruptRecord": CORRUPT} if keep_corrupt else {}
    if row_id:
        identity = [F.col(row_id).alias(ROW_ID)]
    elif set(TOPIC_POSITION) <= set(records.columns):
        identity = [F.concat_ws("-", *TOPIC_POSITION).alias(ROW_ID)]
    else:
        identity = []
    parsed = records.select(
        F.from_json(F.col("value").cast("string"), schema, options).alias("t"),
        F.col("timestamp").alias("kafka_timestamp"),
        *identity,
    )
    columns = [c for c in parsed.columns if c != "t"]
    return flatten_location(with_event_time(parsed.select("t.*", *columns)))


def with_event_time(df: DataFrame) -> DataFrame:
    """Typed event time; text that is not a timestamp becomes null."""
    return df.withColumn("transaction_timestamp", F.col("timestamp").try_cast("timestamp"))


def flatten_location(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "latitude": F.col("location.lat"),
        "longitude": F.col("location.long"),
    })


def slim(df: DataFrame) -> DataFrame:
    """Smaller rows for wide fan-outs. Float amounts lose cents above 2**24, so opt in."""
    return df.withColumns({
        "amount": F.col("amount").cast("float"),
        "user_id": F.col("user_id").cast("string"),
    }).drop("kafka_timestamp", "partition", "offset")
