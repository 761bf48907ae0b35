"""Batch readers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.schema import CORRUPT, TRANSACTION, TRANSACTION_OR_CORRUPT


def _read_lines(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, Column]:
    """Lines with their parsed record ``t``, and the test for a valid JSON object.

    Only lines the schema rejects are parsed a second time, to tell broken JSON from a
    valid object with a wrongly typed field (that field is then null).
    """
    lines = spark.read.text(path).select(
        "value",
        F.from_json(
            "value", TRANSACTION_OR_CORRUPT, {"columnNameOfCorruptRecord": CORRUPT}
        ).alias("t"),
    )
    fits = F.col("t").isNotNull() & F.col(f"t.{CORRUPT}").isNull()
    is_object = F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT")
    return lines, F.when(fits, True).otherwise(F.coalesce(is_object, F.lit(False)))


def read_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines as transactions; lines that are not JSON are skipped.

    A missing path raises.
    """
    lines, valid = _read_lines(spark, path)
    return lines.filter(valid).select("t.*").drop(CORRUPT)


def read_jsonl_with_quarantine(
    spark: SparkSession, path: str | list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw text of every line that does not."""
    lines, _ = _read_lines(spark, path)
    fits = F.col("t").isNotNull() & F.col(f"t.{CORRUPT}").isNull()
    good = lines.filter(fits).select("t.*").drop(CORRUPT)
    return good, lines.filter(~fits).select(F.col("value").alias("raw_record"))


def read_lookup_table(spark: SparkSession, path: str, cache: bool = True) -> DataFrame:
    """Slowly changing parquet table such as user profiles or rules."""
    table = spark.read.parquet(path)
    return table.cache() if cache else table


def records_to_table(spark: SparkSession, records: Iterable[dict]) -> DataFrame:
    """A handful of record dictionaries as transactions, for tests and demos."""
    return spark.createDataFrame(list(records), TRANSACTION)
