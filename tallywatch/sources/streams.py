"""Stream readers: one entry point for every format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FILE_FORMATS = ("json", "parquet", "text", "csv", "orc")


def topic_options(
    bootstrap_servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options for the ``kafka`` format, optionally bounding each micro-batch."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_offsets_per_trigger is not None:
        options["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
    return options


def read_stream(
    spark: SparkSession,
    source: str,
    options: dict[str, str] | None = None,
    schema: StructType | None = None,
    path: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame; file formats need a schema and a path."""
    reader = spark.readStream.format(source).options(**(options or {}))
    if source in FILE_FORMATS:
        if schema is None or path is None:
            raise ValueError(f"{source} streams need schema and path")
        reader = reader.schema(schema)
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(path)
    return reader.load()
