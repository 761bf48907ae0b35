"""The streaming job from raw records to its outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywatch.operators.model import AnomalyModel
from tallywatch.sources.parse import parse_records
from tallywatch.sources.streams import read_stream, topic_options
from tallywatch.streaming.queries import BatchWriter, start_job, wait_for_all
from tallywatch.streaming.scoring import scoring_batch_writer


def topic_records(spark: SparkSession, bootstrap_servers: str, topic: str, **bounds) -> DataFrame:
    """Raw records of a topic; ``bounds`` limit the offsets per trigger."""
    return read_stream(spark, "kafka", topic_options(bootstrap_servers, topic, **bounds))


def run_stream_job(
    spark: SparkSession,
    records: DataFrame,
    output: str,
    checkpoint: str,
    row_id: str | None = None,
    model: AnomalyModel | None = None,
    profiles: DataFrame | None = None,
    write_scored: BatchWriter | None = None,
    **options,
) -> None:
    """Parse the records, start all queries of the output mode, and wait for them.

    With ``model``, ``profiles`` and ``write_scored`` the rows of each micro-batch are also
    scored, with their users' history before it, and written with the enhanced flag; they
    are read once for both outputs. ``row_id`` names the records' id where they do not come
    from a topic.
    """
    if model is not None:
        if profiles is None or write_scored is None:
            raise ValueError("scoring needs profiles and write_scored")
        options["also"] = [scoring_batch_writer(model, profiles, write_scored)]
    parsed = parse_records(records, row_id=row_id)
    wait_for_all(spark, start_job(parsed, output, checkpoint, **options))
