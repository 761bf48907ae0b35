"""The document sink: nothing of a failed batch, nothing twice of a repeated one."""

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallywatch.operators.rules import apply_rules, flagged
from tallywatch.plans.tables import transactions
from tallywatch.sinks.committed import (
    STAGING,
    DocumentWriter,
    Written,
    read_documents,
    stream_documents,
)
from tallywatch.sinks.documents import flagged_documents
from tallywatch.streaming.queries import start


def batch(*ids):
    return pa.record_batch({
        "_id": pa.array(ids, pa.string()), "json": [f'{{"_id": "{i}"}}' for i in ids]})


def visible(path):
    return sorted(
        (p.parent.name, line) for p in path.glob("batch_id=*/*.json")
        for line in p.read_text().splitlines())


@pytest.fixture(scope="module")
def rows(spark, data):
    return transactions(spark, data).withColumn(
        "transaction_timestamp", F.col("transaction_timestamp").cast("timestamp"))


def test_commit_repeat_and_abort(tmp_path):
    writer = DocumentWriter(str(tmp_path))
    first = [writer.write(iter([batch("a"), batch(), batch("b")])), writer.write(iter([]))]
    assert first[1] == Written(None, 0) and visible(tmp_path) == []
    writer.write(iter([batch("lost")]))  # an attempt whose message never came
    writer.commit([*first, None], 0)
    once = visible(tmp_path)
    assert once == [("batch_id=0", '{"_id": "a"}'), ("batch_id=0", '{"_id": "b"}')]
    # the batch runs again after a restart: its new files go
    writer.commit([writer.write(iter([batch("a", "b")]))], 0)
    assert visible(tmp_path) == once
    failed = [writer.write(iter([batch("c")])), None]
    writer.abort(failed, 1)
    assert visible(tmp_path) == once
    assert len(list((tmp_path / STAGING).glob("*.json"))) == 1  # the lost attempt only
    writer.commit([writer.write(iter([batch("c")]))], 1)
    assert visible(tmp_path) == [*once, ("batch_id=1", '{"_id": "c"}')]


def test_a_document_without_id_fails(tmp_path):
    with pytest.raises(ValueError):
        DocumentWriter(str(tmp_path)).write(iter([batch("a"), batch(None)]))


def test_stream_of_documents(spark, rows, tmp_path):
    rows.repartition(3).write.parquet(str(tmp_path / "rows"))
    expected = flagged_documents(flagged(apply_rules(rows)))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "rows"))
    for _ in range(2):  # the second run finds nothing new
        documents = flagged_documents(flagged(apply_rules(stream)))
        start(stream_documents(documents, str(tmp_path / "out")), str(tmp_path / "checkpoint"),
              None, True).awaitTermination()
    found = read_documents(spark, str(tmp_path / "out"), expected.schema)
    assert {r.batch_id for r in found.select("batch_id").distinct().collect()} == {0, 1, 2}
    assert found.count() == expected.count()
    assert found.drop("batch_id").exceptAll(expected).count() == 0
    assert not list((tmp_path / "out" / STAGING).glob("*.json"))


def test_a_failed_batch_leaves_nothing(spark, rows, tmp_path):
    schema = rows.schema
    good = rows.filter("event_id < 500")
    good.coalesce(1).write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "rows"))

    def run():
        documents = flagged_documents(flagged(apply_rules(stream)))
        start(stream_documents(documents, str(tmp_path / "out")), str(tmp_path / "checkpoint"),
              None, True).awaitTermination()

    run()
    before = visible(tmp_path / "out")
    bad = rows.filter("event_id BETWEEN 500 AND 900").withColumn(
        "event_id", F.when(F.col("event_id") % 25 != 0, F.col("event_id")))
    bad.repartition(4).write.mode("append").parquet(str(tmp_path / "rows"))
    with pytest.raises(StreamingQueryException):
        run()
    assert visible(tmp_path / "out") == before and before
