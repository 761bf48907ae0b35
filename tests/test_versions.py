"""Model versions: whole or not at all, swapped between batches; figures of running streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import model as models
from tallywatch.operators.features import prepare_features
from tallywatch.operators.model import AnomalyModel
from tallywatch.operators.quality import quality_report, quality_rules
from tallywatch.operators.rules import apply_rules
from tallywatch.operators.versions import current_version, publish, version_path
from tallywatch.plans.tables import transactions, wire_columns
from tallywatch.streaming.figures import StreamFigures, observed
from tallywatch.streaming.queries import start
from tallywatch.streaming.scoring import build_profiles, scoring_batch_writer


@pytest.fixture(scope="module")
def rows(spark, data):
    return transactions(spark, data).withColumn(
        "transaction_timestamp", F.col("transaction_timestamp").cast("timestamp"))


@pytest.fixture(scope="module")
def features(rows):
    return prepare_features(apply_rules(rows)).cache()


def fitted(features, path, seed):
    return AnomalyModel(str(path), seed=seed, n_trees=5).train(features)


def test_a_reader_during_a_save_gets_a_whole_version(spark, features, tmp_path, monkeypatch):
    first = fitted(features, tmp_path, 1)
    seen = []

    def reading(*args):
        reader = AnomalyModel(str(tmp_path))
        assert reader.load(spark)  # the new version's files are there, its marker is not
        seen.append(reader)
        publish(*args)

    monkeypatch.setattr(models, "publish", reading)
    second = fitted(features, tmp_path, 2)
    assert seen[0].version == first.version and seen[0].seed == 1
    assert seen[0].forest.offset == first.forest.offset
    after = AnomalyModel(str(tmp_path))
    assert after.load(spark)
    assert (after.version, after.seed) == (second.version, 2)
    assert after.forest.nodes.equals(
        second.forest.nodes.sort_values(["tree_id", "node_id"], ignore_index=True))


def test_a_failed_save_changes_nothing(spark, features, tmp_path, monkeypatch):
    first = fitted(features, tmp_path, 1)

    def broken(*args):
        raise OSError("disk")

    monkeypatch.setattr(models, "publish", broken)
    with pytest.raises(OSError):
        fitted(features, tmp_path, 2)
    assert current_version(spark, str(tmp_path)) == first.version
    reader = AnomalyModel(str(tmp_path))
    assert reader.load(spark) and reader.seed == 1
    assert not reader.refresh(spark)


def test_only_the_last_versions_stay(spark, tmp_path):
    root = str(tmp_path)
    for n in range(6):
        (tmp_path / "versions" / f"v{n}").mkdir(parents=True)
        publish(spark, root, f"v{n}")
        assert current_version(spark, root) == f"v{n}"
    left = sorted(p.name for p in (tmp_path / "versions").iterdir())
    assert left == ["v3", "v4", "v5"]
    assert version_path(root, "v5") == f"{root}/versions/v5"


def test_a_stream_takes_up_a_new_version_between_batches(spark, rows, features, tmp_path):
    model = fitted(features, tmp_path / "model", 1)
    other = AnomalyModel(str(tmp_path / "model"), seed=7, n_trees=5)
    rows.repartition(3).write.parquet(str(tmp_path / "rows"))
    profiles = build_profiles(rows)
    used = []

    def write(scored, batch_id):
        scored.select("event_id", "ml_anomaly_score").write.mode("overwrite").parquet(
            f"{tmp_path}/scores/batch_id={batch_id}")
        used.append(model.version)
        if batch_id == 0:
            other.train(features)  # published while the stream runs

    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "rows"))
    writer = scoring_batch_writer(model, profiles, write, follow=True)
    start(stream.writeStream.foreachBatch(writer), str(tmp_path / "checkpoint"), None,
          True).awaitTermination()
    assert len(used) == 3 and used[0] != used[1] == used[2] == other.version
    assert model.seed == 7
    scores = spark.read.parquet(f"{tmp_path}/scores")
    assert scores.count() == rows.count()


# -- figures -------------------------------------------------------------------------------


def test_counts_of_a_stream_equal_the_batch_report(spark, rows, tmp_path):
    wire = wire_columns(rows).drop("location")
    wire.repartition(4).write.parquet(str(tmp_path / "rows"))
    rules = quality_rules(allowed_types=("purchase", "view"))
    stream = spark.readStream.schema(wire.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "rows"))
    listener = StreamFigures()
    spark.streams.addListener(listener)
    try:
        writer = observed(stream, rules).writeStream.queryName("records").format("parquet").option(
            "path", str(tmp_path / "out"))
        query = start(writer, str(tmp_path / "checkpoint"), None, True)
        query.awaitTermination()
        listener.take(query)  # whatever the listener has not heard of yet
    finally:
        spark.streams.removeListener(listener)
    report = listener.quality_report(spark)
    assert {r["query"] for r in report.collect()} == {"records"}
    expected = {(r.rule, r.violations, r.checked) for r in quality_report(wire, rules).collect()}
    assert {(r.rule, r.violations, r.checked) for r in report.collect()} == expected
    assert spark.read.parquet(str(tmp_path / "out")).count() == wire.count()
    # told again, nothing is counted twice
    before = dict(listener.rows)
    listener.take(query)
    assert dict(listener.rows) == before
    assert {(r.rule, r.violations, r.checked) for r in listener.quality_report(
        spark).collect()} == expected


def test_late_rows_of_a_window_stream_are_counted(spark, tmp_path):
    schema = "user_id string, transaction_timestamp timestamp"
    begin = datetime(2024, 1, 1)

    def add(*minutes):
        spark.createDataFrame(
            [("a", begin + timedelta(minutes=m)) for m in minutes], schema
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "rows"))

    figures = StreamFigures()

    def run():
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(
            str(tmp_path / "rows"))
        counts = rows.withWatermark("transaction_timestamp", "1 minute").groupBy(
            F.window("transaction_timestamp", "1 minute"), "user_id").count()
        query = start(
            counts.writeStream.outputMode("append").format("parquet").option(
                "path", str(tmp_path / "out")), str(tmp_path / "checkpoint"), None, True)
        query.awaitTermination()
        figures.take(query)

    add(0, 1, 60)
    run()
    add(2, 3, 61)
    run()
    (row,) = figures.lateness_report(spark).collect()
    assert (row.rows, row.late_rows) == (6, 2)
    assert row.watermark.startswith("2024-01-01T01:00")
