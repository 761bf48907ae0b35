"""Quality is fitted on all labelled documents, whatever their number."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import quality


def test_target_counts_hold_every_trusted_document(spark):
    # more trusted documents than once were sampled, each with a word of its own
    docs = spark.range(0, 20_300, 1, 4).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.lit("plain " * 20), F.concat(F.lit("w"), "id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    ratio = quality.fit_quality(docs, labels).ratio
    # all documents are trusted, so both multinomials are the same
    assert np.abs(ratio).max() == 0


@pytest.mark.parametrize("seed", range(3))
def test_threshold_of_many_rows_equals_that_in_memory(spark, seed):
    draw = np.random.default_rng(seed)
    trusted = np.repeat([0, 1], 256)
    scores = np.round(draw.normal(trusted * (seed - 0.5), 1.0), 1 + seed)
    rows = spark.createDataFrame(
        list(zip(trusted.tolist(), scores.tolist())), "trusted long, llr double").repartition(4)
    assert quality.threshold_of(rows) == quality.best_threshold(scores, trusted)


def test_threshold_needs_both_classes(spark):
    rows = spark.createDataFrame([(1, 0.5), (1, 0.7)], "trusted long, llr double")
    assert quality.threshold_of(rows) == float("-inf")
    assert quality.threshold_of(rows.limit(0)) == float("-inf")
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)], "trusted long, llr double")
    assert quality.threshold_of(tied) == float("-inf")


def test_labelled_texts_are_all_rows_of_labelled_ids(spark):
    docs = spark.createDataFrame(
        [(i, f"t{i}") for i in range(-300, 300)] + [(5, None), (None, "x")],
        "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(-300, 300, 3)] + [(5, 0), (6, 1), (6, None), (None, 1)],
        "doc_id int, quality int")
    rows = {(r.doc_id, r.text, r.trusted) for r in quality.labelled_texts(docs, labels).collect()}
    assert rows == {(i, f"t{i}", i % 2 if i != 6 else 0) for i in range(-300, 300, 3)} | {
        (5, "t5", 0), (5, "", 0)}
