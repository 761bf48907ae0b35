"""The repeats stage gives back disk that it no longer needs while it runs."""

import random
import time

from pyspark.sql import functions as F

from tallywatch.llm import common, repeats
from tallywatch.session import made_tables


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {
        files.apply(i).getName() for i in range(files.size())
        if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_of_stored_tables_are_freed(spark):
    df = spark.range(1000)
    before = shuffle_files(spark)
    common.stored(df.groupBy((F.col("id") % 7).alias("k")).count(), "first").count()
    own = shuffle_files(spark) - before
    assert own
    spark.range(1).count()
    for _ in range(20):
        common.stored(df, "second")
        if not own & shuffle_files(spark):
            break
        time.sleep(0.2)
    assert not own & shuffle_files(spark)


def test_contexts_are_deleted_once_compared(spark):
    draw = random.Random(8)
    shared = "".join(draw.choices("abcdefgh", k=500))
    rows = [(i, f"{i}" * 30 + shared) for i in range(4)] + [(9, None), (10, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = set(made_tables(spark))
    cut = repeats.cut_repeats(docs, words=51)
    left = {p.rsplit("/", 1)[1].split("-")[0] for p in set(made_tables(spark)) - before}
    assert "flagged" in left and "different" not in left
    found = {r.doc_id: r.text for r in cut.collect()}
    assert found == {**{i: f"{i}" * 30 for i in range(4)}, 9: None, 10: ""}
    kind = dict(repeats.removals(docs.select(common.text_or_empty()), words=51)[1].dtypes)
    assert kind["text_key"] == "binary"  # of 16 bytes, where 32 went through each shuffle


def test_first_text_of_a_worker_may_be_empty(monkeypatch):
    monkeypatch.setattr(repeats, "_powers", {})
    assert all(len(x) == 0 for x in repeats.marked_runs(b"", 400, 51))


def test_marks_texts_and_contexts_are_deleted_once_read(spark):
    draw = random.Random(9)
    shared = "".join(draw.choices("abcdefgh", k=500))
    rows = [(i, f"{i}" * 30 + shared) for i in range(3)] + [(3, shared), (4, shared), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = set(made_tables(spark))
    whole, removed = repeats.removals(docs.select("doc_id", common.text_or_empty()), words=51)
    left = [p.rsplit("/", 1)[1].split("-")[0] for p in set(made_tables(spark)) - before]
    assert sorted(left) == ["contexts", "flagged", "marks", "texts"]  # one of each
    assert {r.doc_id: r.n_bytes for r in whole.collect()} == {0: 530, 1: 530, 2: 530, 3: 500, 4: 500, 9: 0}
    assert {(len(r.text), r.twice) for r in removed.collect()} == {(530, False), (500, True)}


def test_only_the_named_table_is_removed(spark):
    kept, gone = common.stored(spark.range(3), "kept"), common.stored(spark.range(3), "gone")
    folder = next(p for p in made_tables(spark) if "/gone-" in p)
    common.remove_stored(gone)
    assert folder not in made_tables(spark) and kept.count() == 3
