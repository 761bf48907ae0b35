"""The pipeline against plain versions of its stages' decisions."""

from collections import Counter

import corpus_pipeline
import fixtures
from tallywatch.llm.common import table
from tallywatch.session import made_tables


def test_stages_keep_columns_and_take_effect(spark, odd):
    docs = table(spark, odd, "documents")
    columns, before = docs.columns, docs.count()
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, odd)
        if name != "packing":
            assert docs.columns == columns
        docs = corpus_pipeline.stored(docs, name)
        sizes[name] = docs.count()
        if name == "quality":
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert not ids & {400, 401, 402, 403, 500, 501, 502, 503, 504, 507}
        if name == "near_duplicates":
            ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
            assert ids[7] == 1 and not set(ids) & set(range(200, 240))
            assert max(ids.values()) == 1
        if name == "repeats":
            rows = {r.doc_id: r for r in docs.collect()}
            assert len(rows[300].text) < len(dict(fixtures.texts())[300]) - 300
            assert rows[300].n_chars == len(rows[300].text)
        last = docs
    assert sizes["quality"] < before
    assert sizes["near_duplicates"] == sizes["repeats"] == sizes["secrets"] > 55
    packed = Counter(p.doc_id for r in last.collect() for p in r.pieces)
    assert len(packed) == sizes["secrets"]


def test_run_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_stages_delete_what_earlier_ones_stored(spark, odd):
    docs = table(spark, odd, "documents").filter("doc_id < 100")
    first = corpus_pipeline.near_duplicates(spark, docs, odd)
    before = set(made_tables(spark))
    lazy = corpus_pipeline.secrets(spark, first, odd)
    assert set(made_tables(spark)) >= {p for p in before if any(p in f for f in first.inputFiles())}
    assert lazy.count() == first.count() > 0
    kept = corpus_pipeline.stored(corpus_pipeline.repeats(spark, docs, odd), "kept")
    own = set(made_tables(spark))
    packed = corpus_pipeline.packing(spark, kept, odd)
    gone = own - set(made_tables(spark))
    assert {p.rsplit("/", 1)[1].split("-")[0] for p in gone} >= {"marks", "texts", "contexts"}
    assert packed.count() > 0 and kept.count() == docs.count()
