"""Benchmark passages: the index against plain scans, and the operator against plain windows."""

import hashlib
import re

import fixtures
import numpy as np
import pytest

from tallywatch.llm import decontaminate as de
from tallywatch.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(text, items, window=10):
    """(words, hit words, ids of items found) of one text."""
    words, hit, found = plain_words(text), set(), set()
    for name, item in items:
        own = plain_words(item)
        size = min(window, len(own))
        phrases = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if size else set()
        for at in range(len(words) - size + 1):
            if size and tuple(words[at:at + size]) in phrases:
                hit.update(range(at, at + size))
                found.add("" if name is None else str(name))
    return words, hit, found


def plain_order(codes):
    """Suffixes in order, each 0 a symbol of its own."""
    keys = [[(1, int(c)) if c else (0, at + k) for k, c in enumerate(codes[at:])]
            for at in range(len(codes))]
    return sorted(range(len(codes)), key=keys.__getitem__)


@pytest.mark.parametrize("seed", range(12))
def test_index_against_plain_scans(seed):
    draw = np.random.default_rng(seed)
    symbols = int(draw.integers(1, 7))
    codes = draw.integers(0, symbols + 1, int(draw.integers(1, 90))).astype(np.int32)
    codes = np.append(np.tile(codes, 1 + seed % 4), 0).astype(np.int32)
    bits = symbols.bit_length()
    assert de.suffix_order(codes, bits).tolist() == plain_order(codes)
    index = de.FMIndex(codes, bits)
    lengths = draw.integers(1, 6, 30)
    phrases = draw.integers(1, symbols + 1, (30, 5))
    low, high = index.ranges(phrases, lengths)
    for phrase, size, begin, end in zip(phrases.tolist(), lengths, low, high):
        found = sorted(index.locate(np.arange(begin, end)).tolist())
        assert found == [
            i for i in range(len(codes)) if codes[i:i + size].tolist() == phrase[:size]]


def test_ranks_of_the_wavelet_tree():
    draw = np.random.default_rng(4)
    symbols = draw.integers(0, 50, 700)
    tree = de.WaveletTree(symbols, 6)
    at = draw.integers(0, 701, 300)
    asked = draw.integers(0, 64, 300)
    assert tree.rank(asked, at).tolist() == [
        int((symbols[:p] == s).sum()) for s, p in zip(asked, at)]
    found, before = tree.at(at[at < 700])
    assert found.tolist() == symbols[at[at < 700]].tolist()
    assert before.tolist() == [int((symbols[:p] == symbols[p]).sum()) for p in at[at < 700]]


@pytest.mark.parametrize("size", [de.SHARD_WORDS, 40])
def test_query_on_awkward_rows(spark, odd, monkeypatch, size):
    monkeypatch.setattr(de, "SHARD_WORDS", size)  # on the driver; tasks get the module's own
    rows = QUERIES["op11_decontaminate"](spark, odd).collect()
    texts = {d: t for d, t in fixtures.texts() if d is not None}
    for r in rows:
        if r.doc_id is None:
            continue
        words, hit, found = plain_hits(texts[r.doc_id], fixtures.benchmark_rows())
        assert (r.n_words, r.n_hit, r.n_items) == (len(words), len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r.contaminated == bool(hit)
    assert sum(r.contaminated for r in rows) > 8


def test_long_texts_are_cut_with_overlaps(monkeypatch):
    monkeypatch.setattr(de, "SHARD_WORDS", 25)
    draw = np.random.default_rng(2)
    item = " ".join(f"w{i}" for i in range(14))
    text = " ".join([f"x{i}" for i in range(17)] + [item] + draw.choice(["w1", "w2"], 60).tolist()
                    + [item] * 2)
    phrases = de.phrases_of([("a", item)], 10)
    shard = de.Shard(phrases, 10)
    shard.add(0, de.words_of(text))
    assert len(shard.parts) > 3
    begins, ends, items = shard.hits()[0]
    hit = {i for b, e in zip(begins, ends) for i in range(b, e)}
    assert hit == plain_hits(text, [("a", item)])[1] and items == {0}


def test_blocks_of_phrases_change_nothing(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{odd}/benchmark.parquet")
    columns = ["doc_id", "n_words", "spans", "items"]

    def found(**options):
        rows = de.contamination(docs, items, **options).select(columns).collect()
        return sorted(map(str, rows))

    assert found() == found(block_bytes=300)


def test_cut_passages_are_gone_and_the_rest_stays(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    items = spark.read.parquet(f"{odd}/benchmark.parquet")
    clean = de.remove_contamination(docs, items)
    assert clean.schema == docs.schema and clean.count() == docs.count()
    before = {(r.doc_id, r.text) for r in docs.collect()}
    plain = fixtures.benchmark_rows()
    for r in clean.collect():
        if (r.doc_id, r.text) in before:
            assert not plain_hits(r.text, plain)[1]
    cut = [r for r in clean.collect() if r.doc_id == 520]
    assert [r.text for r in cut] == ["Before it,  and after."]


def test_without_a_benchmark_nothing_is_hit(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text")
    nothing = spark.createDataFrame([], "item_id long, text string")
    rows = de.contamination(docs, nothing).collect()
    assert len(rows) == docs.count() and all(r.spans == [] and r["items"] == [] for r in rows)


def test_query_equals_sql(spark, data):
    import duckdb

    from tallywatch.llm.queries import ORACLES

    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    expected = connection.execute(ORACLES["op11_decontaminate"]).fetchall()
    rows = QUERIES["op11_decontaminate"](spark, data).collect()
    assert sorted(map(tuple, rows)) == sorted(expected)
