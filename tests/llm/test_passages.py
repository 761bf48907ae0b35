"""The pipeline's repeats stage cuts passages by words, also short-worded ones."""

import random
from collections import Counter

import corpus_pipeline
import pytest

from tallywatch.llm import repeats


def own_words(draw, n):
    return " ".join("".join(draw.choices("bcdfghklmnp", k=9)) for _ in range(n))


def test_passages_of_over_fifty_words_are_cut(spark):
    draw = random.Random(4)
    kinds = {
        "short": " ".join("".join(draw.choices("aeiou", k=5)) for _ in range(52)),
        "tiny": " ".join(draw.choices("aeiouxyz", k=51)),
        "few": " ".join("".join(draw.choices("aeiou", k=5)) for _ in range(48)),
    }
    assert len(kinds["short"]) < 330
    rows = [(i, own_words(draw, 30) + f" {kinds[k]} " + own_words(draw, 30))
            for i, k in enumerate(["short", "short", "tiny", "tiny", "few", "few"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "n_chars", corpus_pipeline.F.length("text").cast("long"))
    cut = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, docs, "").collect()}
    for i, text in rows:
        if i < 4:
            assert len(cut[i].split()) in (59, 60, 61) and len(cut[i]) < 605
        else:
            assert cut[i] == text


def repeated_words(texts, width):
    """Plain version: of each text, which words lie in ``width`` words that stand twice."""
    words = [(t or "").split() for t in texts]
    seen = Counter(
        tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        hit = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                hit[i:i + width] = [True] * width
        out.append(hit)
    return out


def wordy_rows():
    """Passages with other white space between, periodic texts, copies, short and no texts."""
    draw = random.Random(3)
    blocks = [draw.choices(["a", "bb", "été", "d-d", "eeeeee"], k=draw.randint(8, 40))
              for _ in range(8)]
    texts = [draw.choice([" ", "\n ", "\t"]).join(w for b in draw.choices(blocks, k=draw.randint(0, 4)) for w in b)
             for _ in range(60)]
    texts += ["one two " * 40, " lone " * 30, texts[3], texts[3], f"  {texts[4]}\n", None, ""]
    return list(enumerate(texts))


@pytest.mark.parametrize("hot", [1_000_000, 1])
def test_passages_equal_plain_counting(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_BYTES", hot)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2_000)
    rows = wordy_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = {r.doc_id: r.text for r in repeats.cut_repeats(docs, 10**6, 15).collect()}
    for (doc, text), hit in zip(rows, repeated_words([t for _, t in rows], 15)):
        words = [w for w, h in zip((text or "").split(), hit) if not h]
        assert (cut[doc] or "").split() == words
        assert (cut[doc] is None) == (text is None)


def test_query_counts_passages_of_few_bytes(spark, tmp_path):
    draw = random.Random(5)
    passage = " ".join("".join(draw.choices("aeiou", k=5)) for _ in range(53))
    rows = [(1, f"{own_words(draw, 9)} {passage} {own_words(draw, 9)}"),
            (2, f"{own_words(draw, 9)}\n{passage}"), (3, own_words(draw, 90)), (4, None),
            (5, "x " * 50), (6, "x " * 52)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.n_passages, r.n_passage_words, r.n_removed)
             for r in repeats.op9_repeats(spark, str(tmp_path)).collect()}
    assert found == {1: (1, 53, 0), 2: (1, 53, 0), 3: (0, 0, 0), 4: (0, 0, 0), 5: (0, 0, 0),
                     6: (1, 52, 0)}
