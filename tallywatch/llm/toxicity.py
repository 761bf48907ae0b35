"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has probability p = sigmoid(bias + sum of word
weights); the document's is the noisy-or 1 - prod(1 - p). Only document labels are known;
the gradient through the noisy-or tells which sentences carry the label, so the fitted
model also locates them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.common import (
    KNOWN_WORDS, fold, hashed_sample, map_batches, other_columns, replace_columns, table,
    text_or_empty,
)

FEATURES = 1 << 18
PREFIXES = (3, 4, 5, 6, 7)
SAMPLE_PER_CLASS = 5_000
"""Labelled training rows of each class, at most; their weights restore the class shares."""
FOLDS = 5
MIN_DOCUMENTS = 5
"""Different (document, word) pairs in which a feature must occur to get a weight."""
EPOCHS = 120
RATE = 0.1
SHRINK = 1e-4
START_BIAS = -7.0
SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]*")
EDGES = " \t\r\x0b\x0c.,;:!?\"'()[]{}<>|*#$%&-_"


def sentence_spans(text: str) -> Iterator[tuple[int, int]]:
    """Sentences end after ``.``, ``!``, ``?`` or a line break; blank ones are left out."""
    for found in SENTENCE.finditer(text):
        if found.group().strip(EDGES + "\n"):
            yield found.span()


def core(word: str) -> str:
    """The word in lower case without punctuation at its edges."""
    return word.strip(EDGES).lower()


def features(plain: str) -> list[int]:
    """Buckets of a whole word and of its beginnings, which inflected forms share."""
    marks = [f"{plain}$"] + [plain[:n] for n in PREFIXES if n < len(plain)]
    return [xxhash.xxh64_intdigest(m.encode()) % FEATURES for m in marks] if plain else []


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def sentence_logits(self, text: str, known: dict[str, float]) -> list[tuple[int, int, float]]:
        out = []
        for start, end in sentence_spans(text):
            total = self.bias
            for word in text[start:end].split():
                weight = known.get(word)
                if weight is None:
                    weight = float(self.weights[features(core(word))].sum())
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    known[word] = weight
                total += weight
            out.append((start, end, total))
        return out


def noisy_or(logits: np.ndarray) -> float:
    """Probability that at least one sentence is toxic; 0 without sentences."""
    return float(-np.expm1(-np.logaddexp(0.0, logits).sum())) if len(logits) else 0.0


def training_rows(docs: DataFrame, labels: DataFrame, training: Column, limit: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``limit`` labelled documents per class.

    Ids are chosen by hash before the texts are read; an id with both labels counts as
    toxic, repeated rows of an id count once.
    """
    by_id = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & training)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    totals = {row.toxic: row["count"] for row in by_id.groupBy("toxic").count().collect()}
    parts = [
        hashed_sample(by_id.filter(F.col("toxic") == c), "doc_id", limit)
        .withColumn("weight", F.lit(max(1.0, totals.get(c, 0) / limit)))
        for c in (0, 1)
    ]
    ids = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * limit ids
    return (
        docs.select("doc_id", text_or_empty()).join(ids, "doc_id")
        .groupBy("doc_id", "toxic", "weight").agg(F.min("text").alias("text"))
    )


def bags(rows: DataFrame) -> DataFrame:
    """Documents as plain words: ``words`` in order and ``sizes`` of sentences."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, sizes = [], []
            for value in batch.column("text"):
                text, own, counts = value.as_py(), [], []
                for start, end in sentence_spans(text):
                    plain = [c for c in map(core, text[start:end].split()) if c]
                    if plain:
                        own += plain
                        counts.append(len(plain))
                words.append(own)
                sizes.append(counts)
            return replace_columns(
                batch, ["text"], words=pa.array(words, pa.list_(pa.string())),
                sizes=pa.array(sizes, pa.list_(pa.int32())),
            )

        return step

    schema = "toxic int, weight double, words array<string>, sizes array<int>"
    return map_batches(rows.select(F.col("toxic").cast("int"), "weight", "text"), make, schema)


def incidence(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of every word."""
    found = [features(word) for word in vocabulary]
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    return owner, np.fromiter((x for f in found for x in f), np.int64, len(owner))


def fit_bags(
    vocabulary: list[str], words: np.ndarray, sizes: np.ndarray, counts: np.ndarray,
    toxic: np.ndarray, weight: np.ndarray,
) -> ToxicityModel:
    """Maximum likelihood with a small absolute penalty, by Adam over the whole sample.

    ``words`` are the numbers of all words in order, ``sizes`` the words of each sentence,
    ``counts`` the sentences of each document (all at least 1).
    """
    document = np.repeat(np.arange(len(counts)), counts)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    pairs = np.unique(document[sentence].astype(np.int64) * len(vocabulary) + words)
    spread = np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
    owner, bucket = incidence(vocabulary)
    columns = np.flatnonzero(np.bincount(bucket, spread[owner], FEATURES) >= MIN_DOCUMENTS)
    place = np.full(FEATURES, -1)
    place[columns] = np.arange(len(columns))
    real = place[bucket] >= 0
    owner, used = owner[real], place[bucket[real]]
    n = len(columns)
    theta = np.append(np.zeros(n), START_BIAS)
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    share = weight / weight.sum()
    for step in range(1, EPOCHS + 1):
        by_word = np.bincount(owner, theta[used], len(vocabulary))
        logits = np.bincount(sentence, by_word[words], len(sizes)) + theta[n]
        p = np.exp(-np.logaddexp(0.0, -logits))
        clear = -np.bincount(document, np.logaddexp(0.0, logits), len(counts))
        whole = np.maximum(-np.expm1(clear), 1e-9)
        pull = np.where(toxic == 1, np.exp(clear) / whole, -1.0) * share
        by_sentence = p * pull[document]
        on_word = np.bincount(words, by_sentence[sentence], len(vocabulary))
        gradient = np.append(
            np.bincount(used, on_word[owner], n) - SHRINK * np.sign(theta[:n]),
            by_sentence.sum(),
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        scale = np.sqrt(second / (1 - 0.99 ** step)) + 1e-8
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / scale
    weights = np.zeros(FEATURES, np.float32)
    weights[columns] = theta[:n]
    return ToxicityModel(weights, float(theta[n]))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, training: Column | None = None,
    limit: int = SAMPLE_PER_CLASS,
) -> ToxicityModel:
    """Model from the labelled documents for which ``training`` holds.

    Documents without words are left out; if one class is missing, every weight is 0 and
    the bias gives scores near 0 or, without clean rows, near 1.
    """
    sample = bags(training_rows(docs, labels, F.lit(True) if training is None else training, limit))
    rows = sample.toArrow()  # at most 2 * limit documents
    sizes = rows.column("sizes").combine_chunks()
    counts = sizes.value_lengths().to_numpy(zero_copy_only=False)
    toxic, weight = (rows.column(c).to_numpy() for c in ("toxic", "weight"))
    full = counts > 0
    if not (toxic[full] == 1).any() or not (toxic[full] == 0).any():
        sign = 1 if (toxic[full] == 1).any() else -1
        return ToxicityModel(np.zeros(FEATURES, np.float32), -START_BIAS * sign)
    words = pc.dictionary_encode(rows.column("words").combine_chunks().flatten())
    return fit_bags(
        words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False),
        sizes.flatten().to_numpy(zero_copy_only=False), counts[full], toxic[full], weight[full],
    )


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``score``, ``predicted`` and ``sentences``: the
    (start, end, score) of every sentence that is toxic by itself (0.5 or more), in code
    points. Columns with the name of an added one are replaced. A null or empty text scores 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers
    added = StructType.fromDDL(
        "score double, predicted int, n_sentences long, "
        "sentences array<struct<start: int, end: int, score: double>>")
    others = other_columns(docs, added.names)
    schema = StructType([docs.schema[c] for c in others] + added.fields)
    found = pa.list_(pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def make():
        fitted, known = shared.value, {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores, numbers, offending = [], [], []
            for value in batch.column("text"):
                spans = fitted.sentence_logits(value.as_py() or "", known)
                scores.append(noisy_or(np.array([s[2] for s in spans])))
                numbers.append(len(spans))
                offending.append([
                    {"start": a, "end": b, "score": float(1 / (1 + np.exp(-x)))}
                    for a, b, x in spans if x >= 0
                ])
            return replace_columns(
                batch, ["text"], score=pa.array(scores, pa.float64()),
                predicted=pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                n_sentences=pa.array(numbers, pa.int64()),
                sentences=pa.array(offending, found),
            )

        return step

    return map_batches(docs.select(*others, text_or_empty()), make, schema)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a model that never sees the labels of fold 0."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), FOLDS) == 0
    model = fit_toxicity(docs, table(spark, folder, "labels"), ~held_out)
    scored = score_toxicity(docs.withColumn("held_out", held_out), model)
    return scored.select(
        "doc_id", "held_out", "score", "predicted", "n_sentences",
        F.size("sentences").alias("n_toxic_sentences"),
        F.array_max("sentences.score").alias("top_sentence_score"),
    )
