"""Quality rules: base text rules and a hashed n-gram likelihood ratio.

Words and word pairs are hashed into ``BUCKETS`` buckets. One multinomial is estimated from
trusted documents, one from the whole corpus; a document's verdict is the difference of its
log-likelihoods under both, divided by its number of n-grams, against a threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.common import (
    WordHashes, map_batches, other_columns, prepare, replace_columns, stored, table,
    text_or_empty, window_hashes,
)

BUCKETS = 10_000
MARKS = 1 << 19
"""Rows of 64 bits that mark labelled ids."""
SMOOTHING = 1.0
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    """Bucket of every word and of every pair of neighbouring words."""
    both = np.concatenate([window_hashes(hashes, 1), window_hashes(hashes, 2)])
    return (both % np.uint64(BUCKETS)).astype(np.int64)


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur at two or more places."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    starts = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str, hashes: np.ndarray, raw: bytes) -> tuple[int, int, int, int]:
    """Characters in words, symbols, duplicate lines, words in repeated windows."""
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return (
        len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(hashes),
    )


@dataclass
class QualityModel:
    """Log ratio of target to raw probability by bucket, and the smallest score kept."""

    ratio: np.ndarray
    threshold: float

    def score(self, hashes: np.ndarray) -> float:
        return float(self.ratio[buckets_of(hashes)].mean()) if len(hashes) else 0.0


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, trusted) of all labelled ids; one with both labels counts as not trusted."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    return known.groupBy("doc_id").agg(F.min("quality").alias("trusted"))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, trusted) of all rows with a labelled id. Bits at the ids' hashes, bounded
    in number, keep most other texts out of the shuffle; the join decides."""
    ids = trusted_ids(labels)
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    place = {"at": F.pmod(hashed, F.lit(MARKS)), "bit": F.shiftrightunsigned(hashed, 58).cast("int")}
    marks = ids.withColumns(place).groupBy("at").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    likely = docs.select("doc_id", text_or_empty()).withColumns(place).join(
        F.broadcast(marks), "at").filter("getbit(bits, bit) = 1").select("doc_id", "text")
    return likely.join(ids.hint("merge"), "doc_id")


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """N-grams of all texts by bucket."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = WordHashes(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                found = buckets_of(words.of(text.as_py().encode().split()))
                total += np.bincount(found, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    parts = docs.select("text").mapInArrow(count, "bucket long, n long")
    counts = np.zeros(BUCKETS)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # at most BUCKETS rows
        counts[bucket] = n
    return counts


def best_threshold(scores: np.ndarray, trusted: np.ndarray) -> float:
    """Cut with the best sum of both classes' hit rates; the lowest such cut. Without both
    classes nothing is cut. For scores that fit in memory; ``threshold_of`` takes any number."""
    if not (trusted == 1).any() or not (trusted == 0).any():
        return float("-inf")
    order = np.argsort(scores, kind="stable")
    ranked, good = scores[order], trusted[order] == 1
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    caught = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    # a cut lies between two different scores
    real = np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])
    at = int(np.argmax(np.where(real, caught - lost, -2.0)))
    if at == 0:
        return float("-inf")
    return float(ranked[at]) if at == len(ranked) else float((ranked[at - 1] + ranked[at]) / 2)


def threshold_of(scored: DataFrame) -> float:
    """``best_threshold`` of all rows (trusted, llr): running counts per range of scores,
    shifted by those of the ranges before."""
    by_score = scored.groupBy("llr").agg(
        F.sum("trusted").alias("good"), F.sum(1 - F.col("trusted")).alias("bad"))
    placed = stored(
        by_score.repartitionByRange("llr").withColumn("run", F.spark_partition_id()), "scores")
    # one row per range, so one task may see all of them
    ahead = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("run").agg(
        F.sum("good").alias("g"), F.sum("bad").alias("b"), F.max("llr").alias("last"))
    shifts = runs.select(
        "run", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_ahead") for c in "gb"],
        F.max("last").over(ahead).alias("last_ahead"))
    total = runs.agg(F.sum("g").alias("g"), F.sum("b").alias("b")).first()
    if not total.g or not total.b:
        return float("-inf")
    inside = Window.partitionBy("run").orderBy("llr")
    lower = inside.rowsBetween(Window.unboundedPreceding, -1)
    cuts = placed.select(
        "run", "llr", F.lag("llr").over(inside).alias("below"),
        *[F.coalesce(F.sum(c).over(lower), F.lit(0)).alias(c) for c in ("good", "bad")],
    ).join(F.broadcast(shifts), "run")
    # the hit rates over a common denominator: whole numbers, so equal cuts tie
    gain = ((F.col("bad") + F.col("b_ahead")) * F.lit(total.g)
            - (F.col("good") + F.col("g_ahead")) * F.lit(total.b))
    best = cuts.select(
        gain.alias("gain"), "llr", F.coalesce("below", "last_ahead").alias("below"),
    ).orderBy(F.desc("gain"), "llr").first()
    return float("-inf") if best.gain <= 0 else (best.below + best.llr) / 2


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Both multinomials and the threshold: the raw one from every document, the target one
    from every trusted document, the threshold from every labelled one. Without trusted
    documents every ratio is 0 and nothing is rejected by it."""
    known = stored(labelled_texts(docs, labels), "labelled")
    target = bucket_counts(known.filter("trusted = 1"))
    if not target.sum():
        return QualityModel(np.zeros(BUCKETS), float("-inf"))

    def log_share(counts: np.ndarray) -> np.ndarray:
        return np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * BUCKETS))

    model = QualityModel(log_share(target) - log_share(bucket_counts(docs.select(text_or_empty()))), float("-inf"))
    scored = (
        score_quality(known, model).filter("not base_failed").groupBy("doc_id")
        .agg(F.max("trusted").alias("trusted"), F.min("llr").alias("llr"))
    )
    return QualityModel(model.ratio, threshold_of(scored))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns but ``text``, followed by the base counts, ``llr`` and both verdicts.

    Columns with the name of an added one are replaced. A null text counts as empty. ``llr`` of a text without words is 0; it fails the base
    rules anyway.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    added = StructType.fromDDL(f"{BASE}, llr double, base_failed boolean, kept boolean")
    others = other_columns(docs, added.names)
    fields = [docs.schema[c] for c in others]
    schema = StructType(fields + added.fields)

    def make():
        words, fitted = WordHashes(), shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                raw = text.encode()
                hashes = words.of(raw.split())
                base = base_counts(text, hashes, raw)
                failed = len(hashes) < MIN_WORDS or 100 * base[3] > MAX_REPEAT_PERCENT * len(hashes)
                llr = fitted.score(hashes)
                rows.append((len(hashes), *base, llr, failed,
                             not failed and llr >= fitted.threshold))
            columns = list(zip(*rows))
            types = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]
            names = [f.name for f in schema.fields[len(fields):]]
            return replace_columns(
                batch, ["text"], **{n: pa.array(c, t) for n, c, t in zip(names, columns, types)}
            )

        return step

    return map_batches(docs.select(*others, text_or_empty()), make, schema)


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every document of ``documents``."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score_quality(docs, fit_quality(docs, table(spark, folder, "labels")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    whole = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return score_quality(whole, fit_quality(docs, labels)).filter("kept").select("row.*")
