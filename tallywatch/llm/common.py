"""What the corpus operators share: reading, folds, word hashes, stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.session import (
    free_shuffles, fresh_path, made_tables, remove_tables, ship_package,
)

MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
"""Odd multipliers of the splitmix64 finaliser (fixed values)."""
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000
"""Rows of an Arrow batch."""
KNOWN_WORDS = 400_000
"""Words a task remembers before it starts a new memory; only speed depends on it."""
KNOWN_HASHES = 100_000
"""The same for words of which only the hash is remembered; an executor has several tasks, and
its Python workers keep what they took."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``. A null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % F.lit(folds)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def other_columns(df: DataFrame, added: Iterable[str]) -> list[str]:
    """Columns that stay beside added ones: neither the text nor one of the same name."""
    return [c for c in df.columns if c not in {"text", *added}]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there; later reads prune columns
    and need no lineage. The shuffles of tables stored before are freed first."""
    free_shuffles(df.sparkSession)
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stored(df: DataFrame) -> None:
    """Delete the folder of a table made by ``stored``, once nothing will read it any more."""
    folders = {file.rsplit("/", 2)[-2] for file in df.inputFiles()}  # names are unique
    remove_tables(df.sparkSession, [
        path for path in made_tables(df.sparkSession) if path.rsplit("/", 1)[1] in folders])


def prepare(spark: SparkSession) -> None:
    """Ship the package, and keep Arrow batches small: a task holds several copies of a batch,
    and texts are long. A limit that the session has set lower stays."""
    ship_package(spark)
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def map_batches(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """``mapInArrow`` with state per task: ``make()`` runs once per partition and returns a
    function from one batch to one batch."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)


def replace_columns(batch: pa.RecordBatch, drop: Iterable[str], **columns) -> pa.RecordBatch:
    """The batch without the columns ``drop`` and with new ones at its end."""
    out = {n: batch.column(n) for n in batch.schema.names if n not in set(drop)}
    out.update(columns)
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()], list(out)
    )


class WordHashes(dict):
    """64-bit hash of each word, remembered while the task runs."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= KNOWN_HASHES:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(values: np.ndarray) -> np.ndarray:
    """Spread every bit of each 64-bit value over all bits."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(MIX[0])
    v ^= v >> np.uint64(27)
    v *= np.uint64(MIX[1])
    v ^= v >> np.uint64(31)
    return v


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for every run of ``width`` consecutive words, order included."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out *= np.uint64(MIX[0])
        out += hashes[i:i + n]
        out ^= out >> np.uint64(29)
    return mix64(out)


def hashed_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, those with the smallest key hash: the same for any layout."""
    return df.orderBy(F.xxhash64(key), key).limit(limit)
