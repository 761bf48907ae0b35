"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again for the next one. All but the last return the columns of ``documents``. Before
a stage begins, the tables that the stage before it has stored for itself are deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm.common import stored, table
from tallywatch.llm.neardup import keep_one
from tallywatch.llm.packing import pack_documents
from tallywatch.llm.quality import keep_good
from tallywatch.llm.repeats import PASSAGE_WORDS, cut_repeats
from tallywatch.llm.secret_scan import mask_secrets
from tallywatch.session import made_tables, remove_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: dict[str, list[str]] = {}


def tidy(stage: Stage) -> Stage:
    """The stage, which first deletes what the stage before it has stored on its way. Its own
    tables stay, as its result still reads them; so do those that ``docs`` reads."""

    @wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session = spark.sparkContext.applicationId
        earlier = _left.pop(session, [])
        read = docs.inputFiles() if earlier else []
        remove_tables(spark, [path for path in earlier if not any(path in f for f in read)])
        before = set(made_tables(spark))
        result = stage(spark, docs, sf_dir)
        _left[session] = [path for path in made_tables(spark) if path not in before]
        return result

    return begin


def with_new_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


@tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio. Null and empty texts fail."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


@tidy
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of over 50 words, or strings of 400 bytes, that stand in
    several places."""
    return with_new_length(cut_repeats(docs, words=PASSAGE_WORDS))


@tidy
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return with_new_length(mask_secrets(docs))


@tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of permitted lengths that hold every document; of a null or empty text its end."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("secrets", secrets),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
