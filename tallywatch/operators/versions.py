"""Versions of a model in one folder, of which readers see only whole ones.

A version is written to a folder of its own. It counts from the moment its marker, an empty file
with a rising number in its name, stands in ``published``: creating a file is atomic on every
file system Spark writes to, renaming a folder is not. Readers take the marker with the highest
name, so they find the version before or the one after, never parts of both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

KEPT = 3
"""Versions that stay when a newer one is published: readers may still be at the older ones."""


def _folder(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _markers(spark: SparkSession, root: str) -> list[str]:
    folder, files = _folder(spark, f"{root}/published")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(name for name in names if name[0].isdigit())


def new_version() -> str:
    return uuid.uuid4().hex


def version_path(root: str, version: str) -> str:
    return f"{root}/versions/{version}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that was published last; None if there is none."""
    markers = _markers(spark, root)
    return markers[-1].partition("-")[2] if markers else None


def publish(spark: SparkSession, root: str, version: str, kept: int = KEPT) -> None:
    """Make a version, whose folder is complete, the current one; remove all but the last
    ``kept``."""
    markers = _markers(spark, root)
    number = int(markers[-1].partition("-")[0]) + 1 if markers else 0
    marker, files = _folder(spark, f"{root}/published/{number:012d}-{version}")
    files.create(marker, False).close()
    for old in _markers(spark, root)[:-kept]:
        for path in (f"{root}/published/{old}", version_path(root, old.partition("-")[2])):
            folder, files = _folder(spark, path)
            files.delete(folder, True)
