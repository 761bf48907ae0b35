"""Session settings and the shared folder for tables that outlive a task."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
"""Keeps streaming state on disk rather than in the executors' heap."""


def build_session(app_name: str = "tallywatch", **settings: str) -> SparkSession:
    """Session in UTC with AQE; the master comes from spark-submit or ``settings``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.ui.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose pandas UDFs import it (once per session)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-process local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallywatch-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


_made: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """New folder name below the shared folder; ``remove_tables`` deletes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def made_tables(spark: SparkSession) -> list[str]:
    """The folders that this session has made below the shared folder and not removed."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def remove_tables(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete the folders that this session has made below the shared folder, or those of them
    that ``paths`` names, and the shuffle files that nothing needs.

    Results that still read from them must have been written or collected before.
    """
    jvm = spark.sparkContext._jvm
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    made = made_tables(spark)
    gone = set(made if paths is None else paths)
    _made[spark.sparkContext.applicationId] = [path for path in made if path not in gone]
    for path in made:
        if path in gone:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(settings).delete(folder, True)
    free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing holds any more. It does so when
    the driver's JVM collects its garbage, which a driver with little to do puts off."""
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder; later reads prune columns."""
    path = fresh_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """Shuffle on ``key`` into a given number of tasks, which AQE leaves alone.

    For rows that are few or narrow but costly to work on.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(min(tasks, at_most or tasks), key)
