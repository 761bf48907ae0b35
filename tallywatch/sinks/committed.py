"""Documents as a stream sink with a commit per batch.

Tasks write to a staging folder that readers do not see. When all tasks of a batch have ended,
one rename makes their files the batch's folder; a batch that fails leaves nothing, and one that
runs again after its commit finds its folder and drops what it has written. Files of lost task
attempts are not among the committed ones.

    register(spark)
    stream_documents(documents, "hdfs://.../documents").option("checkpointLocation", ...).start()
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tallywatch.session import ship_package
from tallywatch.sinks.documents import DOCUMENT_ID, check_document_schema

FORMAT = "committed_documents"
STAGING = "_staging"
"""Names that begin with an underscore are no data for Spark's readers."""


@dataclass
class Written(WriterCommitMessage):
    """The file of one task, and its documents; no file without documents."""

    file: str | None
    n_documents: int


class DocumentWriter(DataSourceStreamArrowWriter):
    """Writes rows of (id, json); documents without id fail the batch."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def store(self) -> tuple[fs.FileSystem, str]:
        """File system and path in it: local, HDFS or an object store, by the path's scheme."""
        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = self.store()
        name, n, out = f"part-{uuid.uuid4().hex}.json", 0, None
        try:
            for batch in iterator:
                if batch.column(DOCUMENT_ID).null_count:
                    raise ValueError("a document has no id")
                if not batch.num_rows:
                    continue
                if out is None:
                    files.create_dir(f"{root}/{STAGING}", recursive=True)
                    out = files.open_output_stream(f"{root}/{STAGING}/{name}")
                lines = "\n".join(batch.column("json").to_pylist()) + "\n"
                out.write(lines.encode())
                n += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if n else None, n)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        files, root = self.store()
        final, mine = f"{root}/batch_id={batchId}", f"{root}/{STAGING}-{uuid.uuid4().hex}"
        names = [m.file for m in messages if m is not None and m.file]
        if files.get_file_info(final).type != fs.FileType.NotFound:  # committed before
            self.discard(files, root, names)
            return
        files.create_dir(mine, recursive=True)
        for name in names:
            files.move(f"{root}/{STAGING}/{name}", f"{mine}/{name}")
        files.move(mine, final)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        files, root = self.store()
        self.discard(files, root, [m.file for m in messages if m is not None and m.file])

    @staticmethod
    def discard(files: fs.FileSystem, root: str, names: list[str]) -> None:
        for name in names:
            place = f"{root}/{STAGING}/{name}"
            if files.get_file_info(place).type != fs.FileType.NotFound:
                files.delete_file(place)


class DocumentSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> DocumentWriter:
        if schema.names != [DOCUMENT_ID, "json"]:
            raise ValueError(f"expected the columns {DOCUMENT_ID} and json, not {schema.names}")
        return DocumentWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the sink known to the session and its executors."""
    ship_package(spark)
    spark.dataSource.register(DocumentSink)


def stream_documents(documents: DataFrame, path: str) -> DataStreamWriter:
    """Writer for shaped documents; the folder must be one that all executors reach."""
    register(documents.sparkSession)
    checked = check_document_schema(documents)
    lines = checked.select(
        DOCUMENT_ID, F.to_json(F.struct(*checked.columns)).alias("json"))
    return lines.writeStream.outputMode("append").format(FORMAT).option("path", path)


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Committed documents, with the batch that brought them."""
    return spark.read.schema(schema).json(path)
