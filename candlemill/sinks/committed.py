"""A sink that shows a batch whole or not at all.

Every task writes its rows to a file of its own below ``data``, under a name that nothing else
has, and tells the driver which one.  Only when all tasks are done does the driver
write the batch's manifest, the list of these files, in one move.  Readers look
at manifests alone, so files of failed, repeated or speculative tasks are never
read; a failed write removes what it left.  A batch that is written again
under its name replaces its manifest, so a job may simply be repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "committed"


@dataclass
class Part(WriterCommitMessage):
    """What a task has written."""

    file: str | None
    rows: int


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: str):
        self.path, self.batch, self.attempt = path, batch, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        files, root = _located(self.path)
        files.create_dir(f"{root}/data", recursive=True)
        name, writer, rows = f"{self.attempt}-{uuid.uuid4().hex}.parquet", None, 0
        for batch in iterator:
            if writer is None:
                writer = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=files)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return Part(None, 0)
        writer.close()
        return Part(name, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = _located(self.path)
        files.create_dir(f"{root}/manifests", recursive=True)
        listed = [{"batch": self.batch, "file": part.file, "rows": part.rows} for part in messages if part and part.file]
        told = "\n".join(json.dumps(entry) for entry in listed or [{"batch": self.batch, "file": None, "rows": 0}])
        with files.open_output_stream(f"{root}/manifests/.{self.attempt}") as out:
            out.write((told + "\n").encode())
        files.move(f"{root}/manifests/.{self.attempt}", f"{root}/manifests/{self.batch}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = _located(self.path)
        for entry in files.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True)):
            if entry.base_name.startswith(self.attempt):
                files.delete_file(entry.path)


class Committed(DataSource):
    """``df.write.format("committed").option("path", ..).option("batch", ..)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"], self.options["batch"])


def write_committed(df: DataFrame, path: str, batch: str) -> None:
    """Write ``df`` as the batch of that name; a failure leaves what was committed before."""
    if not batch or "/" in batch or batch.startswith("."):
        raise ValueError(f"{batch!r} can't name a manifest")
    df.sparkSession.dataSource.register(Committed)
    df.write.format(FORMAT).mode("append").option("path", path).option("batch", batch).save()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """``(batch, file, rows)`` of all that was committed."""
    shape = "batch string, file string, rows long"
    try:
        return spark.read.schema(shape).json(f"{path}/manifests/*.json").where(F.col("file").isNotNull())
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], shape)


def read_committed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all committed batches; the driver sees the list of files, as in any scan."""
    files = [f"{path}/data/{row['file']}" for row in manifests(spark, path).select("file").toLocalIterator()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
