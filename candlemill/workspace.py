"""Folders shared by the whole cluster, for written intermediate tables.

Lineage is cut by writing a table below ``spark.checkpoint.dir`` and reading it
back, so a lost executor never loses an intermediate result.

Nothing of this outlives the run: what was written is removed when the driver
ends, or earlier, at the end of the ``scratch`` block it was made in.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="candlemill-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


#: Folders and tables of the open ``scratch`` blocks, the innermost last.
_open: list[tuple[list[str], list[str]]] = []
#: Folders of this driver that may still be there.
_made: dict[str, SparkSession] = {}


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared root that nothing has used before."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made[path] = spark
    if _open:
        _open[-1][0].append(path)
    return path


def new_table(label: str) -> str:
    """A catalog name that nothing has used before; its files go to a ``new_folder``."""
    name = f"{label}_{uuid.uuid4().hex}"
    if _open:
        _open[-1][1].append(name)
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, through the file system by which Spark itself reaches it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
    _made.pop(path, None)


@atexit.register
def remove_all() -> None:
    """Remove what is left of this driver's folders; a driver that was stopped by force leaves its folders."""
    for path, spark in list(_made.items()):
        try:
            remove(spark, path)
        except (Py4JError, AttributeError, OSError):  # the session or its JVM has ended already
            return


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders and tables made inside the block are removed at its end, so what is kept must be written elsewhere."""
    _open.append(([], []))
    try:
        yield
    finally:
        folders, tables = _open.pop()
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in folders:
            remove(spark, path)


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    return written_to(df, new_folder(df.sparkSession, label), partition_by)


def written_to(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """``written`` to a folder that the caller has from ``new_folder``."""
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the shared folder until nothing refers to it any more.

    Spark removes such files itself where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    shared_root(df.sparkSession)
    return df.checkpoint()
