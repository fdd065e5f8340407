"""Parquet tables that are appended to, and replaced partition by partition.

A table is split by a bucket of its key, not by the key itself: one folder per
key would mean one small file per key and day.  The number of buckets is kept
beside the table, and another number is refused.  A replacement reads only the
buckets it touches; it is computed and checkpointed first and then overwrites
them in one commit, so the plan never reads the files it replaces.  A bucket
that is left without rows gets one void row, which readers skip.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.keyed import one_row_per_key
from candlemill.workspace import checkpointed

BUCKET = "bucket"
VOID = "_void"
BUCKETS = 256


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return None


def _pin(spark: SparkSession, path: str, buckets: int) -> None:
    """Keep the number of buckets with a new table, or compare it with what is kept."""
    shape = T.StructType([T.StructField("buckets", T.IntegerType())])
    kept = _stored(spark, f"{path}/_buckets", shape)
    if kept is None:
        spark.createDataFrame([(buckets,)], shape).coalesce(1).write.parquet(f"{path}/_buckets")
    elif (known := kept.first()["buckets"]) != buckets:
        raise ValueError(f"{path} has {known} buckets, not {buckets}")


def _with_buckets(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    shape = spark.createDataFrame([], schema).schema
    whole = T.StructType(
        [*shape.fields, T.StructField(VOID, T.BooleanType()), T.StructField(BUCKET, T.IntegerType())]
    )
    stored = _stored(spark, path, whole)
    if stored is None:
        stored = spark.createDataFrame([], whole)
    return stored.where(F.col(VOID).isNull()).drop(VOID)


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType | str, only: Sequence[int] | None = None
) -> DataFrame:
    """The table without its bucket column, or ``only`` some buckets; empty where nothing was written yet."""
    rows = _with_buckets(spark, path, schema)
    if only is not None:
        rows = rows.where(F.col(BUCKET).isin(list(only)))
    return rows.drop(BUCKET)


def _clustered(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One set of files per bucket; adaptive execution splits a hot one."""
    bucketed = df.withColumns({VOID: F.lit(None).cast("boolean"), BUCKET: bucket_of(keys, buckets)})
    return bucketed.hint("rebalance", F.col(BUCKET))


def append_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    _pin(df.sparkSession, path, buckets)
    _clustered(df, keys, buckets).write.mode("append").partitionBy(BUCKET).parquet(path)


def touched_buckets(touched: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """The buckets of the ``touched`` keys; at most one number per bucket comes to the driver."""
    return sorted(row[BUCKET] for row in touched.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect())


def replace_buckets(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    keys: Sequence[str],
    touched: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    buckets: int = BUCKETS,
) -> None:
    """Replace the buckets of the ``touched`` keys by what ``change`` makes of their rows.

    Only these buckets are read, and ``change`` gives back rows of these buckets only.
    """
    _pin(spark, path, buckets)
    numbers = touched_buckets(touched, keys, buckets)
    fresh = checkpointed(_clustered(change(read_bucketed(spark, path, schema, numbers)), keys, buckets))
    left = {row[BUCKET] for row in fresh.select(BUCKET).distinct().collect()}
    if strange := left.difference(numbers):
        raise ValueError(f"rows for buckets {sorted(strange)[:5]}, which no touched key is in")
    void = spark.createDataFrame([(True, n) for n in numbers if n not in left], f"{VOID} boolean, {BUCKET} int")
    (
        fresh.unionByName(void, allowMissingColumns=True)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table bucketed by ``key``: joins and aggregates on it need no shuffle."""
    (
        df.hint("rebalance", F.col(key))
        .write.mode("overwrite")
        .option("path", path)
        .format("parquet")
        .bucketBy(buckets, key)
        .saveAsTable(name)
    )
    return df.sparkSession.read.table(name)


def export_csv(df: DataFrame, path: str, key: str, order: str) -> None:
    """CSV files below one folder per key, rows in order within a file.

    Ranges of (key, order) spread a long series over several files in sequence.
    """
    (
        df.repartitionByRange(key, order)
        .sortWithinPartitions(key, order)
        .write.mode("overwrite")
        .option("header", "true")
        .partitionBy(key)
        .csv(path)
    )


@dataclass(frozen=True)
class KeyedTable:
    """A catalog table of one row per key, bucketed and sorted by all of its key, that takes rows if absent.

    The keys' buckets are how the table lies, so an insert shuffles and sorts the batch
    only and reads the keys of the table where they are: a sort-merge anti-join
    without an exchange on the table's side, however large the table or the days that a batch spans.
    Give as many buckets as the session has shuffle partitions, or more: with fewer, Spark
    may deal both sides anew.
    """

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    def rows(self) -> DataFrame | None:
        """What is stored, or None before the first insert."""
        return self.spark.read.table(self.name) if self.spark.catalog.tableExists(self.name) else None

    def absent(self, batch: DataFrame) -> DataFrame:
        """The rows of a batch whose key is not stored, one per key; a key with a NULL is never stored."""
        fresh = one_row_per_key(batch.na.drop(subset=list(self.keys)), self.keys)
        stored = self.rows()
        if stored is None:
            return fresh
        return fresh.hint("merge").join(stored.select(*self.keys), list(self.keys), "left_anti")

    def insert(self, batch: DataFrame) -> None:
        """Append what is absent; the same batch again appends nothing.

        Rows are dealt by the very bucket they go to, so an insert writes one file for each.
        """
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))  # how Spark numbers the buckets of a table
        (
            self.absent(batch)
            .repartitionById(self.buckets, bucket)
            .write.format("parquet")
            .mode("append")
            .option("path", self.path)
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.keys)
            .saveAsTable(self.name)
        )
