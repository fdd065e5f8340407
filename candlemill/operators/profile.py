"""Frames that describe a frame: schema, column summary, partition sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def schema_frame(df: DataFrame) -> DataFrame:
    """``(name, type, nullable, known)`` per column; ``known`` counts the values that are not NULL."""
    described = [
        F.struct(
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.lit(field.nullable).alias("nullable"),
            F.count(F.col(f"`{field.name}`")).alias("known"),
        )
        for field in df.schema.fields
    ]
    return df.agg(F.array(*described).alias("columns")).select(F.inline("columns"))


def exact_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_summary`` with exact quartiles, for which ``df`` is read a few times more."""
    summary = column_summary(df, columns)
    exact = exact_quantiles(df, columns, QUARTILES)
    wide = exact.groupBy("column").agg(
        *[F.max(F.when(F.col("quantile") == q, F.col("value"))).alias(name) for q, name in zip(QUARTILES, ("q1", "median", "q3"))]
    )
    return summary.drop("q1", "median", "q3").join(wide, "column").select(summary.columns)


def column_summary(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Count, mean, stddev, min, approximate quartiles and max, one row per column.

    All columns are aggregated in one scan.
    """
    stats = []
    for name in columns:
        col = F.col(name).cast("double")
        quartiles = F.percentile_approx(col, list(QUARTILES), accuracy)
        stats.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(col).alias("n"),
                F.avg(col).alias("mean"),
                F.stddev(col).alias("stddev"),
                F.min(col).alias("min"),
                quartiles[0].alias("q1"),
                quartiles[1].alias("median"),
                quartiles[2].alias("q3"),
                F.max(col).alias("max"),
            )
        )
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows held by each partition, counted in place."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def partition_rows(df: DataFrame) -> DataFrame:
    """``df`` with each row's ``partition`` and its ``place`` there, from 0: the array of a partition, as rows.

    An array in one cell would have to fit a task; rows with their place say the same.
    """
    number = F.monotonically_increasing_id()  # the partition, then 33 bits that count its rows
    return df.withColumn("_number", number).select(
        F.shiftright("_number", 33).cast("int").alias("partition"),
        F.col("_number").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        *df.columns,
    )


def hash_bucket_rows(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows, different keys, and smallest and largest key of each bucket that a hash of the key deals to."""
    key = F.struct(*keys)
    bucket = F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")
    # One row per key first, so that a key is counted once without a list of the bucket's keys.
    of_keys = df.groupBy(bucket, key.alias("key")).agg(F.count("*").alias("n"))
    return of_keys.groupBy("bucket").agg(
        F.sum("n").alias("rows"), F.count("*").alias("keys"), F.min("key").alias("first"), F.max("key").alias("last")
    )


def counts_by(df: DataFrame, keys: Sequence[str | Column], conditions: Mapping[str, Column]) -> DataFrame:
    """Rows that meet each condition, per key, in one pass."""
    return df.groupBy(*keys).agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
