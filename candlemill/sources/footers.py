"""Counts, smallest and largest values of stored Parquet tables from file footers.

Parquet keeps both per row group, so no data page has to be read.  Spark uses them
when its newer reader handles the scan and the aggregate has no filter beyond
partition columns; the two settings that takes are made in a session of their own, so
the caller's stays as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
FUNCTIONS = {"count": F.count, "min": F.min, "max": F.max}
# Types whose smallest and largest values footers hold in full.
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


def footer_aggregates(
    spark: SparkSession,
    path: str,
    wanted: Mapping[str, tuple[str, str]],
    by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """``wanted`` maps a name to (``count``, ``min`` or ``max``, column); ``("count", "*")`` counts rows.

    ``by`` names partition columns (folders).  Footers cut long texts short, so a
    smallest or largest text raises an error.
    """
    own = spark.newSession()
    for name, value in SETTINGS.items():
        own.conf.set(name, value)
    table = (own.read if schema is None else own.read.schema(schema)).parquet(path)
    for function, column in wanted.values():
        if function != "count" and not isinstance(table.schema[column].dataType, EXACT):
            raise TypeError(f"footers have no exact {function} of {column}")
    aggregates = [FUNCTIONS[function](column).alias(name) for name, (function, column) in wanted.items()]
    return table.groupBy(*by).agg(*aggregates) if by else table.agg(*aggregates)


def high_water_mark(spark: SparkSession, path: str, column: str):
    """The largest value of a column of a stored table, NULL where it is empty."""
    return footer_aggregates(spark, path, {"mark": ("max", column)}).first()["mark"]
