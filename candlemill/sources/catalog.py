"""Tables of the session catalog as a frame, and SQL text over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_list(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``(name, table_type, temporary)`` of all tables and views."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, table_type string, temporary boolean")
