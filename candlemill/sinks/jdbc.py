"""Batched JDBC append."""

from __future__ import annotations

from pyspark.sql import DataFrame

BATCH_SIZE = 10_000


def append_options(url: str, table: str, connections: int, batch_size: int = BATCH_SIZE, **more: str) -> dict[str, str]:
    """``connections`` caps how many tasks write at once."""
    return {"url": url, "dbtable": table, "numPartitions": str(connections), "batchsize": str(batch_size), **more}


def append_table(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()
