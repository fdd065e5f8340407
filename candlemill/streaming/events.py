"""Hourly event files as a stream through the batch refinement.

The source data has no late-data rule: each landed file is refined on its own
and published, so there is no watermark and no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlemill.plans.events import NESTED, publish, refined
from candlemill.sinks.index import IndexSink
from candlemill.sources.files import split_records


def landed_lines(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """``(path, line)`` of every file that lands in ``folder``."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def landed_events(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Refined events of every file that lands in ``folder``; ``publish_landed`` also keeps the broken lines."""
    rows, _ = split_records(landed_lines(spark, folder, files_per_trigger), NESTED, "line")
    return refined(rows)


def publish_landed(
    spark: SparkSession,
    folder: str,
    sink: IndexSink,
    resource: str,
    checkpoint: str,
    loaded_at: str,
    errors: str | None = None,
) -> StreamingQuery:
    """Publish what has landed since the last run, then stop.

    ``sink`` should name an id column: a batch that is repeated after a failure
    then replaces its documents.  Broken lines go to a folder of their batch below
    ``errors``, which a repeated batch overwrites.
    """
    stamp = F.lit(loaded_at).cast("timestamp")

    def store(batch: DataFrame, number: int) -> None:
        rows, broken = split_records(batch, NESTED, "line")
        if errors is not None:
            broken.write.mode("overwrite").parquet(f"{errors}/batch={number}")
        publish(refined(rows), sink, resource, stamp)

    return (
        landed_lines(spark, folder)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
