"""Session settings the jobs rely on.

The number of shuffle partitions and the memory sizes belong to the cluster, so
they are not set here; adaptive execution then coalesces or splits partitions
from the sizes it measures.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str, cpus: int = 8, memory: str = "8g", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    session = (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
