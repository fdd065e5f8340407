"""Many per-code tables into one, in a single scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.operators.keyed import subtract_rows
from candlemill.workspace import written


def codes_to_move(listed: DataFrame, old_store: DataFrame, new_store: DataFrame, code: str) -> DataFrame:
    """Listed codes that only the old store has."""
    return listed.select(code).intersect(old_store.select(code).subtract(new_store.select(code)))


def consolidated(
    spark: SparkSession, root: str, schema: T.StructType | str, codes: Sequence[str] | None = None, code: str = "code"
) -> DataFrame:
    """Distinct rows of all tables ``<root>/<code>.parquet`` with their code.

    A table is a folder of part files or one plain file.  The code is read off
    the file path, so any number of tables is one scan and one job, not one job
    per table.  Blanks, non-ASCII letters and other characters that a path
    encodes are decoded.  With ``codes``, only their tables are opened.  A path
    that names no code raises an error.
    """
    reader = spark.read.schema(schema)
    tables = reader.parquet(f"{root}/*.parquet") if codes is None else reader.parquet(*[f"{root}/{c}.parquet" for c in codes])
    # A path is percent-encoded, but a plus sign in it is a plus sign.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    named = F.regexp_extract(path, r"/([^/]+)\.parquet(?:/[^/]*)?$", 1)
    checked = F.when(named != "", named).otherwise(F.raise_error(F.concat(F.lit("no code in "), path)))
    return tables.withColumn(code, checked).select(*tables.columns, code).distinct()


def consolidate_into(
    spark: SparkSession,
    name: str,
    path: str,
    root: str,
    schema: T.StructType | str,
    codes: Sequence[str] | None = None,
    code: str = "code",
) -> DataFrame:
    """Create the catalog table ``name`` at ``path`` if it is missing and insert the rows it does not have.

    Rows compare as a whole, so days that a per-code table gained since the last run
    are inserted, and running it again inserts nothing.
    """
    shape = spark.createDataFrame([], schema).schema.add(code, T.StringType())
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in shape)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")
    fresh = subtract_rows(consolidated(spark, root, schema, codes, code), spark.read.table(name))
    written(fresh, "consolidated").write.mode("append").insertInto(name)
    return spark.read.table(name)
