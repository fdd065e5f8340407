"""Landed event files: JSON lines by path or glob, one hourly archive day."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOURS = 24
_BROKEN = "_broken_record"


def split_records(lines: DataFrame, schema: T.StructType | str, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)`` of JSON lines: the records, and the lines that are not as the schema says.

    A line that is cut off or no JSON object gives no row.  A whole object with a value
    that its column cannot hold gives a row with NULL there.  Both are told in ``errors``,
    which has the columns of ``lines`` and ``kept``, whether there is a row.  Blank lines
    are neither.  What counts as an error does not depend on the columns that are read later.
    """
    shape = lines.sparkSession.createDataFrame([], schema).schema
    whole = T.StructType([*shape.fields, T.StructField(_BROKEN, T.StringType())])
    record = F.from_json(F.col(line), whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    # Out of a generator, the record is parsed once and not again in each condition.
    told = lines.where(F.trim(line) != "").select("*", F.explode(F.array(record)).alias("_record"))
    # A top-level list would be read up to its first record only.
    single = F.ltrim(line).startswith("{") & F.col("_record").isNotNull()
    fits = F.col(f"_record.{_BROKEN}").isNull()
    rows = told.where(single & (fits | F.try_parse_json(line).isNotNull()))
    errors = told.where(~(single & fits)).withColumn("kept", single & F.try_parse_json(line).isNotNull())
    return rows.select(*[F.col(f"_record.`{field.name}`") for field in shape]), errors.drop("_record")


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)`` of JSON lines; ``errors`` has the columns ``path``, ``line`` and ``kept`` (see ``split_records``).

    With a schema, a path that matches nothing gives two empty frames.  Without a
    schema it is inferred from the lines that are whole, and a missing path raises,
    as there is nothing to shape an empty frame by.  At scale always give a
    schema: inference reads the data twice.
    """
    try:
        if schema is None:
            found = spark.read.option("mode", "DROPMALFORMED").json(path).schema
            schema = T.StructType([field for field in found if field.name != "_corrupt_record"])
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    except AnalysisException as error:
        if schema is None or "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        lines = spark.createDataFrame([], "path string, line string")
    return split_records(lines, schema, "line")


def errors_per_file(errors: DataFrame) -> DataFrame:
    """Lines with errors of each file that has any: ``(path, lines, lost)``, ``lost`` being those without a row."""
    return errors.groupBy("path").agg(F.count("*").alias("lines"), F.count_if(~F.col("kept")).alias("lost"))


def archive_hours(root: str, day: str, suffix: str = "json.gz") -> list[str]:
    """The hourly files of one day, hour 0 to hour 23."""
    return [f"{root}/{day}-{hour}.{suffix}" for hour in range(HOURS)]


def read_archive_day(
    spark: SparkSession, root: str, day: str, schema: T.StructType | str, partitions: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)`` of all hourly files ``<root>/<day>-<hour>.json*`` of one day.

    A gzip file is read by one task however large it is; ``partitions`` spreads
    its rows before the work that follows.
    """
    rows, errors = read_json(spark, f"{root}/{day}-*.json*", schema)
    return (rows if partitions is None else rows.repartition(partitions)), errors


def expired_files(spark: SparkSession, path: str, cutoff: Column, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """Landed files whose name carries a date before ``cutoff``.

    Only the listing is read, never the contents.  The result names candidates;
    removing them stays with the operator.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return (
        listing.select("path", "modificationTime", "length")
        .withColumn("landed", F.try_to_date(F.regexp_extract("path", pattern, 1), "yyyy-MM-dd"))
        .where(F.col("landed") < cutoff)
    )
