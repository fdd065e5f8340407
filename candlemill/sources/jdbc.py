"""JDBC reads that split into parallel partitions.

A plain read of a table is one partition over one connection.  Two ways to
split it: bounds on a numeric or date column, or a list of predicates, which is
the only way for text keys such as codes.  The database driver jar is the
caller's; drivers that buffer whole results need their cursor option in ``url``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per round trip.
FETCH_SIZE = 1000


def read_options(
    url: str, table: str | None = None, query: str | None = None, fetch_size: int = FETCH_SIZE, **more: str
) -> dict[str, str]:
    """Options for a table or for the result of a SQL query (one of the two)."""
    if (table is None) == (query is None):
        raise ValueError("name a table or give a query")
    source = {"dbtable": table} if table is not None else {"query": query}
    return {"url": url, "fetchsize": str(fetch_size), **source, **more}


def bounded_options(column: str, lower: object, upper: object, partitions: int) -> dict[str, str]:
    """Split by equal strides of a numeric or date column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def range_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """Predicates that cover every value of a text column once, NULL included.

    ``bounds`` are the inner borders in ascending order; n borders give n + 1
    partitions.
    """
    if list(bounds) != sorted(set(bounds)):
        raise ValueError("borders must ascend without repeats")
    quoted = ["'" + text.replace("'", "''") + "'" for text in bounds]
    if not quoted:
        return ["1 = 1"]
    first = f"{column} < {quoted[0]} OR {column} IS NULL"
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(quoted, quoted[1:])]
    return [first, *inner, f"{column} >= {quoted[-1]}"]


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def read_by_predicates(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: Mapping[str, str]
) -> DataFrame:
    """One partition and one connection per predicate."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
