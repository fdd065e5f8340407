"""Small helpers that several operators share.

Columns whose names begin with ``_llm_`` are working columns of the operators;
an input must not have them.  Where an operator adds a column the input already
has (in any case), the operator's column takes its place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words, in Java's, DuckDB's and Python's syntax alike.
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(name: str) -> Column:
    """The text of a row; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


ROWS_PER_BATCH = 2000


def modest_batches(df: DataFrame) -> DataFrame:
    """``df``, after the session's Arrow batches were limited to ``ROWS_PER_BATCH`` rows.

    Rows here are whole texts, of which Spark's default of 10,000 would fill a worker.
    The limit is a setting of the session; a smaller one is left as it is.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= ROWS_PER_BATCH:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return df


def cuts(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Offset and length of slices of about ``most`` bytes, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield start, stop - start
        start = stop


def loads(batches: Iterator[pa.Array], most: int) -> Iterator[pa.Array]:
    """The texts of an Arrow function in slices that ``cuts`` balances by bytes."""
    for batch in batches:
        for start, length in cuts(batch, most):
            yield batch.slice(start, length)


def with_columns(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """``df`` with its own columns first and ``added`` last, replacing clashing names."""
    taken = {name.lower() for name in added}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *[column.alias(name) for name, column in added.items()])
