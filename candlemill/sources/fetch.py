"""Fetch per request row, in parallel, at a fixed pace, without losing a failure."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from candlemill.workspace import written

# Calls a task makes before it passes their outcomes on.
CALLS_PER_BATCH = 64


def _outcome(requests: DataFrame, schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("request", requests.schema),
            T.StructField("error", T.StringType()),
            T.StructField("rows", T.ArrayType(schema)),
        ]
    )


def _caller(fetch: Callable[[Mapping], Mapping[str, Sequence]], item: pa.StructType, pause: float):
    """One paced call: (error or None, rows), the rows as equally long lists or, of other answers, as an array."""
    fields = list(item)

    def call(request: dict) -> tuple[str | None, list[list] | pa.Array]:
        if pause:  # a sleep of no time costs more than a short answer
            time.sleep(pause)
        try:
            answer = fetch(request)
            columns = [answer[field.name] for field in fields]
            if all(type(column) is list and len(column) == len(columns[0]) for column in columns):
                return None, [column[:] for column in columns]  # the caller may use its lists again
            return None, _as_array(columns, fields)
        except Exception as failure:  # noqa: BLE001 - any failure becomes an error row
            return _failed(failure), pa.array([], type=item)

    return call


def _failed(failure: Exception) -> str:
    return f"{type(failure).__name__}: {failure}"


def _as_array(columns: Sequence[Sequence], fields: list[pa.Field]) -> pa.Array:
    arrays = [pa.array(column, type=field.type) for column, field in zip(columns, fields, strict=True)]
    return pa.StructArray.from_arrays(arrays, fields=fields)


def _size(answer: list[list] | pa.Array) -> int:
    return len(answer[0]) if isinstance(answer, list) else len(answer)


def _together(outcomes: list[tuple[str | None, list[list] | pa.Array]], item: pa.StructType):
    """(errors, sizes, rows) of some calls; lists become arrays once for all of them."""
    fields = list(item)
    try:
        if all(isinstance(answer, list) for _, answer in outcomes if _size(answer)):
            full = [answer for _, answer in outcomes if _size(answer)]
            joined = [[value for answer in full for value in answer[n]] for n in range(len(fields))]
            return [error for error, _ in outcomes], [_size(answer) for _, answer in outcomes], _as_array(joined, fields)
    except Exception:  # noqa: BLE001 - the call with the value that doesn't fit is found below
        pass
    errors, arrays = [], []
    for error, answer in outcomes:
        try:
            arrays.append(_as_array(answer, fields) if isinstance(answer, list) else answer)
        except Exception as failure:  # noqa: BLE001 - any failure becomes an error row
            error = _failed(failure)
            arrays.append(pa.array([], type=item))
        errors.append(error)
    return errors, [len(array) for array in arrays], pa.concat_arrays(arrays)


def _told(asked: pa.RecordBatch, outcomes: list[tuple[str | None, list[list] | pa.Array]], arrow: pa.Schema) -> pa.RecordBatch:
    """The requests of some calls with what came of them."""
    errors, sizes, answers = _together(outcomes, arrow.field("rows").type.value_type)
    ends = list(itertools.accumulate(sizes, initial=0))
    rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), answers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(asked.to_struct_array(), type=arrow.field("request").type),
            pa.array(errors, type=pa.string()),
            rows.cast(arrow.field("rows").type),
        ],
        schema=arrow,
    )


def _rows_and_errors(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = outcomes.where(F.col("error").isNull()).select(F.inline("rows"))
    return rows, outcomes.where(F.col("error").isNotNull()).select("request.*", "error")


def fetch_windows(
    requests: DataFrame,
    fetch: Callable[[Mapping], Mapping[str, Sequence]],
    schema: T.StructType,
    pause: float = 1.0,
    parallelism: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)`` for one ``fetch`` call per request row.

    ``fetch`` receives the request as a mapping and returns parallel lists, one
    per column of ``schema``.  A call that raises gives no rows and one error
    row: the request and a message.  Each task waits ``pause`` seconds before a
    call, so the service sees at most ``parallelism / pause`` calls a second.
    The outcome is written once to the shared folder: reading both results calls
    the service once.
    """
    outcome = _outcome(requests, schema)
    arrow = to_arrow_schema(outcome)
    call = _caller(fetch, arrow.field("rows").type.value_type, pause)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CALLS_PER_BATCH):
                asked = batch.slice(start, CALLS_PER_BATCH)
                yield _told(asked, [call(request) for request in asked.to_pylist()], arrow)

    spread = requests if parallelism is None else requests.repartition(parallelism)
    return _rows_and_errors(written(spread.mapInArrow(per_partition, outcome), "fetched"))


def walk_windows(
    requests: DataFrame,
    fetch: Callable[[Mapping], Mapping[str, Sequence]],
    schema: T.StructType,
    key: str,
    order: str,
    pause: float = 1.0,
    parallelism: int | None = None,
    most_empty: int = 1,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, errors, calls)``: the windows of each key from the newest back, until too many were empty.

    A key's windows are asked for one after the other, the largest ``order`` first;
    with the ``most_empty + 1``-th window without rows the walk of the key ends and
    its older windows are never asked for.  A call that fails is an error row and
    no empty window.  ``calls`` has the number of calls of each key.  All windows
    of a key are in one task, since each call depends on the last ones; a task
    holds a batch of requests and the answers to a few calls, and walks its keys in turn.
    A NULL key is a key; of equal ``order`` the other columns decide.
    """
    outcome = _outcome(requests, schema)
    arrow = to_arrow_schema(outcome)
    call = _caller(fetch, arrow.field("rows").type.value_type, pause)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walking, empty = object(), 0
        for batch in batches:
            places, outcomes = [], []
            for place, request in enumerate(batch.to_pylist()):
                if request[key] != walking:
                    walking, empty = request[key], 0
                if empty > most_empty:
                    continue
                error, rows = call(request)
                empty += error is None and _size(rows) == 0
                places.append(place)
                outcomes.append((error, rows))
                if len(places) == CALLS_PER_BATCH:
                    yield _told(batch.take(places), outcomes, arrow)
                    places, outcomes = [], []
            if places:
                yield _told(batch.take(places), outcomes, arrow)

    rest = [F.col(f"`{name}`") for name in requests.columns if name not in (key, order)]
    dealt = requests.repartition(key) if parallelism is None else requests.repartition(parallelism, key)
    newest_first = dealt.sortWithinPartitions(F.col(key), F.col(order).desc(), *rest)
    outcomes = written(newest_first.mapInArrow(per_partition, outcome), "walked")
    rows, errors = _rows_and_errors(outcomes)
    return rows, errors, outcomes.groupBy(F.col(f"request.`{key}`").alias(key)).agg(F.count("*").alias("calls"))
