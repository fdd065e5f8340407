"""Every operator as a query over the given tables, next to its check in SQL."""

from candlemill.registry.base import QUERIES, SQL
from candlemill.registry import (  # noqa: F401 - importing registers the queries
    aggregates,
    events,
    functions,
    ingest,
    joins,
    projections,
    series,
    sinks,
    sources,
)

__all__ = ["QUERIES", "SQL"]
