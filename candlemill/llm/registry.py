"""The queries of the operators and their SQL; importing registers all of them."""

from candlemill.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
