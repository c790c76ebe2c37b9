"""Importing this package registers every query."""

from tidemark.queries import (  # noqa: F401
    aggregate_queries,
    billing_queries,
    contract_queries,
    join_queries,
    mart_queries,
    operation_queries,
    quality_queries,
    receivable_queries,
    reshape_queries,
    scalar_queries,
    source_queries,
    stream_queries,
    window_queries,
    write_queries,
)
from tidemark.queries.registry import ORACLES, QUERIES  # noqa: F401
