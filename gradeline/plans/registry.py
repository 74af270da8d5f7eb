"""All registered queries and their DuckDB twins."""

from __future__ import annotations

from gradeline.plans import (
    change_oracles, change_queries, model_oracles, model_queries, table_oracles, table_queries,
)

QUERIES = {**table_queries.QUERIES, **change_queries.QUERIES, **model_queries.QUERIES}
ORACLES = {**table_oracles.ORACLES, **change_oracles.ORACLES, **model_oracles.ORACLES}
