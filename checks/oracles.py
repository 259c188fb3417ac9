"""SQL counterparts of the queries, written for DuckDB over the given tables."""

from __future__ import annotations

from checks import oracle_decisions, oracle_features, oracle_learned, oracle_tables


def all_sql() -> dict[str, str]:
    return {**oracle_tables.SQL, **oracle_features.SQL, **oracle_decisions.SQL, **oracle_learned.SQL}
