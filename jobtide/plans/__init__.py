"""Query registry: Spark queries and their DuckDB oracles, side by side."""

from .oracle import ORACLE_SQL
from .queries import QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE_SQL)


__all__ = ["queries", "oracle_sql", "QUERIES", "ORACLE_SQL"]
