"""Registered queries with their SQL."""

from tidemark.plans.registry import ORACLE_SQL, QUERIES
from tidemark.queries import builders, families, features, gold_tables, joins, lakehouse, trades, upkeep  # noqa: F401  they register themselves
