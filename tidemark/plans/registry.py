"""The register of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
PLACES = 6


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(*[
        F.round(f"`{f.name}`", places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(name: str, sql: str | None = None, doubles: str = "", places: int = PLACES):
    """Register ``f(tables)`` as a query; ``doubles`` names the SQL's columns to be rounded."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from tidemark.sources.tables import Tables

            return rounded(f(Tables(spark, sf_dir)), places)

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql:
            columns = ", ".join(f"round({c}, {places}) + 0.0 AS {c}" for c in doubles.split())
            ORACLE_SQL[name] = f"SELECT * REPLACE ({columns}) FROM ({sql})" if columns else sql
        return f

    return register
