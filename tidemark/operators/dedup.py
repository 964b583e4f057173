"""Deduplication: which of the rows with one key stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list, *newest: Column) -> DataFrame:
    """The row with the greatest ``newest`` of each key.

    An aggregate rather than a window: rows of a hot key are merged before the shuffle.
    """
    place = F.struct(*newest)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    named = {f"__k{i}": k if isinstance(k, Column) else F.col(k) for i, k in enumerate(keys)}
    best = df.groupBy(*[c.alias(n) for n, c in named.items()]).agg(F.max_by(row, place).alias("__row"))
    return best.select("__row.*")


def keep_first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an explicit order (priorities, then times)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__nth", F.row_number().over(w)).where("__nth = 1").drop("__nth")


def with_provenance(df: DataFrame, keys: list[str], value: str, ingested: str) -> DataFrame:
    """One row per key: the value that came last, when the first and last came, how many there were."""
    return df.groupBy(*keys).agg(
        F.max_by(value, F.struct(ingested, value)).alias(value),
        F.min(ingested).alias("first_ingested_at"),
        F.max(ingested).alias("last_ingested_at"),
        F.count(F.lit(1)).alias("source_rows"),
    )


def fallback_key(identifier: Column, *parts: Column) -> Column:
    """'id:...' where there is an identifier, else 'fallback:a|b|...'."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.when(identifier.isNotNull(), F.concat(F.lit("id:"), identifier.cast("string"))).otherwise(
        F.concat(F.lit("fallback:"), F.concat_ws("|", *text))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty for a sound table."""
    return df.groupBy(*keys).count().where("count > 1")
