"""Calendars: which instants a series should have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import from_micros, micros


def span_grid(df: DataFrame, keys: list[str], ts: str, seconds: int = 60, name: str = "timestamp_m1") -> DataFrame:
    """Every step between the first and the last observation of each key.

    The span is cut into days first: rows of a long series come from many tasks after the repartition.  Its number of partitions is given,
    as days are so few bytes that adaptive execution would merge them into one task, which then makes all rows.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    us = seconds * 1_000_000
    day = 86_400_000_000
    at = F.floor(micros(F.col(ts)) / us) * us
    spans = df.where(F.col(ts).isNotNull()).groupBy(*keys).agg(F.min(at).alias("low"), F.max(at).alias("high"))
    days = spans.select(
        *keys, "low", "high", F.explode(F.sequence(F.floor(F.col("low") / day), F.floor(F.col("high") / day))).alias("day")
    ).repartition(partitions, *keys, "day")
    low = F.greatest(F.col("low"), F.ceil(F.col("day") * day / us) * us)
    high = F.least(F.col("high"), (F.col("day") + 1) * day - 1)
    return days.where(low <= high).select(
        *keys, F.explode(F.sequence(low.cast("long"), high.cast("long"), F.lit(us).cast("long"))).alias("__us")
    ).select(*keys, from_micros(F.col("__us")).alias(name))


def month_grid(df: DataFrame, keys: list[str], ts: str, seconds: int = 60, name: str = "timestamp_m1") -> DataFrame:
    """Every step from the start of the first observation's month to the last observation."""
    first = df.groupBy(*keys).agg(F.date_trunc("month", F.min(ts)).cast("timestamp_ntz").alias(ts))
    return span_grid(df.select(*keys, ts).unionByName(first.select(*keys, ts)), keys, ts, seconds, name)


def fixed_grid(spark, start: str, end: str, seconds: int, name: str) -> DataFrame:
    """Every step from start to end, both included."""
    n = f"(unix_micros(timestamp'{end}') - unix_micros(timestamp'{start}')) div {seconds * 1_000_000}"
    steps = spark.sql(f"SELECT {n} + 1").first()[0]
    base = F.unix_micros(F.lit(start).cast("timestamp"))
    return spark.range(steps).select(from_micros(base + F.col("id") * seconds * 1_000_000).alias(name))
