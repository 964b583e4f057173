"""As-of joins: the state at or before an instant, with its staleness.

Both sides are merged into one ordered stream per key and time slice; the last
row of the right side is carried, whole, so its own nulls stay nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import micros
from tidemark.functions.windows import last_known


def asof(
    left: DataFrame, right: DataFrame, on: str, keys: list[str], columns: list[str],
    right_on: str | None = None, tie: str | None = None, lookback: int = 0, reset: str | None = None, prefix: str = "",
) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` at or before ``on`` (less ``lookback`` seconds).

    ``tie`` orders rows of the right side at one instant.  ``reset='month'`` lets no state cross a month.
    A left row without such a row gets nulls.
    """
    right_on = right_on or on
    shift = F.expr(f"INTERVAL {lookback} SECONDS")
    state = F.struct(*[F.col(c) for c in columns])
    order = tie or right_on
    r = right.select(
        *keys, F.col(right_on).alias("__on"), F.lit(0).alias("__side"), F.col(order).alias("__tie"), state.alias("__state"),
        F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("__left"),
    )
    l = left.select(
        *keys, (F.col(on) - shift if lookback else F.col(on)).alias("__on"), F.lit(1).alias("__side"),
        F.lit(None).cast(right.schema[order].dataType).alias("__tie"),
        F.lit(None).cast(right.select(state.alias("s")).schema[0].dataType).alias("__state"),
        F.struct(*[F.col(c) for c in left.columns]).alias("__left"),
    )
    both = r.unionByName(l)
    own = list(keys)
    if reset:
        both = both.withColumn("__period", F.date_trunc(reset, "__on"))
        own.append("__period")
    known = last_known(both, own, "__on", ["__side", "__tie"], F.col("__state"), "__known")
    return known.where("__side = 1").select("__left.*", *[F.col(f"__known.{c}").alias(prefix + c) for c in columns])


def staleness(df: DataFrame, ts: str, observed: str) -> DataFrame:
    """minutes_since, lag_sec, is_observed, is_ffill, available of an as-of state."""
    lag = micros(F.col(ts)) - micros(F.col(observed))
    same = F.coalesce(F.col(ts) == F.col(observed), F.lit(False))
    return df.withColumns({
        "minutes_since": (lag / 60_000_000).cast("long"),
        "lag_sec": (lag / 1_000_000).cast("long"),
        "is_observed": same,
        "is_ffill": ~same,
        "available": F.col(observed).isNotNull(),
    })


def leaks(df: DataFrame, ts: str, observed: str) -> DataFrame:
    """Rows whose state is from their future; empty for a sound as-of."""
    return df.where(F.col(observed) > F.col(ts))


def require_no_leak(df: DataFrame, ts: str, observed: str) -> DataFrame:
    """``df``; a row from the future makes the job fail where it is."""
    bad: Column = F.col(observed) > F.col(ts)
    return df.withColumn(ts, F.when(bad, F.raise_error(F.lit("an as-of state is later than its row")).cast("timestamp_ntz")).otherwise(F.col(ts)))
