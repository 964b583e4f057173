"""Calendar resampling by rules that follow from column names; the first rule that fits wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import floor_time

#: Suffixes and names with their rules, in order of precedence.
OPEN, HIGH, LOW, CLOSE = ("_open_price", "_open"), ("_high_price", "_high"), ("_low_price", "_low"), ("_close_price", "_close")
SUMS = ("_volume", "_quote_volume", "_trade_count", "_buy_trade_count", "_sell_trade_count")
FLAGS = ("funding_data_available", "is_funding_observation_minute", "open_interest_is_observed", "open_interest_is_ffill")
#: Shares are recomputed from the sums: name -> (part, whole).
SHARES = {f"{k}_buy_volume_share": (f"{k}_buy_volume", f"{k}_volume") for k in ("perps_trades", "options_trades")}


def rule(name: str, ts: str) -> Callable[[Column], Column]:
    """The aggregate of a column."""
    first = lambda x: F.min_by(x, F.when(x.isNotNull(), F.col(ts)))
    last = lambda x: F.max_by(x, F.when(x.isNotNull(), F.col(ts)))
    if name.endswith(OPEN):
        return first
    if name.endswith(HIGH):
        return F.max
    if name.endswith(LOW):
        return F.min
    if name.endswith(CLOSE):
        return last
    if name.endswith(SUMS):
        return lambda x: F.coalesce(F.sum(x), F.lit(0))
    if name in FLAGS:
        return lambda x: F.coalesce(F.bool_or(x), F.lit(False))
    return last


def resample(df: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """Buckets of ``seconds``, labelled by their start; empty ones are not made.  Columns keep their order."""
    columns = [c for c in df.columns if c not in (*keys, ts)]
    out = df.groupBy(*keys, floor_time(F.col(ts), seconds).alias("__bucket")).agg(
        *[rule(c, ts)(F.col(c)).alias(c) for c in columns if c not in SHARES]
    ).withColumnRenamed("__bucket", ts)
    for name, (part, whole) in SHARES.items():
        if name in columns:
            out = out.withColumn(name, F.when(F.col(whole) > 0, F.col(part) / F.col(whole)))
    return out.select(*df.columns)
