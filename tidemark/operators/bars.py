"""Ticks to bars with order flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import finite, minute
from tidemark.functions.windows import last_known

KEYS = ["exchange", "symbol"]
FLOWS = ("volume", "quote_volume", "buy_volume", "sell_volume")
COUNTS = ("trade_count", "buy_trade_count", "sell_trade_count")
PRICES = ("open_price", "high_price", "low_price", "close_price")


def valid_trade() -> Column:
    """Price and quantity finite and positive, a time, a symbol."""
    p, q = F.col("price"), F.col("quantity")
    return F.coalesce(
        finite(p) & finite(q) & (p > 0) & (q > 0) & F.col("trade_time").isNotNull() & (F.col("symbol") != ""), F.lit(False)
    )


def minute_bars(ticks: DataFrame) -> DataFrame:
    """One bar per series and minute with trades.  Ties in time are broken by trade_id."""
    place = F.struct("trade_time", "trade_id")
    buys, sells = F.col("side") == "buy", F.col("side") == "sell"
    flow = lambda p: F.coalesce(F.sum(F.when(p, F.col("quantity"))), F.lit(0.0))
    bars = ticks.groupBy(*KEYS, minute(F.col("trade_time")).alias("timestamp_m1")).agg(
        F.min_by("price", place).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", place).alias("close_price"),
        F.sum("quantity").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        flow(buys).alias("buy_volume"),
        flow(sells).alias("sell_volume"),
        F.count_if(buys).alias("buy_trade_count"),
        F.count_if(sells).alias("sell_trade_count"),
    )
    return bars.withColumn(
        "buy_volume_share", F.when(F.col("volume") > 0, F.col("buy_volume") / F.col("volume")).otherwise(0.0)
    )


def with_empty_minutes(bars: DataFrame, empty: DataFrame) -> DataFrame:
    """Bars and confirmed-empty minutes (exchange, symbol, timestamp_m1) that have no bar: no price, no flow."""
    missing = empty.select(*KEYS, "timestamp_m1").distinct().join(bars, [*KEYS, "timestamp_m1"], "left_anti")
    zero = {c: F.lit(0.0) for c in (*FLOWS, "buy_volume_share")} | {c: F.lit(0).cast("long") for c in COUNTS}
    return bars.unionByName(
        missing.withColumns({c: F.lit(None).cast("double") for c in PRICES} | zero).select(*bars.columns)
    )


def fill_prices(bars: DataFrame) -> DataFrame:
    """Missing prices take the last known close, across slices and months."""
    known = last_known(bars, KEYS, "timestamp_m1", [], F.col("close_price"), "__close")
    return known.withColumns({c: F.coalesce(c, "__close") for c in PRICES}).drop("__close")
