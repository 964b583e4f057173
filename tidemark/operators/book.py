"""Order books as arrays of (price, amount), without UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import finite, ratio

BANDS = (10, 50)


def valid_levels(levels: Column, descending: bool) -> Column:
    """Levels finite, prices positive, amounts not negative, sorted from the best; false for nulls."""
    sound = F.forall(levels, lambda x: finite(x["price"]) & finite(x["amount"]) & (x["price"] > 0) & (x["amount"] >= 0))
    prices = F.transform(levels, lambda x: x["price"])
    return F.coalesce(sound & (prices == F.sort_array(prices, not descending)), F.lit(False))


def valid_book(bids: Column, asks: Column) -> Column:
    """Both sides valid, and not crossed where both have levels."""
    crossed = F.coalesce(F.get(bids, 0)["price"] >= F.get(asks, 0)["price"], F.lit(False))
    return valid_levels(bids, True) & valid_levels(asks, False) & ~crossed


def _sum(levels: Column) -> Column:
    return F.aggregate(levels, F.lit(0.0), lambda a, x: a + x["amount"])


def _at_least(levels: Column, price: Column) -> Column:
    return _sum(F.filter(levels, lambda x: x["price"] >= price))


def _at_most(levels: Column, price: Column) -> Column:
    return _sum(F.filter(levels, lambda x: x["price"] <= price))


def book_features(books: DataFrame) -> DataFrame:
    """mid, spread, depths, imbalance and depth within bands of basis points (bounds included) from bids and asks."""
    bid, ask = F.get("bids", 0)["price"], F.get("asks", 0)["price"]
    out = books.withColumns({
        "mid": (bid + ask) / 2, "spread": ask - bid, "bid_size": _sum(F.col("bids")), "ask_size": _sum(F.col("asks")),
    })
    total = F.col("bid_size") + F.col("ask_size")
    out = out.withColumn("imbalance", F.when(total > 0, ratio(F.col("bid_size") - F.col("ask_size"), total)))
    for n in BANDS:
        low, high = F.col("mid") * (1 - n / 10_000), F.col("mid") * (1 + n / 10_000)
        out = out.withColumns({
            f"bid_depth_{n}bps": F.when(F.col("mid").isNotNull(), _at_least(F.col("bids"), low)),
            f"ask_depth_{n}bps": F.when(F.col("mid").isNotNull(), _at_most(F.col("asks"), high)),
        })
    return out


def quality_mask(books: DataFrame, strict: bool = False) -> DataFrame:
    """The books of ``book_features`` that can be used: both sides there, and a positive spread.

    Lenient: others are dropped.  Strict: one of them makes the job fail.
    """
    usable = F.coalesce(F.col("spread") > 0, F.lit(False))
    if not strict:
        return books.where(usable)
    return books.withColumn("spread", F.when(~usable, F.raise_error(F.lit("a book is unusable")).cast("double")).otherwise(F.col("spread")))


def market_minute(books: DataFrame, keys: list[str]) -> DataFrame:
    """Contracts' books to one row per market and minute: median spread, summed depth, mean imbalance."""
    return books.groupBy(*keys).agg(
        F.median("spread").alias("median_spread"), F.sum("bid_size").alias("bid_depth"), F.sum("ask_size").alias("ask_depth"),
        F.avg("imbalance").alias("mean_imbalance"), F.count(F.lit(1)).alias("contracts"),
    )
