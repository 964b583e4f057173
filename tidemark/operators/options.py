"""Option chains: quotes, surfaces, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import finite


def surface(quotes: DataFrame, keys: list[str]) -> DataFrame:
    """Medians of implied volatility under masks of moneyness and maturity, and quote quality.

    quotes: iv, strike, underlying, dte_days, option_type, bid, ask, quote_age, contract.
    """
    m, dte, iv = F.col("strike") / F.col("underlying"), F.col("dte_days"), F.col("iv")
    put, call = F.col("option_type") == "P", F.col("option_type") == "C"
    usable = finite(iv) & (iv >= 0) & (dte > 0) & finite(m) & (m > 0)
    atm = F.abs(F.ln(m)) <= 0.05
    med = lambda mask: F.median(F.when(mask, iv))
    quoted = F.coalesce((F.col("bid") > 0) & (F.col("ask") > 0) & (F.col("ask") >= F.col("bid")), F.lit(False))
    fresh = F.col("quote_age") <= 60
    return quotes.where(usable).groupBy(*keys).agg(
        med(atm).alias("atm_iv"),
        med(atm & (dte <= 7)).alias("short_dated_iv"),
        (med(put & (m >= 0.85) & (m < 0.95)) - med(call & (m > 1.05) & (m <= 1.15))).alias("skew"),
        (med(atm & (dte > 30)) - med(atm & (dte <= 7))).alias("term_structure"),
        (med(atm & put) - med(atm & call)).alias("put_call_iv_spread"),
        F.count_distinct("contract").alias("contract_count"),
        F.count_if(fresh).alias("fresh_quote_count"),
        F.count_if(F.col("quote_age") > 60).alias("stale_quote_count"),
        F.max("quote_age").alias("max_quote_age_seconds"),
        F.avg(quoted.cast("double")).alias("quote_coverage_ratio"),
    )


def quote_coverage(quotes: DataFrame, keys: list[str], contract: str, quoted: Column, age: Column) -> DataFrame:
    return quotes.groupBy(*keys).agg(
        F.count_distinct(contract).alias("contracts"), F.count_if(quoted).alias("quoted"),
        F.avg(quoted.cast("double")).alias("coverage"), F.max(age).alias("max_age"),
    )
