"""Builders of Silver datasets from Bronze ones.

Each is a lazy plan: validity, deduplication, alignment, features, contract.
Nothing is collected, and a build of some months is the same plan over a filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import base_asset, clip_low, empty_to_null, finite, log_ratio, micros, minute, normal_symbol, option_parts, ratio
from tidemark.functions.windows import over_rows, percentile_rank, rolling, zscore
from tidemark.operators import bars as B
from tidemark.operators import book as K
from tidemark.operators import dedup as D
from tidemark.operators import features as T
from tidemark.operators.asof import asof, require_no_leak, staleness
from tidemark.operators.grid import month_grid, span_grid
from tidemark.operators.options import surface
from tidemark.plans.contracts import carried, conform, valid_metadata

KEYS = ["exchange", "symbol"]
RV_SPANS = T.RV_WINDOWS | {"30d": 30 * T.DAY}


def _normal(df: DataFrame) -> DataFrame:
    return df.withColumn("symbol", normal_symbol(F.col("symbol")))


def ohlcv(bronze: DataFrame) -> DataFrame:
    """Valid candles, the last ingested of each open time."""
    o, h, l, c = (F.col(f"{x}_price") for x in ("open", "high", "low", "close"))
    sound = o.isNotNull() & h.isNotNull() & l.isNotNull() & c.isNotNull() & (h >= F.greatest(o, c)) & (l <= F.least(o, c))
    return conform(D.keep_last(_normal(bronze).where(F.coalesce(sound, F.lit(False))), [*KEYS, "open_time"], F.col("ingested_at")), "ohlcv")


def funding_observed(bronze: DataFrame, built_at: Column | None = None) -> DataFrame:
    """Finite rates of at most 1 in size; of one time the rate that came last, with its provenance.

    ``built_at``: the time of the build, by default now.
    """
    rate = F.col("funding_rate")
    rows = _normal(bronze).where(F.coalesce(finite(rate) & (F.abs(rate) <= 1), F.lit(False)))
    out = rows.groupBy(F.col("open_time").alias("funding_time"), *KEYS).agg(
        F.max_by("funding_rate", F.struct("ingested_at", "funding_rate")).alias("funding_rate"),
        F.min("ingested_at").alias("ingested_at_min"), F.max("ingested_at").alias("ingested_at_max"),
        F.count(F.lit(1)).alias("source_row_count"), F.max(carried(bronze, "instrument_type")).alias("instrument_type"),
    )
    return conform(out.withColumns({
        "base_asset": base_asset(F.col("symbol")), "funding_interval_hours": F.lit(8).cast("long"), "data_quality_status": F.lit("ok"),
        "silver_built_at": F.current_timestamp().cast("timestamp_ntz") if built_at is None else built_at,
    }), "funding_observed")


def funding_feature(observed: DataFrame, reset: str | None = "month") -> DataFrame:
    """The last known rate on a minute calendar, with its age; by default no state crosses a month."""
    rows = observed.select(*KEYS, F.col("funding_time").alias("timestamp"), F.col("funding_rate").alias("funding_rate_last_known"),
                           F.col("funding_time").alias("funding_observed_at"))
    grid = month_grid(rows, KEYS, "timestamp", 60, "timestamp")
    state = asof(grid, rows, "timestamp", KEYS, ["funding_rate_last_known", "funding_observed_at"], reset=reset)
    out = staleness(require_no_leak(state, "timestamp", "funding_observed_at"), "timestamp", "funding_observed_at")
    return conform(out.withColumnsRenamed({"minutes_since": "minutes_since_funding", "is_observed": "is_funding_observation_minute",
                                           "available": "funding_data_available"}), "funding_1m_feature")


def open_interest_observed(bronze: DataFrame) -> DataFrame:
    """Finite levels of at least 0; equal repeats of a time fall."""
    x = F.col("open_interest")
    rows = _normal(bronze).where(F.coalesce(finite(x) & (x >= 0) & (F.length("symbol") > 0), F.lit(False)))
    last = D.keep_last(rows, [*KEYS, "open_time", "open_interest"], F.col("ingested_at"))
    return conform(last.withColumns({"timestamp": minute(F.col("open_time")), "open_interest_source_timestamp": F.col("open_time")}), "open_interest_observed")


def open_interest_feature(observed: DataFrame, reset: str | None = "month") -> DataFrame:
    rows = observed.withColumn("timestamp_m1", F.col("timestamp"))
    grid = month_grid(rows.select(*KEYS, "timestamp_m1"), KEYS, "timestamp_m1")
    state = asof(grid, rows, "timestamp_m1", KEYS, ["open_interest", "open_interest_source_timestamp", "timestamp"], tie="ingested_at", reset=reset)
    out = staleness(require_no_leak(state, "timestamp_m1", "timestamp"), "timestamp_m1", "timestamp")
    lag = (micros(F.col("timestamp_m1")) - micros(F.col("open_interest_source_timestamp"))) / 1_000_000
    return conform(out.withColumn("open_interest_observation_lag_sec", F.greatest(lag, F.lit(0)).cast("long")).withColumnsRenamed({
        "is_observed": "open_interest_is_observed", "is_ffill": "open_interest_is_ffill",
        "minutes_since": "minutes_since_open_interest_observation"}), "open_interest_1m_feature")


def trades_observed(bronze: DataFrame) -> DataFrame:
    """Valid trades, the last ingested of each time and id; sides in lower case."""
    rows = _normal(bronze).withColumn("side", F.lower(F.trim("side"))).where(B.valid_trade())
    return conform(D.keep_last(rows, [*KEYS, "trade_time", "trade_id"], F.col("ingested_at")), "trades_observed")


def trade_feature(observed: DataFrame, empty: DataFrame | None = None, instrument_type: str | None = None) -> DataFrame:
    """Minute bars; confirmed-empty minutes get the last known close and no flow.  The dataset is of one ``instrument_type``."""
    bars = B.minute_bars(observed)
    if empty is not None:
        bars = B.fill_prices(B.with_empty_minutes(bars, empty))
    return conform(bars.withColumn("instrument_type", F.lit(instrument_type).cast("string")), "trades_1m_feature")


def volatility_observed(snapshot: DataFrame, historical: DataFrame) -> DataFrame:
    """Finite values of at least 0 (old files have only ``value``); snapshots come before history."""
    def rows(df: DataFrame, priority: int) -> DataFrame:
        df = _normal(df)
        have = lambda c: F.coalesce(F.col(c), F.col("value")) if c in df.columns and "value" in df.columns else F.col(c if c in df.columns else "value")
        return df.select(*KEYS, F.col("open_time").alias("volatility_source_timestamp"), minute(F.col("open_time")).alias("timestamp"), "ingested_at",
                         *[carried(df, c) for c in ("instrument_type", "dataset_type", "source_endpoint")],
                         (F.coalesce("value", "close") if {"value", "close"} <= set(df.columns) else have("close")).alias("volatility_value"), *[have(c).alias(f"volatility_{c}") for c in ("open", "high", "low", "close")], F.lit(priority).alias("priority"))

    both = rows(snapshot, 1).unionByName(rows(historical, 0))
    sound = F.lit(True)
    for c in ("open", "high", "low", "close"):
        x = F.col(f"volatility_{c}")
        sound = sound & finite(x) & (x >= 0)
    kept = D.keep_last(both.where(F.coalesce(sound, F.lit(False))), [*KEYS, "timestamp"], F.col("priority"), F.col("ingested_at"))
    return conform(kept, "volatility_observed")


def volatility_feature(observed: DataFrame) -> DataFrame:
    """Ranges, returns, lookback changes, z-scores and the 30-day percentile of observed values; no grid is filled."""
    df = observed.select(*KEYS, F.col("timestamp").alias("timestamp_m1"), *[F.col(f"volatility_{c}").alias(f"iv_{c}") for c in ("open", "high", "low", "close")],
                         carried(observed, "dataset_type").alias("iv_source_dataset"),
                         carried(observed, "volatility_source_timestamp", "timestamp_ntz").alias("iv_source_timestamp"))
    c, ts = F.col("iv_close"), "timestamp_m1"
    df = over_rows(df, KEYS, ts, lambda w: {"iv_return_1m": log_ratio(c, F.lag(c).over(w))}, back=1).withColumn("iv_range", F.col("iv_high") - F.col("iv_low"))
    for name, seconds in (("5m", 300), ("15m", 900), ("1h", 3600)):
        past = df.select(*KEYS, ts, c.alias("__past"))
        df = asof(df, past, ts, KEYS, ["__past"], lookback=seconds).withColumn(f"iv_change_{name}", c - F.col("__past")).drop("__past")
    df = T.rolling_zscore(df, KEYS, ts, "iv_close", {"1d": T.DAY, "7d": 7 * T.DAY}, "iv_zscore_")
    df = percentile_rank(df, KEYS, ts, "iv_close", 30 * T.DAY, "iv_percentile_30d")
    return conform(df.withColumns({"iv_30d_annualized_pct": c, "minutes_since_iv_observation": F.lit(0).cast("long"), "iv_data_available": F.lit(True)}), "volatility_index_1m_feature")


def realized_volatility_feature(spot: DataFrame, perps: DataFrame) -> DataFrame:
    """Volatility of both sources and of the canonical one: perps for a symbol that has any, else spot."""
    side = lambda df, n: df.select(*KEYS, F.col("open_time").alias("timestamp_m1"), *[F.col(f"{x}_price").alias(f"{n}_{x}") for x in ("high", "low", "close")])
    df = side(spot, "spot").join(side(perps, "perps"), [*KEYS, "timestamp_m1"], "full_outer")
    with_perps = perps.select(*KEYS).distinct().withColumn("__perps", F.lit(True))  # one row for each series
    df = df.join(with_perps, KEYS, "left").withColumn("canonical_rv_source", F.when(F.col("__perps"), "perps").otherwise("spot"))
    pick = lambda x: F.when(F.col("__perps"), F.col(f"perps_{x}")).otherwise(F.col(f"spot_{x}"))
    df = df.withColumns({"rv_high": pick("high"), "rv_low": pick("low"), "rv_close": pick("close")})
    ts = "timestamp_m1"
    for price, name in (("spot_close", "spot_log_return"), ("perps_close", "perps_log_return"), ("rv_close", "__r")):
        df = T.return_to_last_known(df, KEYS, ts, price, name)
    returns = {"": "__r", "spot_": "spot_log_return", "perps_": "perps_log_return"}
    df = rolling(df, KEYS, ts, {f"__{prefix}": F.col(r) * F.col(r) for prefix, r in returns.items()}, RV_SPANS, moments=False)
    out = {}
    for prefix, r in returns.items():
        for span, seconds in RV_SPANS.items():
            rv = T.realized(F.col(r), f"__{prefix}_{span}")
            out |= {f"{prefix}rv_{span}": rv, f"{prefix}rv_{span}_annualized_pct": rv * (math.sqrt(T.MINUTES_PER_YEAR / (seconds / 60)) * 100)}
    df = df.withColumns(out).drop(*[f"__{prefix}_{span}" for prefix in returns for span in RV_SPANS])
    df = T.parkinson(df, KEYS, ts, "rv_high", "rv_low").withColumnRenamed("parkinson_rv", "parkinson_rv_1h")
    df = T.rolling_zscore(df, KEYS, ts, "__r", T.DAY, "__z")
    s, p = F.col("spot_close"), F.col("perps_close")
    return conform(df.withColumns({
        "jump_proxy": F.abs("__z"), "spot_available": s.isNotNull(), "perps_available": p.isNotNull(),
        "canonical_rv_source_available": F.col("rv_close").isNotNull(), "spot_perps_basis_available": F.coalesce(s.isNotNull() & p.isNotNull() & (s != p), F.lit(False)),
    }), "realized_volatility_1m_feature")


def iv_rv_feature(iv: DataFrame, rv: DataFrame) -> DataFrame:
    """Spreads and ratios of implied and realised volatility, their z-score and percentile."""
    own = iv.select(*KEYS, "timestamp_m1", "iv_close", "iv_30d_annualized_pct", "minutes_since_iv_observation")
    df = own.join(rv.select(*KEYS, "timestamp_m1", "rv_1h", "rv_1d", "rv_30d_annualized_pct", carried(rv, "canonical_rv_source")), [*KEYS, "timestamp_m1"], "full_outer")
    c, month = F.col("iv_close"), F.col("rv_30d_annualized_pct")
    over = lambda a, b: F.when(b > 0, a / b)
    df = df.withColumns({
        "iv_minus_rv_1h": c - F.col("rv_1h"), "iv_minus_rv_1d": c - F.col("rv_1d"), "iv_rv_ratio_1h": over(c, F.col("rv_1h")), "iv_rv_ratio_1d": over(c, F.col("rv_1d")),
        "iv_rv_spread_30d_pct": F.col("iv_30d_annualized_pct") - month, "iv_rv_ratio_30d": over(F.col("iv_30d_annualized_pct"), month),
        "iv_available": c.isNotNull(), "rv_available": F.col("rv_1h").isNotNull() | F.col("rv_1d").isNotNull(),
        "minutes_since_rv_observation": F.when(F.col("rv_1h").isNotNull(), 0).cast("long"),
    })
    df = T.rolling_zscore(df, KEYS, "timestamp_m1", "iv_minus_rv_1d", T.DAY, "iv_rv_zscore_1d")
    df = percentile_rank(df, KEYS, "timestamp_m1", "iv_minus_rv_1d", 30 * T.DAY, "iv_rv_percentile_30d")
    return conform(df, "iv_rv_1m_feature")


def _carried(observed: DataFrame, columns: list[str], reset: str | None) -> DataFrame:
    """State on the observed span of each series, with its age (null where there is none)."""
    rows = observed.withColumn("timestamp_m1", minute(F.col("timestamp")))
    grid = span_grid(rows, KEYS, "timestamp_m1")
    state = asof(grid, rows.withColumn("__at", F.col("timestamp_m1")), "timestamp_m1", KEYS, [*columns, "__at"], tie="timestamp", reset=reset)
    return state.withColumns({
        "__since": ((micros(F.col("timestamp_m1")) - micros(F.col("__at"))) / 60_000_000).cast("long"), "__same": F.col("timestamp_m1") == F.col("__at"),
    })


def _named(df: DataFrame) -> DataFrame:
    """Names of venues in lower case, of instruments in upper case, and the source as ``source_endpoint``."""
    out = df.withColumn("exchange", F.lower(F.trim("exchange"))).withColumn("source_endpoint", carried(df, "source" if "source" in df.columns else "source_endpoint", "string"))
    return out.withColumn("instrument_name", F.upper(F.trim("instrument_name"))) if "instrument_name" in df.columns else out


def index_price_observed(bronze: DataFrame) -> DataFrame:
    """Positive finite prices (event_time, index_name, price, snapshot_time), the last ingested of each time."""
    x = F.col("index_price")
    rows = _named(_normal(bronze)).withColumns({
        "timestamp": F.col("event_time"), "index_name": F.lower(F.trim("index_name")), "index_price": F.col("price").cast("double"),
        "index_price_source_timestamp": F.col("snapshot_time")})
    sound = rows.where(F.coalesce(F.col("timestamp").isNotNull() & finite(x) & (x > 0), F.lit(False)))
    return conform(D.keep_last(sound, [*KEYS, "timestamp"], F.col("ingested_at")), "index_price_observed")


def index_price_feature(observed: DataFrame, reset: str | None = "month") -> DataFrame:
    """observed: timestamp, exchange, symbol, index_price; prices of at most 0 are dropped."""
    rows = observed.where(finite(F.col("index_price")) & (F.col("index_price") > 0)).withColumn("index_price_source_timestamp", F.col("timestamp"))
    out = _carried(rows, ["index_price", "index_price_source_timestamp"], reset)
    return conform(out.withColumnsRenamed({"__same": "index_price_is_observed", "__since": "minutes_since_index_price_observation"}), "index_price_1m_feature")


def futures_summary_observed(bronze: DataFrame) -> DataFrame:
    """Book summaries by instrument; the index is the underlying's price, else the estimated delivery price."""
    own = lambda c: carried(bronze, c, "double")
    rows = _named(bronze).withColumns({
        "timestamp": F.col("snapshot_time"), "symbol": F.upper(F.trim("instrument_name")), "instrument_type": F.lower(F.trim("instrument_type")),
        "mark_price": own("mark_price"), "index_price": F.coalesce(own("underlying_price"), own("estimated_delivery_price")),
        "open_interest": own("open_interest"), "volume": own("volume"), "turnover": own("volume_usd"), "funding_rate": own("interest_rate")})
    sound = rows.where(F.coalesce(F.col("timestamp").isNotNull() & (F.length("symbol") > 0), F.lit(False)))
    return conform(D.keep_last(sound, [*KEYS, "timestamp"], F.col("ingested_at")), "futures_summary_observed")


def futures_summary_feature(observed: DataFrame, reset: str | None = "month") -> DataFrame:
    observed = observed.withColumn("instrument_type", carried(observed, "instrument_type"))
    out = _carried(observed, ["instrument_type", "mark_price", "index_price", "open_interest", "volume", "turnover", "funding_rate"], reset)
    m, i = F.col("mark_price"), F.col("index_price")
    return conform(out.withColumns({"mark_index_spread": m - i, "mark_index_ratio": F.when(i > 0, m / i)}).withColumnsRenamed({
        "__same": "summary_is_observed", "__since": "minutes_since_summary_observation"}), "futures_summary_1m_feature")


def _sound_option() -> Column:
    """An option's name gave its underlying, a date, a positive strike and a type."""
    return F.col("underlying").isNotNull() & F.col("expiry").isNotNull() & (F.col("strike") > 0) & F.col("option_type").isin("C", "P")


def options_ticker_observed(bronze: DataFrame) -> DataFrame:
    """Option quotes whose names are sound, the last ingested of each instrument and time."""
    own = lambda *names: F.coalesce(*[carried(bronze, c, "double") for c in names])
    rows = _named(bronze)
    rows = rows.withColumns(option_parts(F.col("instrument_name"))).withColumns({
        "timestamp": F.col("snapshot_time"), "bid_price": own("bid_price") if "bid_price" in bronze.columns else own("best_bid_price"),
        "ask_price": own("ask_price") if "ask_price" in bronze.columns else own("best_ask_price"), "implied_volatility": own("mark_iv"),
        **{c: own(c) for c in ("underlying_price", "index_price", "mark_price", "delta", "gamma", "vega", "theta", "open_interest", "volume")}})
    rows = rows.withColumn("symbol", F.upper("symbol") if "symbol" in bronze.columns else F.col("underlying"))
    sound = rows.where(F.coalesce(F.col("timestamp").isNotNull() & _sound_option(), F.lit(False)))
    return conform(D.keep_last(sound, ["exchange", "instrument_name", "timestamp"], F.col("ingested_at")), "options_ticker_observed")


def recent_trades_observed(bronze: DataFrame) -> DataFrame:
    """Trades of snapshots: known by their id, else by what they are; the last snapshot of each stays."""
    name, kind = F.col("instrument_name"), F.col("instrument_type")
    rows = _named(bronze).withColumn("instrument_type", F.lower(F.trim("instrument_type")))
    parts = option_parts(name)
    future = F.try_to_date(empty_to_null(F.regexp_extract(name, r"^[A-Z0-9]+-(\d{1,2}[A-Z]{3}\d{2})$", 1)), "dMMMyy")
    side = F.lower("direction")
    of_option = lambda c: F.when(kind == "option", parts[c])
    rows = rows.withColumns({
        "trade_time": F.col("exchange_timestamp"), "snapshot_timestamp": F.col("snapshot_time"), "underlying": empty_to_null(F.regexp_extract(name, r"^([A-Z0-9]+)-", 1)),
        "expiry": F.when(kind == "option", parts["expiry"]).when(kind == "future", future), "strike": of_option("strike"), "option_type": of_option("option_type"),
        "trade_id": empty_to_null(F.trim(F.col("trade_id").cast("string"))), "price": F.col("price").cast("double"), "quantity": F.col("amount").cast("double"),
        "side": F.when(side.isin("buy", "sell"), side).otherwise("unknown"), "snapshot_derived": F.lit(True)})
    rows = rows.withColumns({
        "symbol": F.upper("symbol") if "symbol" in bronze.columns else F.col("underlying"), "trade_id_is_source": F.col("trade_id").isNotNull(),
        "deduplication_key": D.fallback_key(F.col("trade_id"), F.lit(""), *[F.col(c) for c in ("exchange", "instrument_name", "trade_time", "price", "quantity", "side")])})
    p, q = F.col("price"), F.col("quantity")
    sound = (F.col("trade_time").isNotNull() & F.col("snapshot_timestamp").isNotNull() & F.col("underlying").isNotNull() & finite(p) & (p > 0) & finite(q) & (q > 0)
             & ((kind != "option") | kind.isNull() | _sound_option()))
    kept = D.keep_last(rows.where(F.coalesce(sound, F.lit(False))), ["exchange", "deduplication_key"], F.col("snapshot_timestamp"), F.col("ingested_at"))
    return conform(kept, "recent_trade_observed")


def instrument_metadata_observed(bronze: DataFrame) -> DataFrame:
    """Instruments of a day with sound sizes and terms, whether they were listed then; the last ingested of each day stays."""
    name, kind = F.upper(F.trim("instrument_name")), F.lower(F.trim("kind"))
    own = lambda c, k: carried(bronze, c, k)
    side = F.lower(own("option_type", "string"))
    expires, created, day = own("expiration_timestamp", "timestamp_ntz"), own("creation_timestamp", "timestamp_ntz"), F.to_date("snapshot_date")
    listed = (created.isNull() | (F.to_date(created) <= day)) & (expires.isNull() | (F.to_date(expires) >= day))
    active = F.col("is_active").cast("boolean")
    rows = _named(bronze).select(
        day.alias("snapshot_date"), "exchange", name.alias("instrument_name"), F.upper("base_currency").alias("symbol"),
        F.when(kind == "option", "option").when(name.endswith("-PERPETUAL"), "perp").otherwise("future").alias("instrument_type"),
        *[F.upper(c).alias(c) for c in ("base_currency", "quote_currency", "settlement_currency")], F.to_date(expires).alias("expiry"), own("strike", "double"),
        F.when(kind == "option", F.when(side.isin("call", "c"), "C").when(side.isin("put", "p"), "P").otherwise(side)).alias("option_type"),
        *[own(c, "double") for c in ("tick_size", "contract_size", "min_trade_amount")], created.alias("creation_timestamp"), active.alias("is_active"),
        listed.alias("is_listed"), F.coalesce(F.lower(own("state", "string")), F.when(active, "active").otherwise("inactive")).alias("listing_state"),
        "ingested_at", "source_endpoint",
    )
    known = F.col("snapshot_date").isNotNull() & (F.length("instrument_name") > 0) & F.col("is_active").isNotNull()
    for c in ("base_currency", "quote_currency", "settlement_currency"):
        known = known & F.col(c).isNotNull()
    sound = rows.where(F.coalesce(known & valid_metadata(), F.lit(False)))
    return conform(D.keep_last(sound, ["snapshot_date", "exchange", "instrument_name"], F.col("ingested_at")), "instrument_metadata_observed")


def historical_volatility_observed(bronze: DataFrame) -> DataFrame:
    """Finite values of at least 0 with both their times; the last ingested of each time."""
    x = F.col("historical_volatility")
    rows = _named(_normal(bronze)).withColumns({
        "timestamp": F.col("event_time"), "historical_volatility": F.col("value").cast("double"), "historical_volatility_source_timestamp": F.col("open_time")})
    sound = rows.where(F.coalesce(F.col("timestamp").isNotNull() & F.col("open_time").isNotNull() & finite(x) & (x >= 0), F.lit(False)))
    return conform(D.keep_last(sound, [*KEYS, "timestamp"], F.col("ingested_at")), "historical_volatility_observed")


def l2_observed(bronze: DataFrame) -> DataFrame:
    """Snapshots with sound books: finite, sorted, not crossed; options by sound names; the last ingested of each time."""
    rows = bronze.withColumn("instrument_name", F.coalesce("instrument_name", "symbol") if "instrument_name" in bronze.columns else F.col("symbol"))
    rows = _named(rows).withColumns({"timestamp": F.col("event_time"), "instrument_type": F.lower(F.trim(carried(bronze, "instrument_type")))})
    option = F.col("instrument_type") == "option"
    parts = option_parts(F.col("instrument_name"))
    rows = rows.withColumns({
        "underlying": F.when(option, parts["underlying"]).otherwise(F.regexp_replace(F.upper("symbol"), "-PERPETUAL$", "")),
        **{c: F.when(option, parts[c]) for c in ("expiry", "strike", "option_type")}})
    rows = rows.withColumns({f"best_{s}_{n}": F.get(f"{s}s", F.lit(0))[c].cast("double") for s in ("bid", "ask") for n, c in (("price", "price"), ("size", "amount"))})
    sound = F.col("timestamp").isNotNull() & K.valid_book(F.col("bids"), F.col("asks")) & (F.coalesce(~option, F.lit(True)) | _sound_option())
    return conform(D.keep_last(rows.where(F.coalesce(sound, F.lit(False))), ["exchange", "instrument_name", "timestamp"], F.col("ingested_at")), "l2_observed")


def l2_feature(observed: DataFrame) -> DataFrame:
    """The last snapshot of each minute: mid, spread, imbalance, depth within bands, age."""
    rows = observed.withColumn("timestamp_m1", minute(F.col("timestamp")))
    last = D.keep_last(rows, ["exchange", "instrument_name", "timestamp_m1"], F.col("timestamp"), F.col("ingested_at"))
    out = K.book_features(last)
    age = clip_low((micros(F.col("ingested_at")) - micros(F.col("timestamp"))) / 1_000_000, 0.0)
    bid, ask = F.col("best_bid_size"), F.col("best_ask_size")
    return conform(out.withColumns({
        "mid_price": F.col("mid"), "top_bid_size": bid, "top_ask_size": ask, "top_of_book_imbalance": F.when(bid + ask > 0, ratio(bid - ask, bid + ask)),
        "quote_available": F.col("mid").isNotNull(), "quote_age_seconds": age, "stale_quote": age > 60, "minutes_since_l2_observation": F.floor(age / 60).cast("long"),
    }), "l2_1m_feature")


def option_surface_feature(currency: DataFrame, instrument: DataFrame) -> DataFrame:
    """Surface of each minute and underlying; instrument feeds come before currency feeds, the last quote of a minute counts."""
    both = currency.withColumn("__priority", F.lit(0)).unionByName(instrument.withColumn("__priority", F.lit(1)), allowMissingColumns=True)
    exact = D.keep_last(both, ["exchange", "instrument_name", "timestamp"], F.col("__priority"), F.col("ingested_at"))
    rows = exact.withColumn("timestamp_m1", minute(F.col("timestamp")))
    last = D.keep_last(rows, ["exchange", "instrument_name", "timestamp_m1"], F.col("timestamp"))
    symbol = F.col("symbol") if "symbol" in last.columns else option_parts(F.col("instrument_name"))["underlying"]
    whole_seconds = F.floor((micros(F.col("expiry").cast("timestamp")) - micros(F.col("timestamp"))) / 1_000_000)
    quotes = last.select(
        "timestamp_m1", "exchange", symbol.alias("symbol"), F.col("instrument_name").alias("contract"), F.col("implied_volatility").alias("iv"), "strike",
        F.col("underlying_price").alias("underlying"), (whole_seconds / 86_400).alias("dte_days"), "option_type",
        F.col("bid_price").alias("bid"), F.col("ask_price").alias("ask"),
        clip_low(F.floor((micros(F.col("ingested_at")) - micros(F.col("timestamp"))) / 1_000) / 1_000, 0.0).alias("quote_age"),
    )
    return conform(surface(quotes, ["timestamp_m1", "exchange", "symbol"]), "options_surface_1m_feature")


def historical_prediction_feature(df: DataFrame, keys: list[str] = KEYS, ts: str = "timestamp_m1") -> DataFrame:
    """Row-window features from spot_close, perps_close, open_interest, funding_rate, trade and option flows.

    Windows count rows (15, 60, 1440; at least 2 values) of a grid that has every minute, so they are windows of time there.
    """
    f, p = F.col, "historical_prediction_"
    basis, oi, fr = f"{p}spot_perp_basis", "open_interest", "funding_rate"
    df = df.withColumn(basis, ratio(f("perps_close"), f("spot_close")) - 1)

    def steps(w):
        lag = lambda c: F.lag(c).over(w)
        return {f"{p}{s}_log_return_1m": log_ratio(f(f"{s}_close"), lag(f"{s}_close")) for s in ("spot", "perps")} | {
            f"{p}basis_change_1m": f(basis) - lag(basis), f"{p}open_interest_delta_1m": f(oi) - lag(oi),
            f"{p}open_interest_pct_change_1m": ratio(f(oi) - lag(oi), lag(oi)), f"{p}funding_rate_change_1m": f(fr) - lag(fr)}

    out = over_rows(df, keys, ts, steps, back=1, step=60)
    squares = {f"__{s}": f(f"{p}{s}_log_return_1m") * f(f"{p}{s}_log_return_1m") for s in ("spot", "perps")}
    spans = {"15m": 900, "1h": 3600, "1d": 86_400}
    hourly = {"basis": basis, "open_interest": oi} | {f"{s}_{c}": f"{s}_{c}" for s in ("perps", "options") for c in ("trade_count", "quote_volume")}
    scored = {f"__{n}": f(c) for n, c in hourly.items()} | {"__fr": f(fr)}
    only = dict.fromkeys((f"__{n}" for n in hourly), {"1h"}) | {"__fr": {"1d"}}
    out = rolling(out, keys, ts, squares | scored, spans, moments=set(scored), only=only)  # all windows in one exchange
    out = out.withColumns({f"{p}{s}_rv_{n}": F.when(f(f"__{s}_{n}.n") >= 2, F.sqrt(F.greatest(f(f"__{s}_{n}.total"), F.lit(0.0)))) for s in ("spot", "perps") for n in spans})
    out = out.withColumns({f"{p}{n}_zscore_1h": zscore(f(c), f"__{n}_1h") for n, c in hourly.items()} | {
        f"{p}funding_rate_zscore_1d": zscore(f(fr), "__fr_1d"), f"{p}funding_basis_divergence": f(fr) - f(basis)})
    out = out.drop("__fr_1d", *[f"__{n}_1h" for n in hourly], *[f"__{s}_{n}" for s in ("spot", "perps") for n in spans])
    for s in ("perps", "options"):
        b, a = f(f"{s}_buy_volume"), f(f"{s}_sell_volume")
        out = out.withColumn(f"{p}{s}_trade_imbalance", ratio(b - a, b + a))
    r, up = f(f"{p}perps_log_return_1m"), f(f"{p}open_interest_delta_1m") > 0
    zero = lambda c: F.coalesce(f(c), F.lit(0.0))
    return out.withColumns({
        f"{p}perps_price_impact_1m": ratio(F.abs(r), f("perps_quote_volume")), f"{p}leverage_build_up_signal": ((r > 0) & up).cast("int"),
        f"{p}short_stress_signal": ((r < 0) & up).cast("int"),
        f"{p}flow_volatility_pressure": zero(f"{p}perps_quote_volume_zscore_1h") + zero(f"{p}options_quote_volume_zscore_1h") + zero(f"{p}open_interest_zscore_1h"),
    })
