"""Gold tables from sources of every kind, built from the given tables: columns as contracted, whatever is absent."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import bucketed, gold
from tidemark.plans.contracts import _LIVE, KEYS_ONLY
from tidemark.plans.registry import query
from tidemark.queries.trades import GRID_SQL, bars
from tidemark.sources.scratch import scratch

#: Ticks as quotes of contracts: bid and ask around the price, some without an ask, some without a mark.
QUOTES_SQL = r"""quotes AS (
  SELECT 'S' || (user_id % 5) AS symbol, 'C' || (user_id % 7) AS contract, date_trunc('minute', ts)::TIMESTAMP AS m, value - 1 AS bid, CASE WHEN event_type <> 'signup' THEN value + 1 END AS ask,
    CASE WHEN event_type <> 'click' THEN value END AS mark, value / 100 AS iv, CAST(nullif(regexp_extract(props, '\d+'), '') AS DOUBLE) AS size, event_id % 90 AS age, ts, event_id FROM events),
last AS (SELECT * FROM quotes QUALIFY row_number() OVER (PARTITION BY symbol, contract, m ORDER BY ts + event_id % 90 * INTERVAL 1 SECOND DESC, ts DESC, event_id DESC) = 1),
book AS (SELECT symbol, m, count(DISTINCT contract) AS contract_count, avg((bid IS NOT NULL AND ask IS NOT NULL)::INT) AS quote_coverage_ratio, 0.0::DOUBLE AS stale_quote_ratio, median(ask - bid) AS median_spread,
    coalesce(sum(size), 0) AS top_bid_depth, coalesce(sum(size + 1), 0) AS top_ask_depth, max(age)::DOUBLE AS max_quote_age_seconds FROM last GROUP BY 1, 2),
surface AS (SELECT symbol, m, median(iv) AS atm_iv, count(DISTINCT contract) AS contract_count, count(*) FILTER (ask IS NOT NULL AND mark IS NOT NULL) AS fresh_quote_count,
    count(*) FILTER (ask IS NULL OR mark IS NULL) AS stale_quote_count, max(age)::DOUBLE AS max_quote_age_seconds, avg((ask IS NOT NULL AND mark IS NOT NULL)::INT) AS quote_coverage_ratio FROM last GROUP BY 1, 2)"""


def quotes(t):
    """The same as a source of snapshots; of equal arrivals the later event comes last."""
    age = F.col("event_id") % 90
    arrived = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + age * 1_000_000).cast("timestamp_ntz")
    size, value = F.get_json_object("props", "$.k").cast("double"), F.col("value")
    ask = F.when(F.col("event_type") != "signup", value + 1)
    return t.events.select(
        F.lit("sim").alias("exchange"), F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("symbol"), F.concat(F.lit("C"), (F.col("user_id") % 7).cast("string")).alias("instrument_name"),
        F.col("ts").alias("timestamp"), (value - 1).alias("best_bid_price"), ask.alias("best_ask_price"), size.alias("best_bid_size"), (size + 1).alias("best_ask_size"),
        (value - 1).alias("bid_price"), ask.alias("ask_price"), F.when(F.col("event_type") != "click", value).alias("mark_price"), (value / 100).alias("implied_volatility"),
        arrived.alias("ingested_at"), "event_id")


BOOK = "quote_coverage_ratio median_spread top_bid_depth top_ask_depth max_quote_age_seconds"


@query("options_l2_minute", f"WITH {QUOTES_SQL} SELECT symbol, m AS ts, contract_count, {BOOK.replace(' ', ', ')}, stale_quote_ratio, NULL::DOUBLE AS bid_depth_10bps FROM book", BOOK)
def options_l2_minute(t):
    """Books of all contracts in one row a minute: shares quoted, median spread, depth at the top, greatest age."""
    out = gold.prepared("options_l2_snapshot_1m_observed", distinct_arrivals(quotes(t)))
    names = f"contract_count {BOOK} stale_quote_ratio bid_depth_10bps".split()
    return out.select("symbol", F.col("timestamp_m1").alias("ts"), *[F.col(f"options_l2_{c}").alias(c) for c in names])


def distinct_arrivals(df):
    """Of quotes of one contract that come at one instant the last event stays."""
    from tidemark.operators.dedup import keep_last

    return keep_last(df, ["exchange", "symbol", "instrument_name", "timestamp", "ingested_at"], F.col("event_id")).drop("event_id")


LIVE_SHOWN = "fill stale gap imbalance spread_bps surface_iv"


@query("gold_live_extended", f"""WITH {QUOTES_SQL}, perp AS (SELECT * FROM quotes QUALIFY row_number() OVER (PARTITION BY symbol, m ORDER BY ts + event_id % 90 * INTERVAL 1 SECOND DESC, ts DESC, contract DESC, event_id DESC) = 1)
  SELECT s.symbol, s.m AS ts, s.contract_count AS contracts, s.contract_count AS contracts_again, s.atm_iv AS surface_iv, s.fresh_quote_count / s.contract_count AS fill, s.stale_quote_count / s.contract_count AS stale,
    1 - b.quote_coverage_ratio AS gap, (b.top_bid_depth - b.top_ask_depth) / nullif(b.top_bid_depth + b.top_ask_depth, 0) AS imbalance, (p.ask - p.bid) / nullif((p.bid + p.ask) / 2, 0) * 10000 AS spread_bps
  FROM surface s JOIN book b ON b.symbol = s.symbol AND b.m = s.m JOIN perp p ON p.symbol = s.symbol AND p.m = s.m""", LIVE_SHOWN)
def gold_live_extended(t):
    """The live table of ten sources with its ratios: surfaces and books of a minute's quotes, a perpetual's book, and keys for lineage."""
    rows = distinct_arrivals(quotes(t))
    other = rows.select("exchange", "symbol", "timestamp", "ingested_at", F.col("best_bid_price").alias("volatility_close"), F.col("best_bid_price").alias("index_price"), F.col("implied_volatility").alias("mark_price"))
    # Metadata of days before any quote: such keys make no minute of their own.
    keys = rows.select("exchange", "symbol", (F.col("timestamp") - F.expr("INTERVAL 900 DAYS")).cast("timestamp_ntz").alias("snapshot_date"))
    sources = {s: keys if s in KEYS_ONLY else rows if "ticker" in s or "l2" in s else other for s in _LIVE}
    out, x = gold.build("live.extended", sources), "live_extended_"
    return out.select(
        "symbol", F.col("timestamp_m1").alias("ts"), F.col("options_surface_contract_count").alias("contracts"), F.col("options_surface_contract_count_right").alias("contracts_again"),
        F.col("options_surface_atm_iv").alias("surface_iv"), F.col(f"{x}options_surface_quote_fill_ratio").alias("fill"), F.col(f"{x}options_surface_stale_quote_ratio").alias("stale"),
        F.col(f"{x}options_l2_quote_gap_ratio").alias("gap"), F.col(f"{x}options_l2_depth_imbalance_ratio").alias("imbalance"), F.col(f"{x}perps_l2_spread_bps").alias("spread_bps"))


REGIME_SQL = f"""WITH {GRID_SQL} SELECT g.symbol, g.timestamp_m1 AS ts, b.close_price AS spot_close, b.high_price AS perp_close, b.volume AS oi, b.low_price / 1000 AS funding, b.open_price / 100 AS rv_1h,
    CASE WHEN b.symbol IS NOT NULL THEN 'perps' END AS source, CASE WHEN b.symbol IS NOT NULL THEN 'both' END AS source_right, b.quote_volume AS spread, b.high_price - b.low_price AS l2_spread,
    b.symbol IS NOT NULL AS has_l2, NULL::DOUBLE AS surface_iv, NULL::BIGINT AS contracts, NULL::DOUBLE AS volatility, false AS has_volatility
  FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.timestamp_m1 = b.timestamp_m1"""


def regime_bars(t):
    """The bars, saved once: seven sources are read from them, and each would aggregate all ticks anew."""
    at = scratch(t.spark, "bars")
    bars(t).write.parquet(at)
    return t.spark.read.parquet(at)


def regime_sources(b) -> dict:
    at = F.col("timestamp_m1")
    keyed = lambda time, **columns: b.select("exchange", "symbol", at.alias(time), *[F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()])
    prices = {f"{n}_price": F.col("close_price") for n in ("open", "high", "low", "close")} | {"volume": "volume"}
    return {
        "spot_ohlcv": keyed("open_time", **prices), "perps_ohlcv": keyed("open_time", **(prices | {"close_price": "high_price"})),
        "funding_1m_feature": keyed("timestamp", funding_rate_last_known=F.col("low_price") / 1000), "open_interest_1m_feature": keyed("timestamp_m1", open_interest="volume", oi_is_observed=F.lit(True)),
        "realized_volatility_1m_feature": keyed("timestamp_m1", rv_1h=F.col("open_price") / 100, canonical_rv_source=F.lit("perps")),
        "iv_rv_1m_feature": keyed("timestamp_m1", iv_minus_rv_1h="quote_volume", canonical_rv_source=F.lit("both")),
        "perps_l2_1m_feature": keyed("timestamp_m1", spread=F.col("high_price") - F.col("low_price"), quote_available=F.lit(True)),
    }


def regime_shown(out):
    return out.select(
        "symbol", F.col("timestamp_m1").alias("ts"), F.col("spot_ohlcv_close_price").alias("spot_close"), F.col("perp_close_price").alias("perp_close"), F.col("open_interest_open_interest").alias("oi"),
        F.col("funding_rate_last_known").alias("funding"), "rv_1h", F.col("canonical_rv_source").alias("source"), F.col("canonical_rv_source_right").alias("source_right"),
        F.col("iv_minus_rv_1h").alias("spread"), F.col("perps_l2_spread").alias("l2_spread"), F.col("perps_l2_1m_feature_available").alias("has_l2"),
        F.col("options_surface_atm_iv").alias("surface_iv"), F.col("options_surface_contract_count").alias("contracts"), F.col("historical_volatility_reference").alias("volatility"),
        F.col("historical_volatility_observed_available").alias("has_volatility"))


REGIME_DOUBLES = "spot_close perp_close oi funding rv_1h spread l2_spread"


@query("gold_regime_features", REGIME_SQL, REGIME_DOUBLES)
def gold_regime_features(t):
    """The regime table of six required sources and one of six optional ones: what is absent is a typed null, shared columns keep both sides."""
    return regime_shown(gold.build("market.regime_features", regime_sources(regime_bars(t))))


@query("gold_regime_bucketed", REGIME_SQL, REGIME_DOUBLES)
def gold_regime_bucketed(t):
    """The same table from sources that were stored in buckets: its joins shuffle nothing."""
    root = scratch(t.spark, "buckets")
    prefix = "t" + root.rpartition("-")[2]
    b = regime_bars(t)
    tables = bucketed.store_sources("market.regime_features", regime_sources(b), prefix, root, bucketed.buckets_for(b.count()))
    return regime_shown(bucketed.build(t.spark, "market.regime_features", tables))
