"""Silver families, surfaces by underlying and live features, built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features as T
from tidemark.operators import options as O
from tidemark.operators import sync as S
from tidemark.plans import silver
from tidemark.plans.registry import query
from tidemark.queries.joins import CHAIN_SQL, chain
from tidemark.queries.trades import FULL_SQL, whole_bars
from tidemark.sources.tables import QUOTES_SQL

SNAP_SQL = """snap AS (
  SELECT 'S' || (user_id % 5) || CASE WHEN user_id % 2 = 0 THEN '-PERPETUAL' ELSE '' END AS instrument_name, CASE WHEN event_id % 3 <> 0 THEN event_id::VARCHAR END AS trade_id,
    date_trunc('minute', ts)::TIMESTAMP AS trade_time, ts AS snapshot_timestamp, value AS price, CAST(nullif(regexp_extract(props, '\\d+'), '') AS DOUBLE) % 5 AS quantity,
    CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' ELSE 'unknown' END AS side FROM events),
twice AS (SELECT * FROM snap UNION ALL SELECT * REPLACE (snapshot_timestamp + INTERVAL 1 MINUTE AS snapshot_timestamp) FROM snap),
sound AS (SELECT *, trade_id IS NOT NULL AS trade_id_is_source FROM twice WHERE price > 0 AND quantity > 0 AND instrument_name LIKE '%-PERPETUAL')"""


@query("recent_trades_observed", f"""WITH {SNAP_SQL}
  SELECT instrument_name, trade_time, trade_id, trade_id_is_source, price, quantity, side, max(snapshot_timestamp) AS snapshot_timestamp FROM sound GROUP BY ALL""", "price quantity")
def recent_trades_observed(t):
    """Trades of snapshots, known by their id, else by what they are: every trade is in two snapshots."""
    user = F.col("user_id")
    name = F.concat(F.lit("s"), (user % 5).cast("string"), F.when(user % 2 == 0, "-perpetual").otherwise(""))
    side = F.when(F.col("event_type") == "purchase", "BUY").when(F.col("event_type") == "click", "Sell").otherwise("?")
    rows = t.events.select(
        F.lit(" SIM").alias("exchange"), name.alias("instrument_name"), F.lit("perp").alias("instrument_type"), F.lit("feed").alias("source"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_id").cast("string")).otherwise(" ").alias("trade_id"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("exchange_timestamp"), F.col("ts").alias("snapshot_time"), F.col("ts").alias("ingested_at"),
        F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") % 5).alias("amount"), side.alias("direction"))
    again = rows.withColumn("snapshot_time", F.col("snapshot_time") + F.expr("INTERVAL 1 MINUTE"))
    out = silver.recent_trades_observed(rows.unionByName(again))
    return out.select("instrument_name", "trade_time", "trade_id", "trade_id_is_source", "price", "quantity", "side", "snapshot_timestamp")


@query("instrument_metadata_observed", """WITH m AS (
  SELECT CASE p_partkey % 3 WHEN 0 THEN 'option' ELSE 'future' END AS kind, 'I' || p_partkey || CASE WHEN p_partkey % 3 = 1 THEN '-PERPETUAL' ELSE '' END AS instrument_name,
    p_size - 1.0 AS tick_size, p_retailprice AS contract_size, CASE WHEN p_size % 4 <> 0 THEN TIMESTAMP '2026-03-01 08:00:00' + p_size * INTERVAL 1 DAY END AS expires,
    CASE WHEN p_partkey % 3 = 0 THEN p_size - 5.0::DOUBLE END AS strike, CASE p_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'P' ELSE 'x' END AS side, p_size % 2 = 0 AS active FROM part),
 k AS (SELECT *, CASE WHEN kind = 'option' THEN 'option' WHEN instrument_name LIKE '%-PERPETUAL' THEN 'perp' ELSE 'future' END AS instrument_type FROM m)
  SELECT instrument_name, instrument_type, expires::DATE::VARCHAR AS expiry, strike, CASE WHEN kind = 'option' THEN side END AS option_type, coalesce(expires::DATE >= DATE '2026-03-20', true) AS is_listed,
    CASE WHEN active THEN 'active' ELSE 'inactive' END AS listing_state FROM k
  WHERE tick_size > 0 AND contract_size > 0 AND CASE instrument_type WHEN 'option' THEN coalesce(expires IS NOT NULL AND strike > 0 AND side IN ('C', 'P'), false) WHEN 'future' THEN expires IS NOT NULL ELSE true END""", "strike")
def instrument_metadata_observed(t):
    """Instruments of a day: terms, soundness, whether they are listed; each comes twice."""
    key, size = F.col("p_partkey"), F.col("p_size")
    rows = t.part.select(
        F.lit("2026-03-20").alias("snapshot_date"), F.lit("Sim").alias("exchange"), F.lit("feed").alias("source"), F.when(key % 3 == 0, "Option").otherwise("future").alias("kind"),
        F.concat(F.lit(" i"), key.cast("string"), F.when(key % 3 == 1, "-perpetual").otherwise("")).alias("instrument_name"),
        *[F.lit(x).alias(f"{c}_currency") for c, x in (("base", "btc"), ("quote", "usd"), ("settlement", "btc"))], (size - 1.0).alias("tick_size"),
        F.col("p_retailprice").alias("contract_size"),
        F.when(size % 4 != 0, F.timestamp_add("DAY", size, F.lit("2026-03-01 08:00:00").cast("timestamp_ntz"))).alias("expiration_timestamp"),
        F.when(key % 3 == 0, size - 5.0).alias("strike"), F.when(key % 4 == 0, "Call").when(key % 4 == 1, "p").otherwise("x").alias("option_type"),
        (size % 2 == 0).alias("is_active"), F.lit("2026-03-20").cast("timestamp_ntz").alias("ingested_at"))
    late = rows.withColumn("ingested_at", F.lit("2026-03-21").cast("timestamp_ntz"))
    out = silver.instrument_metadata_observed(rows.unionByName(late))
    return out.select("instrument_name", "instrument_type", F.col("expiry").cast("string").alias("expiry"), "strike", "option_type", "is_listed", "listing_state")


@query("historical_volatility_observed", """WITH v AS (SELECT 'S' || (user_id % 5) AS symbol, date_trunc('hour', ts)::TIMESTAMP AS timestamp, value - 20 AS x, ts, event_id FROM events)
  SELECT symbol, timestamp, arg_max(x, (ts, x)) AS historical_volatility, max(ts) AS ingested_at FROM v WHERE x >= 0 GROUP BY 1, 2""", "historical_volatility")
def historical_volatility_observed(t):
    """Values of at least 0, the last ingested of each hour."""
    rows = t.events.select(
        F.lit("Sim").alias("exchange"), F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("event_time"), F.col("ts").alias("open_time"), (F.col("value") - 20).alias("value"),
        F.col("ts").alias("ingested_at"), F.lit("feed").alias("source_endpoint"))
    return silver.historical_volatility_observed(rows).select("symbol", "timestamp", "historical_volatility", "ingested_at")


@query("options_ticker_observed", """SELECT 'BTC-27MAR26-' || p_partkey || '-' || CASE p_partkey % 2 WHEN 0 THEN 'C' ELSE 'P' END AS instrument_name, 'BTC' AS symbol, p_partkey::DOUBLE AS strike,
  CASE p_partkey % 2 WHEN 0 THEN 'C' ELSE 'P' END AS option_type, p_retailprice / 1000 + 1 AS implied_volatility, p_size::DOUBLE AS bid_price FROM part WHERE p_partkey % 7 <> 0""", "strike implied_volatility bid_price")
def options_ticker_observed(t):
    """Option quotes: names taken apart, unsound ones dropped, the last ingested of each time kept."""
    key = F.col("p_partkey")
    name = F.concat(F.when(key % 7 == 0, "BTC-99XXX26-").otherwise(" btc-27mar26-"), key.cast("string"), F.when(key % 2 == 0, "-c").otherwise("-p"))
    at = F.lit("2026-03-01").cast("timestamp_ntz")
    rows = t.part.select(F.lit("Sim").alias("exchange"), F.lit("feed").alias("source"), F.lit("btc").alias("symbol"), name.alias("instrument_name"), at.alias("snapshot_time"),
                         at.alias("ingested_at"), (F.col("p_retailprice") / 1000).alias("mark_iv"), F.col("p_size").alias("best_bid_price"))
    late = rows.withColumns({"mark_iv": F.col("mark_iv") + 1, "ingested_at": at + F.expr("INTERVAL 1 SECOND")})
    out = silver.options_ticker_observed(rows.unionByName(late))
    return out.select("instrument_name", "symbol", "strike", "option_type", "implied_volatility", "bid_price")


@query("option_surface_by_underlying", f"""WITH {CHAIN_SQL}, m AS (SELECT *, CASE WHEN contract % 5 < 3 THEN 'BTC' ELSE 'ETH' END AS symbol, abs(ln(strike / underlying)) <= 0.05 AS atm FROM chain WHERE iv >= 0 AND dte_days > 0 AND strike > 0)
  SELECT exchange, symbol, median(iv) FILTER (atm) AS atm_iv, median(iv) FILTER (atm AND option_type = 'P') - median(iv) FILTER (atm AND option_type = 'C') AS put_call_iv_spread,
    count(DISTINCT contract) AS contract_count FROM m GROUP BY 1, 2""", "atm_iv put_call_iv_spread")
def option_surface_by_underlying(t):
    """Surfaces of two underlyings on one venue, which don't mix."""
    rows = chain(t).withColumn("symbol", F.when(F.col("contract") % 5 < 3, "BTC").otherwise("ETH"))
    return O.surface(rows, ["exchange", "symbol"]).select("exchange", "symbol", "atm_iv", "put_call_iv_spread", "contract_count")


@query("iv_return_range", f"""WITH {QUOTES_SQL}, d AS (SELECT symbol, date_trunc('minute', ts)::TIMESTAMP AS timestamp_m1, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close FROM quotes GROUP BY 1, 2)
  SELECT symbol, timestamp_m1, high - low AS iv_range, CASE WHEN close > 0 AND lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END AS iv_return_1m FROM d WINDOW w AS (PARTITION BY symbol ORDER BY timestamp_m1)""", "iv_range iv_return_1m")
def iv_return_range(t):
    """Range and return of implied volatility between observed minutes."""
    at = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    rows = t.quotes().groupBy("exchange", "symbol", at.alias("timestamp")).agg(
        F.max("value").alias("volatility_high"), F.min("value").alias("volatility_low"), F.max_by("value", F.struct("ts", "event_id")).alias("volatility_close"))
    return silver.volatility_feature(rows.withColumn("volatility_open", F.col("volatility_close"))).select("symbol", "timestamp_m1", "iv_range", "iv_return_1m")


@query("tail_delta", """WITH k AS (SELECT o_orderpriority, max(o_orderdate) AS last FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderpriority NOT LIKE '5%' GROUP BY 1)
  SELECT o_orderpriority, count(*) AS n, min(o_orderdate) AS first_new FROM orders LEFT JOIN k USING (o_orderpriority) WHERE last IS NULL OR o_orderdate > last GROUP BY 1""")
def tail_delta(t):
    """What is newer than the known rows of each series, and all of a series that isn't known."""
    known = t.orders.where((F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & ~F.col("o_orderpriority").startswith("5"))
    new = S.tail_after(t.orders, known, ["o_orderpriority"], "o_orderdate")
    return new.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_new"))


@query("series_freshness", """SELECT l_shipmode_, last_seen, (epoch_us(TIMESTAMP '1998-12-01') - epoch_us(last_seen)) // 1000000 AS age_seconds,
    CASE WHEN epoch_us(TIMESTAMP '1998-12-01') - epoch_us(last_seen) <= 864000000000 THEN 'FRESH' ELSE 'STALE' END AS status
  FROM (SELECT l_suppkey % 50 AS l_shipmode_, max(l_shipdate) AS last_seen FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-12-01' GROUP BY 1)""")
def series_freshness(t):
    """The last row of each series, its age and whether it is fresh."""
    now = F.lit("1998-12-01").cast("timestamp_ntz")
    rows = t.lineitem.where(F.col("l_shipdate") < now).withColumn("l_shipmode_", F.col("l_suppkey") % 50)
    return S.freshness(rows, ["l_shipmode_"], "l_shipdate", now, 864_000)


@query("month_trim", "SELECT o_orderkey, o_orderdate FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1996-02-01'")
def month_trim(t):
    """The rows of one month, ends told by the calendar."""
    return S.in_month(t.orders, "o_orderdate", F.lit("1996-02-17").cast("timestamp_ntz")).select("o_orderkey", "o_orderdate")


_R = "({a}) / nullif({b}, 0)"
_W = "(PARTITION BY symbol ORDER BY ts)"
_F15 = "(PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL '899.999999 seconds' PRECEDING AND CURRENT ROW)"
_STEP = "CASE WHEN {x} > 0 AND lag({x}, {n}) OVER " + _W + " > 0 THEN ln({x} / lag({x}, {n}) OVER " + _W + ") END AS {name}"
_Z = ("CASE WHEN count({x}) OVER " + _F15 + " >= 2 THEN avg({x}) OVER " + _F15 + " END AS {n}_mean_15m, stddev_samp({x}) OVER " + _F15
      + " AS {n}_std_15m")
LIVE_SQL = f"""WITH {FULL_SQL}, b AS (SELECT symbol, timestamp_m1 AS ts, high_price, low_price, close_price, open_price, volume, quote_volume, buy_volume, sell_volume, trade_count, buy_trade_count FROM filled)
  SELECT symbol, ts, {_STEP.format(x="close_price", n=1, name="volatility_index_log_return_1m")}, {_STEP.format(x="open_price", n=5, name="index_price_log_return_5m")},
    {_R.format(a="high_price - low_price", b="close_price")} AS volatility_index_range_ratio, {_R.format(a="close_price - open_price", b="open_price")} AS futures_basis_ratio,
    {_R.format(a="volume", b="quote_volume")} AS futures_open_interest_turnover_ratio, {_R.format(a="buy_trade_count::DOUBLE", b="trade_count")} AS options_surface_quote_fill_ratio,
    {_R.format(a="high_price - low_price", b="open_price")} * 10000 AS perps_l2_spread_bps, {_R.format(a="buy_volume - sell_volume", b="buy_volume + sell_volume")} AS options_l2_depth_imbalance_ratio,
    {_Z.format(x="close_price", n="futures_mark_price")}, {_Z.format(x="open_price", n="index_price")} FROM b"""
LIVE = ("volatility_index_log_return_1m index_price_log_return_5m volatility_index_range_ratio futures_basis_ratio futures_open_interest_turnover_ratio options_surface_quote_fill_ratio"
        " perps_l2_spread_bps options_l2_depth_imbalance_ratio futures_mark_price_mean_15m futures_mark_price_std_15m index_price_mean_15m index_price_std_15m")


@query("live_extended_features", LIVE_SQL, LIVE)
def live_extended_features(t):
    """Ratios, returns and rolling moments of the live table, with a source (options' skew) that is absent."""
    b = whole_bars(t)
    live = b.select(
        "exchange", "symbol", "timestamp_m1", F.col("high_price").alias("volatility_index_high"), F.col("low_price").alias("volatility_index_low"),
        F.col("close_price").alias("volatility_index_close"), F.col("open_price").alias("index_price"), F.col("close_price").alias("futures_summary_mark_price"),
        F.col("open_price").alias("futures_summary_index_price"), F.col("volume").alias("futures_summary_open_interest"), F.col("quote_volume").alias("futures_summary_turnover"),
        F.col("buy_trade_count").alias("options_surface_fresh_quote_count"), F.col("trade_count").alias("options_surface_contract_count"),
        (F.col("high_price") - F.col("low_price")).alias("perps_l2_spread"), F.col("open_price").alias("perps_l2_mid_price"),
        F.col("buy_volume").alias("options_l2_top_bid_depth"), F.col("sell_volume").alias("options_l2_top_ask_depth"))
    out = T.live_extended(live, step=60)
    return out.select("symbol", F.col("timestamp_m1").alias("ts"), *[F.col(f"live_extended_{c}").alias(c) for c in LIVE.split()])
