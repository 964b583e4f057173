"""Silver states, Gold assembly, publication, merges, exports and closing streams, built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sync as S
from tidemark.plans import gold, silver
from tidemark.plans.registry import query
from tidemark.queries.features import z_sql
from tidemark.queries.trades import BARS_SQL, FULL_SQL, bars, whole_bars
from tidemark.sources import lake
from tidemark.sources.scratch import scratch
from tidemark.sources.tables import QUOTES_SQL

CORE_SQL = BARS_SQL + f""", {QUOTES_SQL}, spot AS (
  SELECT symbol, date_trunc('minute', ts)::TIMESTAMP AS m, arg_min(value, (ts, event_id)) AS o, max(value) AS h, min(value) AS l, arg_max(value, (ts, event_id)) AS c, count(*)::DOUBLE AS v
  FROM quotes GROUP BY 1, 2),
points AS (SELECT symbol, timestamp_m1 AS m FROM bars UNION SELECT symbol, m FROM spot),
steps AS (SELECT symbol, unnest(generate_series(min(m), max(m), INTERVAL 1 MINUTE)) AS ts FROM points GROUP BY 1),
core AS (SELECT g.symbol, g.ts, o, h, l, c, v, s.symbol IS NOT NULL AS has_spot, b.open_price, b.high_price, b.low_price, b.close_price, b.volume, b.quote_volume, b.trade_count,
    b.symbol IS NOT NULL AS has_perp
  FROM steps g LEFT JOIN spot s ON g.symbol = s.symbol AND g.ts = s.m LEFT JOIN bars b ON g.symbol = b.symbol AND g.ts = b.timestamp_m1)"""


def core(t, seconds=60):
    """The Gold table of spot and perpetual candles, from Bronze ones."""
    at = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    place = F.struct("ts", "event_id")
    spot = t.quotes().groupBy("exchange", "symbol", at.alias("open_time")).agg(
        F.min_by("value", place).alias("open_price"), F.max("value").alias("high_price"), F.min("value").alias("low_price"), F.max_by("value", place).alias("close_price"),
        F.count(F.lit(1)).cast("double").alias("volume")).withColumn("ingested_at", F.col("open_time"))
    perps = bars(t).withColumnRenamed("timestamp_m1", "open_time").withColumn("ingested_at", F.col("open_time"))
    return gold.build("market.core", {"spot_ohlcv": silver.ohlcv(spot), "perps_ohlcv": silver.ohlcv(perps)}, seconds)


CORE_DOUBLES = "spot_ohlcv_open_price spot_ohlcv_high_price spot_ohlcv_close_price spot_ohlcv_volume perp_open_price perp_low_price perp_close_price perp_volume perp_quote_volume"


@query("gold_market_core_30m", f"""WITH {CORE_SQL} SELECT symbol, time_bucket(INTERVAL '30 minutes', ts)::TIMESTAMP AS ts,
  arg_min(o, ts) FILTER (o IS NOT NULL) AS spot_ohlcv_open_price, max(h) AS spot_ohlcv_high_price, arg_max(c, ts) FILTER (c IS NOT NULL) AS spot_ohlcv_close_price,
  coalesce(sum(v), 0) AS spot_ohlcv_volume, arg_min(open_price, ts) FILTER (open_price IS NOT NULL) AS perp_open_price, min(low_price) AS perp_low_price,
  arg_max(close_price, ts) FILTER (close_price IS NOT NULL) AS perp_close_price, coalesce(sum(volume), 0) AS perp_volume, coalesce(sum(quote_volume), 0) AS perp_quote_volume,
  coalesce(sum(trade_count), 0)::BIGINT AS perp_trade_count, arg_max(has_spot, ts) AS spot_ohlcv_available, arg_max(has_perp, ts) AS perps_ohlcv_available FROM core GROUP BY 1, 2""", CORE_DOUBLES)
def gold_market_core_30m(t):
    """Bronze candles of two markets, validated, joined onto their union grid and resampled to half hours."""
    return core(t, 1800).select("symbol", F.col("timestamp_m1").alias("ts"), *CORE_DOUBLES.split(), "perp_trade_count", "spot_ohlcv_available", "perps_ohlcv_available")


def _step(n: int) -> str:
    return f"CASE WHEN close_price > 0 AND lag(close_price, {n}) OVER w > 0 THEN ln(close_price / lag(close_price, {n}) OVER w) END"


STRATEGY = "momentum_log_return_1m momentum_log_return_5m momentum_vol_scaled_5m momentum_vol_scaled_15m cost_spot_perp_spread cost_turnover_notional_1m reversion_spot_perp_spread_zscore_15m"


@query("gold_strategy_features", f"""WITH {CORE_SQL}, s AS (SELECT symbol, ts, close_price * volume AS cost_turnover_notional_1m, close_price / nullif(c, 0) - 1 AS cost_spot_perp_spread,
    {_step(1)} AS momentum_log_return_1m, {_step(5)} AS momentum_log_return_5m, CASE WHEN volume <> 0 THEN {_step(5)} / volume END AS momentum_vol_scaled_5m,
    CASE WHEN volume <> 0 THEN {_step(15)} / volume END AS momentum_vol_scaled_15m FROM core WINDOW w AS (PARTITION BY symbol ORDER BY ts))
  SELECT *, {z_sql('cost_spot_perp_spread', 900, 'reversion_spot_perp_spread_zscore_15m')} FROM s""", STRATEGY)
def gold_strategy_features(t):
    """Momentum, scaled by a stand-in for volatility, and costs on the Gold table of two markets."""
    out = gold.with_strategy_features(core(t).withColumn("rv_1h", F.col("perp_volume")))
    return out.select("symbol", F.col("timestamp_m1").alias("ts"), *STRATEGY.split())


def state_sql(values: str) -> str:
    """The last of each minute's ``quotes``, on the span of each symbol, without state across months."""
    return f"""{QUOTES_SQL}, exact AS (SELECT symbol, ts AS src, {values} FROM quotes WHERE value > 0 GROUP BY 1, 2),
last AS (SELECT symbol, date_trunc('minute', src)::TIMESTAMP AS m, arg_max(x, src) AS x, arg_max(y, src) AS y, max(src) AS src FROM exact GROUP BY 1, 2),
span AS (SELECT symbol, unnest(generate_series(min(m), max(m), INTERVAL 1 MINUTE)) AS timestamp_m1 FROM last GROUP BY 1),
state AS (SELECT g.symbol, g.timestamp_m1, x, y, src, g.timestamp_m1 = m AS same, (epoch_us(g.timestamp_m1) - epoch_us(m)) // 60000000 AS since
  FROM span g ASOF LEFT JOIN last l ON g.symbol = l.symbol AND date_trunc('month', g.timestamp_m1) = date_trunc('month', l.m) AND g.timestamp_m1 >= l.m)"""


def observations(t):
    """Quotes with a time of arrival that orders those of one instant."""
    return t.quotes().where("value > 0").withColumns({"ingested_at": F.timestamp_micros("event_id").cast("timestamp_ntz"), "source": F.lit("feed")})


@query("index_price_state", f"""WITH {state_sql('arg_max(value, event_id) AS x, 0 AS y')}
  SELECT symbol, timestamp_m1, x AS index_price, same AS index_price_is_observed, src AS index_price_source_timestamp, since AS minutes_since_index_price_observation FROM state""", "index_price")
def index_price_state(t):
    """Index prices, observed and then carried over the minutes of their span, with their age."""
    seen = silver.index_price_observed(observations(t).select("exchange", "symbol", F.col("ts").alias("event_time"), F.lit("Idx").alias("index_name"), F.col("value").alias("price"),
                                                              F.col("ts").alias("snapshot_time"), "ingested_at", "source"))
    return silver.index_price_feature(seen).drop("exchange")


@query("futures_summary_state", f"""WITH {state_sql('arg_max(value, event_id) AS x, arg_max(CASE WHEN event_id % 2 = 0 THEN value + 1 ELSE value - 30 END, event_id) AS y')}
  SELECT symbol, timestamp_m1, x AS mark_price, y AS index_price, x - y AS mark_index_spread, CASE WHEN y > 0 THEN x / y END AS mark_index_ratio, same AS summary_is_observed,
    since AS minutes_since_summary_observation FROM state""", "mark_price index_price mark_index_spread mark_index_ratio")
def futures_summary_state(t):
    """Mark against index price: the underlying's, else the estimated delivery's."""
    even = F.col("event_id") % 2 == 0
    rows = observations(t).select("exchange", F.col("symbol").alias("instrument_name"), F.col("ts").alias("snapshot_time"), F.lit("Future").alias("instrument_type"), F.col("value").alias("mark_price"),
                                  F.when(even, F.col("value") + 1).alias("underlying_price"), F.when(~even, F.col("value") - 30).alias("estimated_delivery_price"), "ingested_at", "source")
    return silver.futures_summary_feature(silver.futures_summary_observed(rows)).select(
        "symbol", "timestamp_m1", "mark_price", "index_price", "mark_index_spread", "mark_index_ratio", "summary_is_observed", "minutes_since_summary_observation")


@query("open_interest_state", f"""WITH {QUOTES_SQL}, last AS (SELECT symbol, date_trunc('minute', ts)::TIMESTAMP AS m, arg_max(value, event_id) AS x, arg_max(ts, event_id) AS src FROM quotes WHERE value > 0 GROUP BY 1, 2),
  span AS (SELECT symbol, unnest(generate_series(date_trunc('month', min(m))::TIMESTAMP, max(m), INTERVAL 1 MINUTE)) AS timestamp_m1 FROM last GROUP BY 1)
  SELECT g.symbol, g.timestamp_m1, x AS open_interest, coalesce(g.timestamp_m1 = m, false) AS open_interest_is_observed, coalesce(g.timestamp_m1 <> m, true) AS open_interest_is_ffill,
    (epoch_us(g.timestamp_m1) - epoch_us(m)) // 60000000 AS minutes_since_open_interest_observation, greatest(0, (epoch_us(g.timestamp_m1) - epoch_us(src)) // 1000000) AS open_interest_observation_lag_sec
  FROM span g ASOF LEFT JOIN last l ON g.symbol = l.symbol AND date_trunc('month', g.timestamp_m1) = date_trunc('month', l.m) AND g.timestamp_m1 >= l.m""", "open_interest")
def open_interest_state(t):
    """Open interest from the start of the first month, with its age; no state crosses a month."""
    rows = observations(t).select("exchange", "symbol", F.col("ts").alias("open_time"), F.col("value").alias("open_interest"), "ingested_at")
    return silver.open_interest_feature(silver.open_interest_observed(rows)).drop("exchange", "open_interest_source_timestamp")


def _z(x: str, n: int) -> str:
    own = f"OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {own} >= 2 AND stddev_samp({x}) {own} > 0 THEN ({x} - avg({x}) {own}) / stddev_samp({x}) {own} END"


PREDICTION = "basis_change_1m basis_zscore_1h open_interest_zscore_1h funding_rate_zscore_1d funding_basis_divergence perps_trade_imbalance perps_rv_15m perps_price_impact_1m flow_volatility_pressure"


@query("historical_prediction", f"""WITH {FULL_SQL}, f AS (SELECT symbol, timestamp_m1 AS ts, close_price / nullif(open_price, 0) - 1 AS basis, volume AS oi, buy_volume_share AS fr, buy_volume AS b, sell_volume AS a,
    quote_volume AS q, CASE WHEN close_price > 0 AND lag(close_price) OVER w > 0 THEN ln(close_price / lag(close_price) OVER w) END AS r FROM filled WINDOW w AS (PARTITION BY symbol ORDER BY timestamp_m1)),
  z AS (SELECT *, {_z('q', 60)} AS zq, {_z('oi', 60)} AS zo FROM f)
  SELECT symbol, ts, basis - lag(basis) OVER v AS basis_change_1m, {_z('basis', 60)} AS basis_zscore_1h, zo AS open_interest_zscore_1h, {_z('fr', 1440)} AS funding_rate_zscore_1d,
    fr - basis AS funding_basis_divergence, (b - a) / nullif(b + a, 0) AS perps_trade_imbalance, abs(r) / nullif(q, 0) AS perps_price_impact_1m,
    CASE WHEN count(r) OVER u >= 2 THEN sqrt(sum(r * r) OVER u) END AS perps_rv_15m, coalesce(zq, 0) + coalesce(zo, 0) + coalesce(zo, 0) AS flow_volatility_pressure
  FROM z WINDOW v AS (PARTITION BY symbol ORDER BY ts), u AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)""", PREDICTION)
def historical_prediction(t):
    """Windows of rows of returns, basis, funding and flows, and their composite pressure."""
    b = whole_bars(t).select(
        "exchange", "symbol", "timestamp_m1", F.col("open_price").alias("spot_close"), F.col("close_price").alias("perps_close"), F.col("volume").alias("open_interest"),
        F.col("buy_volume_share").alias("funding_rate"), F.col("buy_volume").alias("perps_buy_volume"), F.col("sell_volume").alias("perps_sell_volume"),
        F.col("trade_count").alias("perps_trade_count"), F.col("quote_volume").alias("perps_quote_volume"), F.col("buy_volume").alias("options_buy_volume"),
        F.col("sell_volume").alias("options_sell_volume"), F.col("trade_count").alias("options_trade_count"), F.col("volume").alias("options_quote_volume"))
    out = silver.historical_prediction_feature(b)
    return out.select("symbol", F.col("timestamp_m1").alias("ts"), *[F.col(f"historical_prediction_{c}").alias(c) for c in PREDICTION.split()])


@query("publish_and_roll_back", "SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders", "o_totalprice")
def publish_and_roll_back(t):
    """Three versions are published and the newest is withdrawn: readers get the second, whose patch is a date."""
    root = scratch(t.spark, "published")
    for n, version in enumerate(("1.0.3", "1.0.20260731", "2.0.0")):
        lake.publish(t.orders.select("o_orderkey", (F.col("o_totalprice") + n).alias("o_totalprice")), root, version, ["o_orderkey"], "demo")
    lake.roll_back(t.spark, root)
    return lake.published(t.spark, root)


@query("merge_by_partition", "SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, o_totalprice + CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) = 1994 THEN 10 ELSE 0 END AS o_totalprice FROM orders", "o_totalprice")
def merge_by_partition(t):
    """Corrections merged by key into a table by years: only the years that get rows are rewritten."""
    at = scratch(t.spark, "by-year")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), "o_orderstatus")
    rows.drop("o_orderstatus").repartition("year").write.partitionBy("year").parquet(at)
    new = rows.where("o_orderstatus = 'F' AND year = 1994").select("o_orderkey", (F.col("o_totalprice") + 10).alias("o_totalprice"), "year")
    lake.merge_partitions(t.spark, at, new, ["o_orderkey"], ["year"])
    return t.spark.read.parquet(at).select("o_orderkey", "year", "o_totalprice")


@query("freshest_of_files", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice FROM orders", "o_totalprice")
def freshest_of_files(t):
    """Two generations of files that overlap: of one key the row of the newer file counts."""
    paths = [scratch(t.spark, "generation") for _ in range(2)]
    t.orders.select("o_orderkey", "o_totalprice").write.parquet(paths[0])
    t.orders.where("o_orderstatus = 'F'").select("o_orderkey", (F.col("o_totalprice") + 10).alias("o_totalprice")).write.parquet(paths[1])
    return lake.freshest(t.spark, paths, ["o_orderkey"])


@query("combined_export", """WITH c AS (
    SELECT 'orders' AS exchange, 'spot' AS instrument_type, o_orderpriority AS symbol, '1d' AS timeframe, date_trunc('day', o_orderdate)::TIMESTAMP AS open_time, max(o_totalprice) AS high_price, NULL::DOUBLE AS volume
      FROM orders GROUP BY 3, 5
    UNION ALL SELECT 'lineitem', 'perp', l_shipmode, '1d', date_trunc('day', l_shipdate)::TIMESTAMP, max(l_extendedprice), sum(l_quantity) FROM (SELECT *, 'M' || l_suppkey % 3 AS l_shipmode FROM lineitem) GROUP BY 3, 5),
  k AS (SELECT * FROM c WHERE open_time BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31' ORDER BY open_time, exchange, instrument_type, symbol, timeframe LIMIT 1000),
  oi AS (SELECT o_orderpriority AS symbol, date_trunc('day', o_orderdate)::TIMESTAMP AS open_time, arg_max(o_totalprice, o_orderkey) AS open_interest FROM orders GROUP BY 1, 2)
  SELECT k.*, CASE WHEN exchange = 'orders' THEN open_interest END AS open_interest, CASE WHEN exchange = 'orders' THEN open_interest * 2 END AS open_interest_value
  FROM k LEFT JOIN oi ON k.symbol = oi.symbol AND k.open_time = oi.open_time""", "high_price volume open_interest open_interest_value")
def combined_export(t):
    """Daily candles of two sources in one export of a thousand rows, with the last open interest of each key."""
    day = lambda c: F.date_trunc("day", c).cast("timestamp_ntz").alias("open_time")
    named = lambda x, kind: [F.lit(x).alias("exchange"), F.lit(kind).alias("instrument_type")]
    spot = t.orders.select(*named("orders", "spot"), F.col("o_orderpriority").alias("symbol"), F.lit("1d").alias("timeframe"), day("o_orderdate"), "o_totalprice", "o_orderkey")
    perp = t.lineitem.select(*named("lineitem", "perp"), F.concat(F.lit("M"), (F.col("l_suppkey") % 3).cast("string")).alias("symbol"), F.lit("1d").alias("timeframe"), day("l_shipdate"), "l_extendedprice", "l_quantity")
    candles = [spot.groupBy(*lake.EXPORT_KEYS).agg(F.max("o_totalprice").alias("high_price")),
               perp.groupBy(*lake.EXPORT_KEYS).agg(F.max("l_extendedprice").alias("high_price"), F.sum("l_quantity").cast("double").alias("volume"))]
    oi = spot.select(*lake.EXPORT_KEYS, F.col("o_totalprice").alias("open_interest"), (F.col("o_totalprice") * 2).alias("open_interest_value"), F.col("o_orderkey").alias("ingested_at"))
    ends = [F.lit(x).cast("timestamp_ntz") for x in ("1995-01-01", "1996-12-31")]
    return lake.combined_export(candles, oi, *ends, limit=1000)


@query("artifact_freshness", """WITH a AS (SELECT o_custkey, max((o_orderdate, o_orderkey)) AS newest FROM orders GROUP BY 1), n AS (SELECT o_custkey, newest[1] AS built, newest[2] AS path FROM a)
  SELECT c_custkey AS series, path, built, CASE WHEN path IS NULL THEN 'missing' WHEN o_orderkey IS NOT NULL THEN 'current' ELSE 'blocked' END AS status
  FROM customer LEFT JOIN n ON o_custkey = c_custkey LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') m ON m.o_orderkey = path""")
def artifact_freshness(t):
    """The newest artifact of each series: missing, blocked for want of a manifest, or current."""
    made = t.orders.select(F.col("o_custkey").alias("series"), F.col("o_orderkey").alias("path"), F.col("o_orderdate").alias("built"), "o_orderstatus")
    return S.artifact_status(t.customer.select(F.col("c_custkey").alias("series")), made, made.where("o_orderstatus = 'F'"), ["series"], "path", "built")


@query("dataset_states", """WITH found AS (SELECT DISTINCT CASE user_id % 2 WHEN 0 THEN 'bronze' ELSE 'silver' END AS layer, event_type AS dataset FROM events),
  known AS (SELECT DISTINCT 'bronze' AS layer, event_type AS dataset FROM events WHERE event_type < 'p' UNION SELECT DISTINCT 'silver', event_type || CASE WHEN event_type < 'p' THEN '' ELSE '_1m' END FROM events)
  SELECT f.layer, f.dataset, CASE WHEN k.dataset IS NULL THEN 'unmapped' ELSE 'mapped' END AS state FROM found f LEFT JOIN known k ON k.layer = f.layer AND k.dataset = f.dataset WHERE f.layer = 'bronze'
  UNION ALL SELECT k.layer, k.dataset, CASE WHEN f.dataset IS NOT NULL THEN 'materialized' WHEN k.dataset = 'view_1m' AND EXISTS (SELECT 1 FROM found o WHERE o.layer = 'silver' AND o.dataset = 'view') THEN 'legacy_artifact' ELSE 'not_materialized' END
  FROM known k LEFT JOIN found f ON k.layer = f.layer AND k.dataset = f.dataset WHERE k.layer <> 'bronze'""")
def dataset_states(t):
    """Which datasets are mapped, made, made under an older name, or not made."""
    kind, first = F.col("event_type"), F.col("event_type") < "p"
    found = t.events.select(F.when(F.col("user_id") % 2 == 0, "bronze").otherwise("silver").alias("layer"), kind.alias("dataset"))
    known = t.events.where(first).select(F.lit("bronze").alias("layer"), kind.alias("dataset")).unionByName(
        t.events.select(F.lit("silver").alias("layer"), F.concat(kind, F.when(first, "").otherwise("_1m")).alias("dataset")))
    return S.dataset_states(found, known, {"view_1m": "view"})


@query("streaming_closed_minutes", """SELECT event_type, date_trunc('minute', ts)::TIMESTAMP AS timestamp_m1, count(*) AS n, max(value) AS high, min(value) AS low, sum(value) AS total FROM events
  WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2""", "high low total")
def streaming_closed_minutes(t):
    """What a stream has appended when the table ends: minutes that the watermark, a day behind, has passed."""
    from tidemark.streaming.bars import follow_minute_bars

    out = scratch(t.spark, "closed-minutes")
    follow_minute_bars(t.spark, f"{t.sf_dir}/events.parquet", out, scratch(t.spark, "closed-minutes-state"), "1 day")
    return t.spark.read.parquet(out)
