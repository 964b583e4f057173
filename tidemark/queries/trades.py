"""Ticks, bars, validity and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import bars as B
from tidemark.operators import dedup as D
from tidemark.operators.grid import span_grid
from tidemark.plans.registry import query
from tidemark.sources.tables import PERP_SQL, QUOTES_SQL, SPOT_SQL, TICKS_SQL, TWICE_SQL

VALID = "price > 0 AND quantity > 0 AND isfinite(price) AND isfinite(quantity) AND trade_time IS NOT NULL AND symbol <> ''"
BARS_SQL = TICKS_SQL + f""", bars AS (
  SELECT exchange, symbol, date_trunc('minute', trade_time)::TIMESTAMP AS timestamp_m1,
    arg_min(price, (trade_time, trade_id)) AS open_price, max(price) AS high_price, min(price) AS low_price,
    arg_max(price, (trade_time, trade_id)) AS close_price, sum(quantity) AS volume, sum(price * quantity) AS quote_volume,
    count(*) AS trade_count, coalesce(sum(quantity) FILTER (side = 'buy'), 0) AS buy_volume,
    coalesce(sum(quantity) FILTER (side = 'sell'), 0) AS sell_volume, count(*) FILTER (side = 'buy') AS buy_trade_count,
    count(*) FILTER (side = 'sell') AS sell_trade_count,
    CASE WHEN sum(quantity) > 0 THEN coalesce(sum(quantity) FILTER (side = 'buy'), 0) / sum(quantity) ELSE 0 END AS buy_volume_share
  FROM ticks WHERE {VALID} GROUP BY 1, 2, 3)"""
BAR_DOUBLES = "open_price high_price low_price close_price volume quote_volume buy_volume sell_volume buy_volume_share"
GRID_SQL = BARS_SQL + """, grid AS (
  SELECT exchange, symbol, unnest(generate_series(min(timestamp_m1), max(timestamp_m1), INTERVAL 1 MINUTE)) AS timestamp_m1
  FROM bars GROUP BY 1, 2)"""


def bars(t):
    return B.minute_bars(t.ticks().where(B.valid_trade()))


@query("trade_bars_1m", f"WITH {BARS_SQL} SELECT * FROM bars", BAR_DOUBLES)
def trade_bars_1m(t):
    """Ticks to minute bars with buy and sell flow."""
    return bars(t)


@query("trades_observed", f"""WITH {TWICE_SQL} SELECT * EXCLUDE k FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_time, trade_id ORDER BY ingested_at DESC) AS k
  FROM twice WHERE {VALID}) WHERE k = 1""", "price quantity")
def trades_observed(t):
    """Valid trades, the last arrival of each."""
    return D.keep_last(t.ticks_twice().where(B.valid_trade()), ["symbol", "trade_time", "trade_id"], F.col("ingested_at"))


@query("dedup_keep_last", """SELECT l_orderkey, l_partkey, arg_max(l_suppkey, (l_shipdate, l_linenumber)) AS l_suppkey,
  max(l_shipdate) AS l_shipdate, arg_max(l_quantity, (l_shipdate, l_linenumber)) AS l_quantity
  FROM lineitem GROUP BY 1, 2""", "l_quantity")
def dedup_keep_last(t):
    """Keep the last row by time of each natural key."""
    return D.keep_last(t.lineitem, ["l_orderkey", "l_partkey"], F.col("l_shipdate"), F.col("l_linenumber")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"
    )


@query("dedup_value_key", """SELECT 'S' || (user_id % 5) AS symbol, date_trunc('hour', ts)::TIMESTAMP AS hour, value,
  max(ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2, 3""", "value")
def dedup_value_key(t):
    """Deduplication with the value in the key: equal repeats fall, changes stay."""
    return t.events.groupBy(
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "value",
    ).agg(F.max("ts").alias("ts"), F.count(F.lit(1)).alias("n"))


@query("full_row_distinct", "SELECT DISTINCT user_id, event_type, date_trunc('day', ts)::TIMESTAMP AS day FROM events")
def full_row_distinct(t):
    """Full-row distinct."""
    return t.events.select("user_id", "event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).distinct()


@query("duplicate_key_check", """SELECT l_orderkey, l_suppkey, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_key_check(t):
    """Keys that break uniqueness."""
    return D.duplicate_keys(t.lineitem, ["l_orderkey", "l_suppkey"])


@query("quality_counters", f"""WITH {TICKS_SQL} SELECT symbol, count(*) AS n_rows, count(*) FILTER (quantity IS NULL OR price IS NULL) AS null_rows,
  count(*) FILTER (NOT ({VALID})) AS invalid_rows, count(*) FILTER ({VALID}) AS clean_rows FROM ticks GROUP BY 1""")
def quality_counters(t):
    """Counters of rows that each predicate drops, in one aggregate."""
    ok = B.valid_trade()
    return t.ticks().groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("quantity").isNull() | F.col("price").isNull()).alias("null_rows"),
        F.count_if(~ok).alias("invalid_rows"), F.count_if(ok).alias("clean_rows"),
    )


def valid_ohlc(o="open", h="high", l="low", c="close"):
    o, h, l, c = map(F.col, (o, h, l, c))
    whole = o.isNotNull() & h.isNotNull() & l.isNotNull() & c.isNotNull()
    return whole & (h >= F.greatest(o, c)) & (l <= F.least(o, c))


@query("ohlcv_validate", f"""WITH {SPOT_SQL}, {PERP_SQL}, mixed AS (
  SELECT s.day, s.open, p.high, s.low, s.close FROM spot s JOIN perp p USING (day) UNION ALL SELECT day, open, high, low, close FROM spot)
  SELECT * FROM mixed WHERE high >= greatest(open, close) AND low <= least(open, close)""", "open high low close")
def ohlcv_validate(t):
    """Candles with null prices, a high below or a low above their body are dropped."""
    spot, perp = t.daily("orders"), t.daily("lineitem")
    mixed = spot.join(perp.select("day", F.col("high").alias("h")), "day").select("day", "open", F.col("h").alias("high"), "low", "close")
    return mixed.unionByName(spot.select("day", "open", "high", "low", "close")).where(valid_ohlc())


@query("funding_validity", """WITH f AS (SELECT event_type, (value - 250) / 200 AS rate FROM events)
  SELECT event_type, count(*) FILTER (rate IS NULL) AS null_rates, count(*) FILTER (abs(rate) > 1) AS out_of_range,
  count(*) FILTER (abs(rate) <= 1) AS valid_rates FROM f GROUP BY 1""")
def funding_validity(t):
    """Funding rates: finite and at most 1 in size; nulls and invalid ones counted apart."""
    rate = F.col("rate")
    return t.events.select("event_type", ((F.col("value") - 250) / 200).alias("rate")).groupBy("event_type").agg(
        F.count_if(rate.isNull()).alias("null_rates"), F.count_if(F.abs(rate) > 1).alias("out_of_range"),
        F.count_if(X.finite(rate) & (F.abs(rate) <= 1)).alias("valid_rates"),
    )


@query("state_validity", """SELECT s_nationkey, count(*) AS n, count(*) FILTER (s_acctbal >= 0) AS non_negative,
  count(*) FILTER (s_acctbal > 0 AND length(s_name) > 0) AS positive_named FROM supplier GROUP BY 1""")
def state_validity(t):
    """Validity of levels (open interest, volatility >= 0; index prices > 0), counted."""
    x = F.col("s_acctbal")
    return t.supplier.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(X.finite(x) & (x >= 0)).alias("non_negative"),
        F.count_if(X.finite(x) & (x > 0) & (F.length("s_name") > 0)).alias("positive_named"),
    )


@query("metadata_validity", """WITH m AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'option' WHEN 1 THEN 'future' ELSE 'perp' END AS instrument_type, p_size - 3 AS tick_size, p_retailprice AS contract_size,
    CASE WHEN p_size % 5 <> 0 THEN p_size - 20.0 END AS strike, CASE WHEN p_size % 7 <> 0 THEN DATE '2026-03-27' END AS expiry, CASE p_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'P' WHEN 2 THEN 'X' END AS option_type FROM part)
  SELECT p_partkey, instrument_type FROM m WHERE tick_size > 0 AND contract_size > 0 AND CASE instrument_type WHEN 'option' THEN coalesce(strike > 0 AND expiry IS NOT NULL AND option_type IN ('C', 'P'), false)
    WHEN 'future' THEN expiry IS NOT NULL ELSE true END""")
def metadata_validity(t):
    """Instrument metadata: rules that depend on the kind of instrument, as the contract has them."""
    from tidemark.plans.contracts import valid_metadata

    key, size = F.col("p_partkey"), F.col("p_size")
    rows = t.part.select(
        "p_partkey", F.when(key % 3 == 0, "option").when(key % 3 == 1, "future").otherwise("perp").alias("instrument_type"), (size - 3).alias("tick_size"),
        F.col("p_retailprice").alias("contract_size"), F.when(size % 5 != 0, size - 20.0).alias("strike"),
        F.when(size % 7 != 0, F.lit("2026-03-27").cast("date")).alias("expiry"),
        F.when(key % 4 == 0, "C").when(key % 4 == 1, "P").when(key % 4 == 2, "X").alias("option_type"))
    return rows.where(valid_metadata()).select("p_partkey", "instrument_type")


@query("funding_observed", f"""WITH {QUOTES_SQL} SELECT symbol, date_trunc('hour', ts)::TIMESTAMP AS funding_time,
  arg_max(value, (ts, value)) AS value, min(ts) AS first_ingested_at, max(ts) AS last_ingested_at, count(*) AS source_rows
  FROM quotes GROUP BY 1, 2""", "value")
def funding_observed(t):
    """Group deduplication with provenance."""
    rows = t.quotes().withColumn("funding_time", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return D.with_provenance(rows, ["symbol", "funding_time"], "value", "ts")


@query("source_priority_dedup", """WITH s AS (
  SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS hour, event_type, value, ts, event_id,
         CASE event_type WHEN 'view' THEN 1 ELSE 0 END AS priority FROM events WHERE event_type IN ('view', 'click'))
  SELECT user_id, hour, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, hour ORDER BY priority DESC, ts DESC, event_id DESC) AS k FROM s) WHERE k = 1""", "value")
def source_priority_dedup(t):
    """Of two sources the preferred one stays, then the newest row."""
    rows = t.events.where(F.col("event_type").isin("view", "click")).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    priority = F.when(F.col("event_type") == "view", 1).otherwise(0)
    return D.keep_last(rows, ["user_id", "hour"], priority, F.col("ts"), F.col("event_id")).select("user_id", "hour", "event_type", "value")


@query("last_per_minute", f"""WITH {TWICE_SQL}, d AS (
  SELECT symbol, trade_time, arg_max(price, (ingested_at, trade_id)) AS price FROM twice GROUP BY 1, 2)
  SELECT symbol, date_trunc('minute', trade_time)::TIMESTAMP AS timestamp_m1, arg_max(price, trade_time) AS price FROM d GROUP BY 1, 2""", "price")
def last_per_minute(t):
    """Two stages: the last arrival of each instant, then the last instant of each minute."""
    exact = D.keep_last(t.ticks_twice(), ["symbol", "trade_time"], F.col("ingested_at"), F.col("trade_id"))
    last = D.keep_last(exact, ["symbol", X.minute(F.col("trade_time"))], F.col("trade_time"))
    return last.select("symbol", X.minute(F.col("trade_time")).alias("timestamp_m1"), "price")


@query("fallback_key_dedup", f"""WITH {TWICE_SQL}, k AS (
  SELECT *, CASE WHEN side = 'unknown' THEN 'fallback:' || symbol || '|' || side || '|' || CAST(epoch_us(trade_time) AS VARCHAR)
                 ELSE 'id:' || trade_id END AS dedup_key FROM twice)
  SELECT dedup_key, arg_max(price, ingested_at) AS price, count(*) AS n FROM k GROUP BY 1""", "price")
def fallback_key_dedup(t):
    """A key made of the identifier, or of the trade's parts where there is none."""
    rows = t.ticks_twice()
    known = F.when(F.col("side") != "unknown", F.col("trade_id"))
    key = D.fallback_key(known, F.col("symbol"), F.col("side"), X.micros(F.col("trade_time")))
    return rows.groupBy(key.alias("dedup_key")).agg(F.max_by("price", "ingested_at").alias("price"), F.count(F.lit(1)).alias("n"))


@query("option_name_parse", r"""WITH n AS (
  SELECT p_partkey, upper(p_brand) || '-' || (1 + p_size % 31) || 'MAR26-' || p_size || CASE WHEN p_size % 2 = 0 THEN '-C' ELSE '-P' END AS name FROM part)
  SELECT p_partkey, nullif(regexp_extract(name, '^([A-Z0-9#]+)-', 1), '') AS underlying,
    CAST(try_strptime(regexp_extract(name, '-(\d{1,2}[A-Z]{3}\d{2})-', 1), '%d%b%y') AS DATE)::VARCHAR AS expiry,
    CAST(regexp_extract(name, '-(\d+)-[CP]$', 1) AS DOUBLE) AS strike, regexp_extract(name, '([CP])$', 1) AS option_type FROM n""", "strike")
def option_name_parse(t):
    """Instrument names to underlying, expiry, strike and type."""
    parts = X.option_parts(F.col("name"))
    return option_names(t).select("p_partkey", *[c.alias(n) for n, c in parts.items()]).withColumn("expiry", F.col("expiry").cast("string"))


def option_names(t):
    day = (F.col("p_size") % 31 + 1).cast("string")
    kind = F.when(F.col("p_size") % 2 == 0, "-C").otherwise("-P")
    return t.part.withColumn("name", F.concat(F.upper("p_brand"), F.lit("-"), day, F.lit("MAR26-"), F.col("p_size").cast("string"), kind))


@query("symbol_normalize", r"""SELECT DISTINCT p_name, upper(regexp_replace(trim(' ' || lower(p_name) || '/usd_perp '), '[/_:\s]+', '-', 'g')) AS symbol,
  split_part(upper(regexp_replace(trim(' ' || lower(p_name) || '/usd_perp '), '[/_:\s]+', '-', 'g')), '-', 1) AS base FROM part""")
def symbol_normalize(t):
    """Symbols in one spelling, and their base asset."""
    raw = F.concat(F.lit(" "), F.lower("p_name"), F.lit("/usd_perp "))
    return t.part.select("p_name", X.normal_symbol(raw).alias("symbol"), X.base_asset(raw).alias("base")).distinct()


@query("minute_grid", f"WITH {GRID_SQL} SELECT * FROM grid")
def minute_grid(t):
    """Every minute between the first and the last bar of each series."""
    return span_grid(bars(t), ["exchange", "symbol"], "timestamp_m1")


@query("confirmed_empty_minutes", f"WITH {GRID_SQL} SELECT g.*, 'confirmed_empty' AS status FROM grid g ANTI JOIN bars b USING (exchange, symbol, timestamp_m1)")
def confirmed_empty_minutes(t):
    """Minutes of the grid without a bar, as negative coverage."""
    own = bars(t)
    return span_grid(own, B.KEYS, "timestamp_m1").join(own, [*B.KEYS, "timestamp_m1"], "left_anti").withColumn("status", F.lit("confirmed_empty"))


FULL_SQL = GRID_SQL + """, whole AS (
  SELECT g.exchange, g.symbol, g.timestamp_m1, b.* EXCLUDE (exchange, symbol, timestamp_m1)
  FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.timestamp_m1 = b.timestamp_m1),
filled AS (
  SELECT exchange, symbol, timestamp_m1,
    coalesce(open_price, last_value(close_price IGNORE NULLS) OVER w) AS open_price,
    coalesce(high_price, last_value(close_price IGNORE NULLS) OVER w) AS high_price,
    coalesce(low_price, last_value(close_price IGNORE NULLS) OVER w) AS low_price,
    coalesce(close_price, last_value(close_price IGNORE NULLS) OVER w) AS close_price,
    coalesce(volume, 0) AS volume, coalesce(quote_volume, 0) AS quote_volume, coalesce(trade_count, 0) AS trade_count,
    coalesce(buy_volume, 0) AS buy_volume, coalesce(sell_volume, 0) AS sell_volume, coalesce(buy_trade_count, 0) AS buy_trade_count,
    coalesce(sell_trade_count, 0) AS sell_trade_count, coalesce(buy_volume_share, 0) AS buy_volume_share
  FROM whole WINDOW w AS (PARTITION BY exchange, symbol ORDER BY timestamp_m1))"""


def whole_bars(t):
    """A bar for each minute of the grid: traded, or confirmed empty with the last close."""
    own = bars(t)
    return B.fill_prices(B.with_empty_minutes(own, span_grid(own, B.KEYS, "timestamp_m1")))


@query("trade_bars_with_empty_minutes", f"WITH {GRID_SQL} SELECT exchange, symbol, timestamp_m1, close_price, coalesce(volume, 0) AS volume, coalesce(trade_count, 0) AS trade_count FROM grid LEFT JOIN bars USING (exchange, symbol, timestamp_m1)", "close_price volume")
def trade_bars_with_empty_minutes(t):
    """Bars, and empty minutes that no bar covers."""
    own = bars(t)
    return B.with_empty_minutes(own, span_grid(own, B.KEYS, "timestamp_m1")).select("exchange", "symbol", "timestamp_m1", "close_price", "volume", "trade_count")


@query("ffill_from_close", f"WITH {FULL_SQL} SELECT * FROM filled", BAR_DOUBLES)
def ffill_from_close(t):
    """Prices of empty minutes from the last known close."""
    return whole_bars(t)
