"""Joins, as-of state, reconciliation, options, books, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import audit as A
from tidemark.operators import book as K
from tidemark.operators import options as O
from tidemark.operators.asof import asof, leaks, staleness
from tidemark.operators.bars import KEYS
from tidemark.operators.grid import month_grid, span_grid
from tidemark.plans.registry import query
from tidemark.queries.trades import BARS_SQL, GRID_SQL, bars
from tidemark.sources.tables import PERP_SQL, QUOTES_SQL, SPOT_SQL, TICKS_SQL

MONTH_SQL = QUOTES_SQL + """, grid AS (
  SELECT symbol, unnest(generate_series(date_trunc('month', min(ts))::TIMESTAMP, date_trunc('hour', max(ts))::TIMESTAMP, INTERVAL 1 HOUR)) AS ts
  FROM quotes GROUP BY 1)"""


@query("asof_funding", f"""WITH {MONTH_SQL} SELECT g.symbol, g.ts, q.ts AS observed_at, q.value AS funding_rate
  FROM grid g ASOF LEFT JOIN (SELECT symbol, ts, arg_max(value, event_id) AS value FROM quotes GROUP BY 1, 2) q
  ON g.symbol = q.symbol AND g.ts >= q.ts""", "funding_rate")
def asof_funding(t):
    """Backward as-of of a sparse state onto a calendar that starts with the month."""
    q = t.quotes()
    grid = month_grid(q, ["symbol"], "ts", 3600, "ts")
    return asof(grid, q.withColumn("observed_at", F.col("ts")).withColumnRenamed("value", "funding_rate"), "ts", ["symbol"],
                ["observed_at", "funding_rate"], tie="event_id")


@query("asof_open_interest", f"""WITH {QUOTES_SQL}, d AS (SELECT ts, arg_max(value, event_id) AS value FROM quotes GROUP BY 1)
  SELECT e.event_id, e.ts, d.ts AS observed_at, d.value AS open_interest FROM events e
  ASOF LEFT JOIN d ON date_trunc('month', e.ts) = date_trunc('month', d.ts) AND e.ts >= d.ts""", "open_interest")
def asof_open_interest(t):
    """As-of onto every event, of one series, with no state across months."""
    q = t.quotes().select(F.lit(1).alias("one"), "ts", "event_id", F.col("value").alias("open_interest"), F.col("ts").alias("observed_at"))
    left = t.events.select(F.lit(1).alias("one"), "event_id", "ts")
    return asof(left, q, "ts", ["one"], ["observed_at", "open_interest"], tie="event_id", reset="month").drop("one")


@query("asof_by_symbol", f"""WITH {BARS_SQL}, {QUOTES_SQL}, d AS (SELECT symbol, ts, arg_max(value, event_id) AS value FROM quotes GROUP BY 1, 2)
  SELECT b.symbol, b.timestamp_m1, b.close_price, d.value AS index_price FROM bars b ASOF LEFT JOIN d ON b.symbol = d.symbol AND b.timestamp_m1 >= d.ts""",
       "close_price index_price")
def asof_by_symbol(t):
    """As-of by exchange and symbol."""
    q = t.quotes().select("exchange", "symbol", "ts", "event_id", F.col("value").alias("index_price"))
    left = bars(t).select("exchange", "symbol", "timestamp_m1", "close_price")
    return asof(left, q, "timestamp_m1", KEYS, ["index_price"], right_on="ts", tie="event_id").drop("exchange")


@query("staleness_minutes", f"""WITH {MONTH_SQL}, d AS (SELECT DISTINCT symbol, ts FROM quotes), a AS (
  SELECT g.symbol, g.ts, d.ts AS observed_at FROM grid g ASOF LEFT JOIN d ON g.symbol = d.symbol AND g.ts >= d.ts)
  SELECT *, (epoch_us(ts) - epoch_us(observed_at)) // 60000000 AS minutes_since, (epoch_us(ts) - epoch_us(observed_at)) // 1000000 AS lag_sec,
    coalesce(ts = observed_at, false) AS is_observed, coalesce(ts <> observed_at, true) AS is_ffill, observed_at IS NOT NULL AS available FROM a""")
def staleness_minutes(t):
    """Staleness columns of an as-of state."""
    q = t.quotes()
    grid = month_grid(q, ["symbol"], "ts", 3600, "ts")
    state = asof(grid, q.withColumn("observed_at", F.col("ts")), "ts", ["symbol"], ["observed_at"], tie="event_id")
    return staleness(state, "ts", "observed_at")


@query("asof_leak_check", f"""WITH {TICKS_SQL}, {QUOTES_SQL}, d AS (SELECT DISTINCT symbol, ts FROM quotes), a AS (
  SELECT e.symbol, e.trade_time, d.ts AS observed_at FROM ticks e ASOF LEFT JOIN d ON e.symbol = d.symbol AND e.trade_time >= d.ts)
  SELECT symbol, count(*) AS n_rows, count(observed_at) AS n_known, count(*) FILTER (observed_at > trade_time) AS leaks FROM a GROUP BY 1""")
def asof_leak_check(t):
    """No as-of state is later than its row: counted over every tick, beside the rows that have a state."""
    q = t.quotes().withColumn("observed_at", F.col("ts"))
    joined = asof(t.ticks().select("symbol", "trade_time", "trade_id"), q, "trade_time", ["symbol"], ["observed_at"], right_on="ts", tie="event_id")
    bad = leaks(joined, "trade_time", "observed_at").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    rows = joined.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.count("observed_at").alias("n_known"))
    return rows.join(bad, "symbol", "left").select("symbol", "n_rows", "n_known", F.coalesce("n", F.lit(0)).cast("long").alias("leaks"))


@query("iv_change_lookback", f"""WITH {QUOTES_SQL}, d AS (SELECT symbol, ts, arg_max(value, event_id) AS value FROM quotes GROUP BY 1, 2)
  SELECT a.symbol, a.event_id, a.value - b.value AS change_1h, a.value - c.value AS change_1d FROM quotes a
  ASOF LEFT JOIN d b ON a.symbol = b.symbol AND a.ts - INTERVAL 1 HOUR >= b.ts
  ASOF LEFT JOIN d c ON a.symbol = c.symbol AND a.ts - INTERVAL 1 DAY >= c.ts""", "change_1h change_1d")
def iv_change_lookback(t):
    """Change against the value known an hour and a day before: as-of self-joins."""
    q = t.quotes()
    hour = asof(q, q.withColumnRenamed("value", "v1"), "ts", ["symbol"], ["v1"], tie="event_id", lookback=3600)
    day = asof(hour, q.withColumnRenamed("value", "v2"), "ts", ["symbol"], ["v2"], tie="event_id", lookback=86400)
    return day.select("symbol", "event_id", (F.col("value") - F.col("v1")).alias("change_1h"), (F.col("value") - F.col("v2")).alias("change_1d"))


@query("gold_grid_left_join", f"""WITH {GRID_SQL}, {QUOTES_SQL}, q AS (
  SELECT symbol, date_trunc('minute', ts)::TIMESTAMP AS timestamp_m1, arg_max(value, (ts, event_id)) AS oi FROM quotes GROUP BY 1, 2)
  SELECT g.exchange, g.symbol, g.timestamp_m1, b.close_price AS perp_close_price, b.volume AS perp_volume, q.oi AS open_interest, b.symbol IS NOT NULL AS perp_available,
         q.symbol IS NOT NULL AS open_interest_available
  FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.timestamp_m1 = b.timestamp_m1 LEFT JOIN q ON g.symbol = q.symbol AND g.timestamp_m1 = q.timestamp_m1""",
       "perp_close_price perp_volume open_interest")
def gold_grid_left_join(t):
    """Sources joined in turn onto the union grid, prefixed, with availability flags."""
    from tidemark.plans.gold import assemble

    own = bars(t)
    q = t.quotes().groupBy("exchange", "symbol", X.minute(F.col("ts")).alias("timestamp_m1")).agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("interest"))
    grid = span_grid(own, KEYS, "timestamp_m1")
    return assemble(grid, {"perp": own.select(*KEYS, "timestamp_m1", "close_price", "volume"),
                           "open": q.select(*KEYS, "timestamp_m1", "interest")}).select(
        *KEYS, "timestamp_m1", "perp_close_price", "perp_volume", F.col("open_interest"), "perp_available",
        F.col("open_available").alias("open_interest_available"))


@query("full_outer_coalesce", f"""WITH {SPOT_SQL}, {PERP_SQL} SELECT coalesce(s.day, p.day) AS day, s.close AS spot_close, p.close AS perp_close,
  p.close / nullif(s.close, 0) - 1 AS basis FROM spot s FULL JOIN perp p ON s.day = p.day""", "spot_close perp_close basis")
def full_outer_coalesce(t):
    """Full outer join with one key column."""
    s, p = t.daily("orders"), t.daily("lineitem")
    out = s.select("day", F.col("close").alias("spot_close")).join(p.select("day", F.col("close").alias("perp_close")), "day", "full_outer")
    return out.withColumn("basis", X.ratio(F.col("perp_close"), F.col("spot_close")) - 1)


@query("ohlcv_with_oi", f"""WITH {SPOT_SQL}, oi AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, sum(value) AS open_interest FROM events GROUP BY 1)
  SELECT s.day, s.open, s.close, oi.open_interest FROM spot s LEFT JOIN oi USING (day)""", "open close open_interest")
def ohlcv_with_oi(t):
    """Candles with open interest joined on, absent where there is none."""
    oi = t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.sum("value").alias("open_interest"))
    return t.daily("orders").select("day", "open", "close").join(oi, "day", "left")


@query("instrument_minute_grid", """WITH i AS (SELECT p_brand AS instrument FROM part WHERE p_size > 25 GROUP BY 1),
  h AS (SELECT unnest(generate_series(date_trunc('hour', min(ts))::TIMESTAMP, date_trunc('hour', max(ts))::TIMESTAMP, INTERVAL 1 HOUR)) AS ts FROM events)
  SELECT instrument, ts FROM i, h""")
def instrument_minute_grid(t):
    """Instruments x calendar: instruments are filtered first, the calendar is generated for each."""
    names = t.part.where("p_size > 25").select(F.col("p_brand").alias("instrument")).distinct()
    bounds = t.events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    spans = names.join(F.broadcast(bounds), F.lit(True))  # one row of bounds
    ends = spans.select("instrument", F.explode(F.array("low", "high")).alias("ts"))
    return span_grid(ends, ["instrument"], "ts", 3600, "ts")


@query("reconcile_sources", """WITH a AS (SELECT l_orderkey AS k, sum(l_extendedprice * (1 - l_discount)) AS v FROM lineitem GROUP BY 1)
  SELECT count(*) FILTER (o_orderkey IS NULL) AS only_a, count(*) FILTER (k IS NULL) AS only_b, count(*) FILTER (k IS NOT NULL AND o_orderkey IS NOT NULL) AS overlap,
  count(*) FILTER (abs(v - o_totalprice) > 1000) AS mismatches FROM a FULL JOIN orders ON k = o_orderkey""")
def reconcile_sources(t):
    """Two sources of one quantity: only here, only there, both, and disagreeing."""
    a = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"))
    return A.reconcile(a, t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")), ["k"], "v", 1000)


@query("anti_both_ways", """SELECT 'supplier_only' AS side, count(*) AS n FROM (SELECT DISTINCT s_nationkey FROM supplier) s WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer)
  UNION ALL SELECT 'customer_only', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def anti_both_ways(t):
    """Keys of one side that the other lacks, both ways."""
    a = t.supplier.select("s_nationkey").distinct().join(t.customer.select("c_nationkey").distinct(), F.col("s_nationkey") == F.col("c_nationkey"), "left_anti")
    b = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
    return count(a, "supplier_only").unionByName(count(b, "customer_only"))


CHAIN_SQL = """chain AS (
  SELECT p_partkey AS contract, p_brand AS exchange, p_size AS dte_days, CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS option_type,
    1000.0::DOUBLE AS underlying, 850 + (p_partkey % 31) * 10.0::DOUBLE AS strike, p_retailprice / 1000 AS iv,
    p_retailprice - p_size AS bid, p_retailprice - 10 AS ask, (p_partkey % 120)::DOUBLE AS quote_age FROM part)"""


def chain(t):
    key = F.col("p_partkey")
    return t.part.select(
        key.alias("contract"), F.col("p_brand").alias("exchange"), F.col("p_size").alias("dte_days"),
        F.when(key % 2 == 0, "C").otherwise("P").alias("option_type"), F.lit(1000.0).alias("underlying"),
        (850 + (key % 31) * 10.0).alias("strike"), (F.col("p_retailprice") / 1000).alias("iv"),
        (F.col("p_retailprice") - F.col("p_size")).alias("bid"), (F.col("p_retailprice") - 10).alias("ask"),
        (key % 120).cast("double").alias("quote_age"),
    )


@query("option_surface", f"""WITH {CHAIN_SQL}, m AS (SELECT *, strike / underlying AS m, abs(ln(strike / underlying)) <= 0.05 AS atm FROM chain WHERE iv >= 0 AND dte_days > 0 AND strike > 0)
  SELECT exchange, median(iv) FILTER (atm) AS atm_iv, median(iv) FILTER (atm AND dte_days <= 7) AS short_dated_iv,
    median(iv) FILTER (option_type = 'P' AND m >= 0.85 AND m < 0.95) - median(iv) FILTER (option_type = 'C' AND m > 1.05 AND m <= 1.15) AS skew,
    median(iv) FILTER (atm AND dte_days > 30) - median(iv) FILTER (atm AND dte_days <= 7) AS term_structure,
    median(iv) FILTER (atm AND option_type = 'P') - median(iv) FILTER (atm AND option_type = 'C') AS put_call_iv_spread,
    count(DISTINCT contract) AS contract_count, count(*) FILTER (quote_age <= 60) AS fresh_quote_count, count(*) FILTER (quote_age > 60) AS stale_quote_count,
    max(quote_age) AS max_quote_age_seconds, avg((bid > 0 AND ask > 0 AND ask >= bid)::INT::DOUBLE) AS quote_coverage_ratio FROM m GROUP BY 1""",
       "atm_iv short_dated_iv skew term_structure put_call_iv_spread max_quote_age_seconds quote_coverage_ratio")
def option_surface(t):
    """Conditional medians over an option chain."""
    return O.surface(chain(t), ["exchange"])


@query("quote_coverage", f"""WITH {CHAIN_SQL} SELECT exchange, option_type, count(DISTINCT contract) AS contracts, count(*) FILTER (ask >= bid) AS quoted,
  avg((ask >= bid)::INT::DOUBLE) AS coverage, max(quote_age) AS max_age FROM chain GROUP BY 1, 2""", "coverage max_age")
def quote_coverage(t):
    """Distinct contracts, quoted share and greatest age."""
    return O.quote_coverage(chain(t), ["exchange", "option_type"], "contract", F.col("ask") >= F.col("bid"), F.col("quote_age"))


def raw_books(t):
    """A book per order: line items as levels; even line numbers bid below, odd ones ask above."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    level = F.struct(price.alias("price"), F.col("l_quantity").alias("amount"))
    side = F.col("l_linenumber") % 2 == 0
    return t.lineitem.groupBy(F.col("l_orderkey").alias("book"), F.lit("sim").alias("exchange")).agg(
        F.sort_array(F.collect_list(F.when(side, level)), False).alias("bids"),
        F.sort_array(F.collect_list(F.when(~side, level)), True).alias("asks"), F.min("l_shipdate").alias("ts"),
    )


BOOK_SQL = """lv AS (SELECT l_orderkey AS book, l_linenumber % 2 = 0 AS is_bid, l_extendedprice / l_quantity AS price, l_quantity AS amount, l_shipdate FROM lineitem),
top AS (SELECT book, max(price) FILTER (is_bid) AS bid, min(price) FILTER (NOT is_bid) AS ask, min(l_shipdate) AS ts,
        coalesce(sum(amount) FILTER (is_bid), 0) AS bid_size, coalesce(sum(amount) FILTER (NOT is_bid), 0) AS ask_size FROM lv GROUP BY 1)"""


@query("l2_book_validate", f"WITH {BOOK_SQL} SELECT book, coalesce(bid < ask, true) AS valid FROM top")
def l2_book_validate(t):
    """Books whose levels are sound, sorted and not crossed."""
    return raw_books(t).select("book", K.valid_book(F.col("bids"), F.col("asks")).alias("valid"))


@query("l2_depth_bps", f"""WITH {BOOK_SQL}, m AS (SELECT *, (bid + ask) / 2 AS mid FROM top)
  SELECT m.book, mid, ask - bid AS spread, bid_size, ask_size, CASE WHEN bid_size + ask_size > 0 THEN (bid_size - ask_size) / (bid_size + ask_size) END AS imbalance,
   CASE WHEN mid IS NOT NULL THEN coalesce(sum(amount) FILTER (is_bid AND price >= mid * (1 - 10 / 10000::DOUBLE)), 0) END AS bid_depth_10bps,
   CASE WHEN mid IS NOT NULL THEN coalesce(sum(amount) FILTER (NOT is_bid AND price <= mid * (1 + 10 / 10000::DOUBLE)), 0) END AS ask_depth_10bps,
   CASE WHEN mid IS NOT NULL THEN coalesce(sum(amount) FILTER (is_bid AND price >= mid * (1 - 50 / 10000::DOUBLE)), 0) END AS bid_depth_50bps,
   CASE WHEN mid IS NOT NULL THEN coalesce(sum(amount) FILTER (NOT is_bid AND price <= mid * (1 + 50 / 10000::DOUBLE)), 0) END AS ask_depth_50bps
  FROM m JOIN lv USING (book) GROUP BY m.book, mid, bid, ask, bid_size, ask_size""",
       "mid spread bid_size ask_size imbalance bid_depth_10bps ask_depth_10bps bid_depth_50bps ask_depth_50bps", places=9)
def l2_depth_bps(t):
    """Depth within bands of basis points around the mid."""
    return K.book_features(raw_books(t)).drop("bids", "asks", "ts", "exchange")


@query("l2_market_minute", f"""WITH {BOOK_SQL} SELECT date_trunc('day', ts)::TIMESTAMP AS day, median(ask - bid) AS median_spread, sum(bid_size) AS bid_depth, sum(ask_size) AS ask_depth,
  avg(CASE WHEN bid_size + ask_size > 0 THEN (bid_size - ask_size) / (bid_size + ask_size) END) AS mean_imbalance, count(*) AS contracts FROM top GROUP BY 1""",
       "median_spread bid_depth ask_depth mean_imbalance")
def l2_market_minute(t):
    """Contracts' books to one row per market and time bucket."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return K.market_minute(K.book_features(raw_books(t)).withColumn("day", day), ["day"])


@query("l2_quality_mask", f"WITH {BOOK_SQL} SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) FILTER (bid < ask) AS usable, count(*) FILTER (NOT coalesce(bid < ask, false)) AS rejected FROM top GROUP BY 1")
def l2_quality_mask(t):
    """The lenient mask: unusable books are counted and dropped (the strict one fails on them)."""
    books = K.book_features(raw_books(t)).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    all_, good = (df.groupBy("day").agg(F.count(F.lit(1)).alias(n)) for df, n in ((books, "n"), (K.quality_mask(books), "usable")))
    usable = F.coalesce("usable", F.lit(0)).cast("long")
    return all_.join(good, "day", "left").select("day", usable.alias("usable"), (F.col("n") - usable).alias("rejected"))


STATS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("descriptive_stats", " UNION ALL ".join(f"SELECT '{c}' AS variable, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max FROM lineitem" for c in STATS), "mean std min max")
def descriptive_stats(t):
    """Mean, deviation and range of each column, in one pass."""
    return A.descriptive_stats(t.lineitem, list(STATS))


@query("feature_profile", " UNION ALL ".join(f"SELECT '{c}' AS variable, count(*) FILTER ({x} IS NULL) AS null_count, count({x}) AS value_count, avg({x}) AS mean, stddev_samp({x}) AS std, var_samp({x}) AS variance, min({x})::DOUBLE AS min, max({x})::DOUBLE AS max, min(o_orderdate) FILTER ({x} IS NOT NULL) AS first_seen, max(o_orderdate) FILTER ({x} IS NOT NULL) AS last_seen FROM orders" for c, x in (("price", "o_totalprice"), ("large", "nullif(greatest(o_totalprice, 100000), 100000)"))), "mean std variance min max", places=3)
def feature_profile(t):
    """Nulls, moments and spans of features, in one pass."""
    df = t.orders.select("o_orderdate", F.col("o_totalprice").alias("price"), F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("large"))
    return A.feature_profile(df, ["price", "large"], "o_orderdate")


@query("missing_value_audit", f"WITH {GRID_SQL}, j AS (SELECT g.*, b.close_price, b.volume FROM grid g LEFT JOIN bars b USING (exchange, symbol, timestamp_m1)) SELECT 'close_price' AS variable, count(*) FILTER (close_price IS NULL) AS missing, count(*) AS total_rows FROM j UNION ALL SELECT 'volume', count(*) FILTER (volume IS NULL), count(*) FROM j")
def missing_value_audit(t):
    """Missing values of each column."""
    own = bars(t)
    joined = span_grid(own, KEYS, "timestamp_m1").join(own, [*KEYS, "timestamp_m1"], "left")
    return A.missing_values(joined, ["close_price", "volume"])


@query("time_span_coverage", f"WITH {BARS_SQL} SELECT symbol, min(timestamp_m1) AS first_seen, max(timestamp_m1) AS last_seen, count(*) AS observed, (epoch_us(max(timestamp_m1)) - epoch_us(min(timestamp_m1))) // 60000000 + 1 AS expected, (epoch_us(max(timestamp_m1)) - epoch_us(min(timestamp_m1))) // 60000000 + 1 - count(*) AS missing, count(*) / ((epoch_us(max(timestamp_m1)) - epoch_us(min(timestamp_m1))) // 60000000 + 1) AS coverage_ratio FROM bars GROUP BY 1", "coverage_ratio")
def time_span_coverage(t):
    """Expected against observed minutes."""
    return A.span_coverage(bars(t), ["symbol"], "timestamp_m1")


@query("source_availability", f"WITH {GRID_SQL}, {QUOTES_SQL}, q AS (SELECT DISTINCT symbol, date_trunc('minute', ts)::TIMESTAMP AS timestamp_m1 FROM quotes), e AS (SELECT max(timestamp_m1) AS grid_end, count(*) AS n FROM grid) SELECT 'perps' AS source, count(*) AS covered, count(*) / any_value(n) AS coverage_ratio, (epoch_us(any_value(grid_end)) - epoch_us(max(timestamp_m1))) // 60000000 AS minutes_behind FROM (SELECT * FROM grid SEMI JOIN bars USING (symbol, timestamp_m1)), e UNION ALL SELECT 'open_interest', count(*), count(*) / any_value(n), (epoch_us(any_value(grid_end)) - epoch_us(max(timestamp_m1))) // 60000000 FROM (SELECT * FROM grid SEMI JOIN q USING (symbol, timestamp_m1)), e", "coverage_ratio")
def source_availability(t):
    """What share of the grid each source covers, and how far it lags."""
    own = bars(t)
    q = t.quotes().select(*KEYS, X.minute(F.col("ts")).alias("timestamp_m1"))
    return A.source_availability(span_grid(own, KEYS, "timestamp_m1"), {"perps": own, "open_interest": q}, KEYS, "timestamp_m1")


@query("missing_days_inventory", "SELECT o_orderpriority, CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_day, CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_day, count(DISTINCT CAST(o_orderdate AS DATE)) AS observed_days, date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 AS expected_days, date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 - count(DISTINCT CAST(o_orderdate AS DATE)) AS missing_days FROM orders GROUP BY 1")
def missing_days_inventory(t):
    """Days of each series: observed, expected, missing."""
    return A.day_inventory(t.orders, ["o_orderpriority"], "o_orderdate").withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query("sorted_distinct_list", "SELECT o_orderstatus, list_sort(list(DISTINCT o_orderpriority))::VARCHAR AS priorities FROM orders GROUP BY 1")
def sorted_distinct_list(t):
    """The sorted distinct values of a group; values are a small fixed set."""
    names = F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ", ")
    return t.orders.groupBy("o_orderstatus").agg(F.concat(F.lit("["), names, F.lit("]")).alias("priorities"))


@query("even_sample", "WITH n AS (SELECT l_returnflag, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey * 10 + l_linenumber) - 1 AS n, count(*) OVER (PARTITION BY l_returnflag) AS c FROM lineitem) SELECT l_returnflag, l_orderkey, l_linenumber FROM n WHERE n % greatest(1, ceil(c / 3000)::BIGINT) = 0")
def even_sample(t):
    """A sampling operator: rows at even steps, at most 3000 of a key."""
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return A.even_sample(rows, ["l_returnflag"], "at", 3000).drop("at")
