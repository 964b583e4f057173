"""Features over trailing windows, resampling, labels."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.functions import windows as W
from tidemark.operators import features as T
from tidemark.operators.resample import resample
from tidemark.plans.registry import query
from tidemark.queries.joins import CHAIN_SQL, chain
from tidemark.queries.trades import FULL_SQL, whole_bars
from tidemark.sources.tables import PERP_SQL, QUOTES_SQL, SERIES_SQL, SPOT_SQL

K = ["exchange", "symbol"]
RET_SQL = SERIES_SQL + """, ret AS (
  SELECT *, CASE WHEN price > 0 AND lag(price) OVER w > 0 THEN ln(price / lag(price) OVER w) END AS r
  FROM series WINDOW w AS (PARTITION BY symbol ORDER BY ts))"""


def frame(seconds: int, closed: bool = False) -> str:
    low = f"INTERVAL '{seconds} seconds'" if closed else f"INTERVAL '{seconds - 1}.999999 seconds'"
    return f"(PARTITION BY symbol ORDER BY ts RANGE BETWEEN {low} PRECEDING AND CURRENT ROW)"


def returns(t):
    return T.return_to_last_known(t.minute_series(), K, "ts", "price", "r")


@query("log_returns", f"WITH {SERIES_SQL} SELECT symbol, ts, " + ", ".join(f"CASE WHEN price > 0 AND lag(price, {n}) OVER w > 0 THEN ln(price / lag(price, {n}) OVER w) END AS log_return_{n}" for n in (1, 5, 15)) + " FROM series WINDOW w AS (PARTITION BY symbol ORDER BY ts)", "log_return_1 log_return_5 log_return_15")
def log_returns(t):
    """Guarded log returns over 1, 5 and 15 rows."""
    return T.log_returns(t.minute_series(), K, "ts", "price", (1, 5, 15)).drop("exchange", "price", "volume")


@query("log_return_last_known", f"WITH {SERIES_SQL}, g AS (SELECT symbol, ts, CASE WHEN volume > 50 THEN price END AS p FROM series) SELECT symbol, ts, CASE WHEN p > 0 AND last_value(p IGNORE NULLS) OVER w > 0 THEN ln(p / last_value(p IGNORE NULLS) OVER w) END AS r FROM g WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", "r")
def log_return_last_known(t):
    """Log return against the last known price, over rows without one."""
    gappy = t.minute_series().select("symbol", "ts", F.when(F.col("volume") > 50, F.col("price")).alias("p"))
    return T.return_to_last_known(gappy, ["symbol"], "ts", "p", "r").drop("p")


RV_SPANS = T.RV_WINDOWS | {"30d": 30 * T.DAY}
RV_SQL = RET_SQL + ", rv AS (SELECT symbol, ts, " + ", ".join(f"CASE WHEN r IS NOT NULL THEN sqrt(sum(r * r) OVER {frame(s)}) END AS rv_{n}" for n, s in RV_SPANS.items()) + " FROM ret)"


@query("realized_vol", f"WITH {RV_SQL} SELECT * FROM rv", " ".join(f"rv_{n}" for n in RV_SPANS))
def realized_vol(t):
    """Realised volatility over trailing windows from 5 minutes to 30 days."""
    return T.realized_volatility(returns(t), K, "ts", "r", RV_SPANS).drop("exchange", "price", "volume", "r")


@query("realized_vol_annualized", f"WITH {RV_SQL} SELECT symbol, ts, " + ", ".join(f"rv_{n} * {math.sqrt(525600 / (s / 60))!r} * 100 AS rv_{n}_annualized_pct" for n, s in T.RV_WINDOWS.items()) + " FROM rv", " ".join(f"rv_{n}_annualized_pct" for n in T.RV_WINDOWS), places=4)
def realized_vol_annualized(t):
    """Realised volatility in per cent a year."""
    out = T.annualized(T.realized_volatility(returns(t), K, "ts", "r"))
    return out.select("symbol", "ts", *[f"rv_{n}_annualized_pct" for n in T.RV_WINDOWS])


@query("parkinson_vol", f"WITH {FULL_SQL} SELECT symbol, timestamp_m1 AS ts, sqrt(sum(ln(high_price / low_price) ** 2) OVER (PARTITION BY symbol ORDER BY timestamp_m1 RANGE BETWEEN INTERVAL '3599.999999 seconds' PRECEDING AND CURRENT ROW) / (4 * ln(2))) AS parkinson_rv FROM filled", "parkinson_rv")
def parkinson_vol(t):
    """Range volatility over an hour of minute bars."""
    b = whole_bars(t).withColumnRenamed("timestamp_m1", "ts")
    return T.parkinson(b, K, "ts", "high_price", "low_price").select("symbol", "ts", "parkinson_rv")


def z_sql(x: str, seconds: int, name: str) -> str:
    return f"CASE WHEN stddev_samp({x}) OVER {frame(seconds)} > 1e-12 THEN ({x} - avg({x}) OVER {frame(seconds)}) / stddev_samp({x}) OVER {frame(seconds)} END AS {name}"


@query("rolling_zscore", f"WITH {SERIES_SQL} SELECT symbol, ts, {z_sql('price', 86400, 'z_1d')}, {z_sql('price', 7 * 86400, 'z_7d')} FROM series", "z_1d z_7d")
def rolling_zscore(t):
    """Z-scores over a day and a week."""
    return T.rolling_zscore(t.minute_series(), K, "ts", "price", {"1d": 86400, "7d": 7 * 86400}, "z_").select("symbol", "ts", "z_1d", "z_7d")


@query("jump_proxy", f"WITH {RET_SQL} SELECT symbol, ts, abs(z) AS jump_proxy FROM (SELECT symbol, ts, {z_sql('r', 86400, 'z')} FROM ret)", "jump_proxy")
def jump_proxy(t):
    """The size of a return in deviations of its day."""
    return T.rolling_zscore(returns(t), K, "ts", "r", 86400, "z").select("symbol", "ts", F.abs("z").alias("jump_proxy"))


@query("rolling_percentile", f"WITH {QUOTES_SQL}, d AS (SELECT symbol, ts, arg_max(value, event_id) AS value FROM quotes GROUP BY 1, 2) SELECT a.symbol, a.ts, count(*) FILTER (b.value <= a.value) / count(*) AS percentile FROM d a JOIN d b ON a.symbol = b.symbol AND b.ts BETWEEN a.ts - INTERVAL 30 DAY AND a.ts GROUP BY 1, 2", "percentile")
def rolling_percentile(t):
    """Percentile rank within the closed last 30 days."""
    q = t.quotes().groupBy("symbol", "ts").agg(F.max_by("value", "event_id").alias("value"))
    return T.rolling_percentile(q, ["symbol"], "ts", "value", 30 * 86400, "percentile").drop("value")


@query("row_window_features", f"WITH {RET_SQL} SELECT symbol, ts, " + ", ".join(f"CASE WHEN count(price) OVER w{n} >= 2 AND stddev_samp(price) OVER w{n} > 1e-12 THEN (price - avg(price) OVER w{n}) / stddev_samp(price) OVER w{n} END AS zscore_{n}, CASE WHEN count(r) OVER w{n} >= 2 THEN sqrt(sum(r * r) OVER w{n}) END AS rv_{n}" for n in (15, 60)) + " FROM ret WINDOW " + ", ".join(f"w{n} AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (15, 60)), "zscore_15 rv_15 zscore_60 rv_60")
def row_window_features(t):
    """Z-scores and volatility over 15 and 60 rows."""
    return T.row_window_features(returns(t), K, "ts", "price", "r").select("symbol", "ts", "zscore_15", "rv_15", "zscore_60", "rv_60")


@query("ema", f"WITH {SERIES_SQL} SELECT symbol, ts, list_reduce(list(price) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 39 PRECEDING AND CURRENT ROW), lambda a, y: a + 0.5::DOUBLE * (y - a)) AS ema_3, list_reduce(list(price) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 137 PRECEDING AND CURRENT ROW), lambda a, y: a + (2 / 11::DOUBLE) * (y - a)) AS ema_10 FROM series", "ema_3 ema_10", places=12)
def ema(t):
    """Exponential means of spans 3 and 10."""
    return T.ema(t.minute_series(), K, "ts", "price").select("symbol", "ts", "ema_3", "ema_10")


@query("ema_slope", f"WITH {SERIES_SQL}, e AS (SELECT symbol, ts, list_reduce(list(price) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 39 PRECEDING AND CURRENT ROW), lambda a, y: a + 0.5::DOUBLE * (y - a)) AS e FROM series) SELECT symbol, ts, e / lag(e) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS slope FROM e", "slope")
def ema_slope(t):
    """Relative change of the exponential mean."""
    e = T.ema(t.minute_series(), K, "ts", "price", (3,))
    out = W.over_rows(e, K, "ts", lambda w: {"slope": X.ratio(F.col("ema_3"), F.lag("ema_3").over(w)) - 1}, back=1)
    return out.select("symbol", "ts", "slope")


def momentum_sql(expr: str, name: str) -> str:
    """``expr`` uses {w} for the window."""
    parts = ", ".join(expr.format(w=frame(s), n=n) + f" AS {name}_{n}" for n, s in (("5m", 300), ("15m", 900)))
    return f"WITH {RET_SQL} SELECT symbol, ts, {parts} FROM ret"


def momentum(t, name):
    return T.momentum(t.minute_series(), K, "ts", "price", "volume").select("symbol", "ts", f"{name}_5m", f"{name}_15m")


MEAN = "CASE WHEN count(price) OVER {w} >= 2 THEN avg(price) OVER {w} END"
STD = "CASE WHEN stddev_samp(price) OVER {w} > 1e-12 THEN stddev_samp(price) OVER {w} END"
VWAP = "(sum(price * volume) OVER {w} / nullif(sum(volume) OVER {w}, 0))"
for _name, _expr in {
    "breakout_distance": "CASE WHEN count(price) OVER {w} >= 2 THEN price / max(price) OVER {w} - 1 END",
    "vwap_distance": f"(price - {VWAP}) / {VWAP}",
    "bollinger_distance": f"(price - {MEAN}) / (2 * {STD})",
    "price_zscore": f"(price - {MEAN}) / ({STD})",
    "turnover_notional": "sum(price * volume) OVER {w}",
    "trend_persistence": "CASE WHEN count(*) OVER {w} >= 2 THEN avg(CASE WHEN r > 0 THEN 1.0::DOUBLE WHEN r < 0 THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER {w} END",
}.items():
    query(_name, momentum_sql(_expr, _name), f"{_name}_5m {_name}_15m")(lambda t, n=_name: momentum(t, n))


@query("half_life", f"WITH {SERIES_SQL}, m AS (SELECT symbol, ts, price - CASE WHEN count(price) OVER {frame(300)} >= 2 THEN avg(price) OVER {frame(300)} END AS d FROM series), l AS (SELECT *, lag(d) OVER (PARTITION BY symbol ORDER BY ts) AS d1 FROM m), p AS (SELECT symbol, ts, CASE WHEN count(d * d1) OVER {frame(300)} >= 3 THEN sum(d * d1) OVER {frame(300)} END / nullif(CASE WHEN count(d1 * d1) FILTER (d IS NOT NULL) OVER {frame(300)} >= 3 THEN sum(d1 * d1) FILTER (d IS NOT NULL) OVER {frame(300)} END, 0) AS phi FROM l) SELECT symbol, ts, CASE WHEN phi > 0 AND phi < 1 THEN ln(2) / -ln(phi) END AS half_life FROM p", "half_life", places=4)
def half_life(t):
    """Half-life of mean reversion from a rolling AR(1)."""
    return T.half_life(t.minute_series(), K, "ts", "price").select("symbol", "ts", "half_life")


@query("oi_delta", f"WITH {QUOTES_SQL}, d AS (SELECT symbol, ts, arg_max(value, event_id) AS v FROM quotes GROUP BY 1, 2) SELECT symbol, ts, v - lag(v) OVER w AS oi_delta, (v - lag(v) OVER w) / nullif(lag(v) OVER w, 0) AS oi_change_pct FROM d WINDOW w AS (PARTITION BY symbol ORDER BY ts)", "oi_delta oi_change_pct")
def oi_delta(t):
    """Change of open interest, absolute and relative."""
    q = t.quotes().groupBy("symbol", "ts").agg(F.max_by("value", "event_id").alias("v"))
    return T.oi_delta(q, ["symbol"], "ts", "v").drop("v")


@query("flow_signals", f"WITH {FULL_SQL}, f AS (SELECT symbol, timestamp_m1 AS ts, buy_volume, sell_volume, quote_volume, volume AS oi, CASE WHEN close_price > 0 AND lag(close_price) OVER w > 0 THEN ln(close_price / lag(close_price) OVER w) END AS r, volume > lag(volume) OVER w AS up FROM filled WINDOW w AS (PARTITION BY symbol ORDER BY timestamp_m1)) SELECT symbol, ts, (buy_volume - sell_volume) / nullif(buy_volume + sell_volume, 0) AS trade_imbalance, abs(r) / nullif(quote_volume, 0) AS price_impact, (r > 0 AND up)::INT AS leverage_build_up, (r < 0 AND up)::INT AS short_stress FROM f", "trade_imbalance price_impact")
def flow_signals(t):
    """Composite signals of returns, open interest and flow."""
    b = whole_bars(t).withColumnRenamed("timestamp_m1", "ts").withColumn("oi", F.col("volume"))
    b = T.log_returns(b, K, "ts", "close_price", step=60).withColumnRenamed("log_return_1", "r")
    return T.flow_signals(b, K, "ts", step=60).select("symbol", "ts", "trade_imbalance", "price_impact", "leverage_build_up", "short_stress")


TARGET_SQL = FULL_SQL + f""", base AS (SELECT symbol, timestamp_m1 AS ts, close_price AS p, volume AS spread, buy_volume_share AS z, 0.0001::DOUBLE AS funding,
  CASE WHEN close_price > 0 AND lag(close_price) OVER (PARTITION BY symbol ORDER BY timestamp_m1) > 0 THEN ln(close_price / lag(close_price) OVER (PARTITION BY symbol ORDER BY timestamp_m1)) END AS r FROM filled),
rvs AS (SELECT *, CASE WHEN r IS NOT NULL THEN sqrt(sum(r * r) OVER {frame(3600)}) END AS rv FROM base)"""
_H = T.HORIZONS


def target_columns(n: str, h: int) -> str:
    there = f"lead(1, {h}) OVER w IS NOT NULL"
    fwd = f"CASE WHEN p > 0 AND lead(p, {h}) OVER w > 0 THEN ln(lead(p, {h}) OVER w / p) END"
    return (
        f"CASE WHEN {there} THEN {fwd} END AS target_forward_return_{n}, "
        f"CASE WHEN {there} AND p > 0 THEN min(p) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) / p - 1 END AS target_forward_drawdown_{n}, "
        f"CASE WHEN {there} THEN {fwd} - 0.0002::DOUBLE - abs(coalesce(funding, 0)) * {h} / 480 END AS target_cost_adjusted_return_{n}, "
        f"CASE WHEN {there} THEN lead(rv, {h}) OVER w END AS target_future_rv_{n}, CASE WHEN {there} THEN lead(spread, {h}) OVER w - spread END AS target_future_iv_spread_change_{n}, "
        f"CASE WHEN {there} THEN abs(lead(z, {h}) OVER w - z) >= 1.0 END AS label_regime_shift_{n}"
    )


@query("forward_targets", f"WITH {TARGET_SQL} SELECT symbol, ts, " + ", ".join(target_columns(n, h) for n, h in _H.items()) + " FROM rvs WINDOW w AS (PARTITION BY symbol ORDER BY ts)", " ".join(f"target_{x}_{n}" for n in _H for x in ("forward_return", "forward_drawdown", "cost_adjusted_return", "future_rv", "future_iv_spread_change")))
def forward_targets(t):
    """Forward-looking labels at an hour, four hours and a day of rows on a dense grid."""
    b = whole_bars(t).select(*K, F.col("timestamp_m1").alias("ts"), F.col("close_price").alias("p"), F.col("volume").alias("spread"),
                             F.col("buy_volume_share").alias("z"), F.lit(0.0001).alias("funding"))
    b = T.log_returns(b, K, "ts", "p", step=60).withColumnRenamed("log_return_1", "r")
    b = T.realized_volatility(b, K, "ts", "r", {"1h": 3600})
    return T.forward_targets(b, K, "ts", "p", "rv_1h", step=60).drop("exchange", "p", "spread", "z", "funding", "r", "rv_1h")


def resampled_sql(seconds: int) -> str:
    return FULL_SQL + f""" SELECT symbol, time_bucket(INTERVAL '{seconds} seconds', timestamp_m1)::TIMESTAMP AS ts,
      arg_min(open_price, timestamp_m1) FILTER (open_price IS NOT NULL) AS perp_open_price, max(high_price) AS perp_high_price, min(low_price) AS perp_low_price,
      arg_max(close_price, timestamp_m1) FILTER (close_price IS NOT NULL) AS perp_close_price, sum(volume) AS perps_trades_volume, sum(buy_volume) AS perps_trades_buy_volume,
      sum(trade_count)::BIGINT AS perp_trade_count, bool_or(trade_count > 0) AS open_interest_is_observed,
      CASE WHEN sum(volume) > 0 THEN sum(buy_volume) / sum(volume) END AS perps_trades_buy_volume_share, arg_max(quote_volume, timestamp_m1) AS last_notional FROM filled GROUP BY 1, 2"""


def resampled(t, seconds):
    b = whole_bars(t).select(
        "symbol", F.col("timestamp_m1").alias("ts"), F.col("open_price").alias("perp_open_price"), F.col("high_price").alias("perp_high_price"),
        F.col("low_price").alias("perp_low_price"), F.col("close_price").alias("perp_close_price"), F.col("volume").alias("perps_trades_volume"),
        F.col("buy_volume").alias("perps_trades_buy_volume"), F.col("trade_count").alias("perp_trade_count"),
        (F.col("trade_count") > 0).alias("open_interest_is_observed"), F.col("buy_volume_share").alias("perps_trades_buy_volume_share"),
        F.col("quote_volume").alias("last_notional"),
    )
    return resample(b, ["symbol"], "ts", seconds)


for _name, _seconds in (("resample_5m", 300), ("resample_30m", 1800), ("resample_1h", 3600)):
    query(_name, f"WITH {resampled_sql(_seconds)}", "perp_open_price perp_high_price perp_low_price perp_close_price perps_trades_volume perps_trades_buy_volume perps_trades_buy_volume_share last_notional")(
        lambda t, s=_seconds: resampled(t, s))


@query("spot_perp_basis", f"WITH {SPOT_SQL}, {PERP_SQL}, b AS (SELECT coalesce(s.day, p.day) AS ts, 1 AS symbol, p.close / nullif(s.close, 0) - 1 AS basis FROM spot s FULL JOIN perp p ON s.day = p.day) SELECT ts, basis, basis - lag(basis) OVER (ORDER BY ts) AS basis_change, {z_sql('basis', 30 * 86400, 'basis_z')} FROM b", "basis basis_change basis_z")
def spot_perp_basis(t):
    """Basis between two sources, its change and its z-score over 30 days."""
    s, p = t.daily("orders"), t.daily("lineitem")
    b = s.select(F.col("day").alias("ts"), F.col("close").alias("s")).join(p.select(F.col("day").alias("ts"), F.col("close").alias("p")), "ts", "full_outer")
    b = b.select("ts", (X.ratio(F.col("p"), F.col("s")) - 1).alias("basis"))
    b = W.over_rows(b, [], "ts", lambda w: {"basis_change": F.col("basis") - F.lag("basis").over(w)}, back=1)
    return T.rolling_zscore(b, [], "ts", "basis", 30 * 86400, "basis_z")


@query("iv_rv_spread", f"WITH {RV_SQL}, {QUOTES_SQL}, q AS (SELECT symbol, date_trunc('minute', ts)::TIMESTAMP AS ts, arg_max(value, (ts, event_id)) / 1000 AS iv FROM quotes GROUP BY 1, 2) SELECT coalesce(q.symbol, v.symbol) AS symbol, coalesce(q.ts, v.ts) AS ts, iv - rv_1h AS iv_minus_rv_1h, CASE WHEN rv_1d > 0 THEN iv / rv_1d END AS iv_rv_ratio_1d, iv IS NOT NULL AS iv_available, rv_1h IS NOT NULL OR rv_1d IS NOT NULL AS rv_available FROM q FULL JOIN rv v ON q.symbol = v.symbol AND q.ts = v.ts", "iv_minus_rv_1h iv_rv_ratio_1d")
def iv_rv_spread(t):
    """Implied against realised volatility, with availability flags."""
    rv = T.realized_volatility(returns(t), K, "ts", "r", {"1h": 3600, "1d": 86400}).select("symbol", "ts", "rv_1h", "rv_1d")
    q = t.quotes().groupBy("symbol", X.minute(F.col("ts")).alias("m")).agg((F.max_by("value", F.struct("ts", "event_id")) / 1000).alias("iv")).withColumnRenamed("m", "ts")
    j = q.join(rv, ["symbol", "ts"], "full_outer")
    return j.select("symbol", "ts", (F.col("iv") - F.col("rv_1h")).alias("iv_minus_rv_1h"), F.when(F.col("rv_1d") > 0, F.col("iv") / F.col("rv_1d")).alias("iv_rv_ratio_1d"),
                    F.col("iv").isNotNull().alias("iv_available"), (F.col("rv_1h").isNotNull() | F.col("rv_1d").isNotNull()).alias("rv_available"))


@query("live_extended_zscores", f"WITH {FULL_SQL}, b AS (SELECT symbol, timestamp_m1 AS ts, high_price, low_price, close_price, buy_volume / nullif(volume, 0) AS fill, (high_price - low_price) / nullif(close_price, 0) AS rng FROM filled) SELECT symbol, ts, rng, fill, {z_sql('close_price', 900, 'mark_z_15m')}, avg(close_price) FILTER (close_price IS NOT NULL) OVER {frame(900)} AS mark_mean_15m FROM b", "rng fill mark_z_15m mark_mean_15m", places=5)
def live_extended_zscores(t):
    """Ratios and 15-minute z-scores of live series."""
    b = whole_bars(t).withColumnRenamed("timestamp_m1", "ts")
    b = b.withColumns({"rng": X.ratio(F.col("high_price") - F.col("low_price"), F.col("close_price")), "fill": X.ratio(F.col("buy_volume"), F.col("volume"))})
    b = W.rolling(b, K, "ts", {"__p": F.col("close_price")}, {"15m": 900})
    return b.select("symbol", "ts", "rng", "fill", W.zscore(F.col("close_price"), "__p_15m").alias("mark_z_15m"), F.col("__p_15m.mean").alias("mark_mean_15m"))


@query("option_quote_ratios", f"WITH {CHAIN_SQL} SELECT exchange, count(*) FILTER (quote_age <= 60) / count(*) AS quote_fill, count(*) FILTER (quote_age > 60) / count(*) AS stale_ratio, 1 - avg((ask >= bid)::INT::DOUBLE) AS coverage_gap FROM chain GROUP BY 1", "quote_fill stale_ratio coverage_gap")
def option_quote_ratios(t):
    """Fill, staleness and coverage ratios of option quotes."""
    age = F.col("quote_age")
    return chain(t).groupBy("exchange").agg(
        (F.count_if(age <= 60) / F.count(F.lit(1))).alias("quote_fill"), (F.count_if(age > 60) / F.count(F.lit(1))).alias("stale_ratio"),
        (1 - F.avg((F.col("ask") >= F.col("bid")).cast("double"))).alias("coverage_gap"))
