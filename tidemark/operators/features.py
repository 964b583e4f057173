"""Features of series: returns, volatility, momentum, reversion, flow; and forward-looking labels.

Windows in time are sliced and windows in rows are cut in blocks (see
``functions.windows``): no task gets a whole series.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.exprs import log_ratio, ratio
from tidemark.functions.windows import blocks, last_known, max2, over_rows, percentile_rank, rolling, trailing, whole, zscore

MINUTE, HOUR, DAY = 60, 3600, 86_400
RV_WINDOWS = {"5m": 5 * MINUTE, "15m": 15 * MINUTE, "1h": HOUR, "4h": 4 * HOUR, "1d": DAY}
MINUTES_PER_YEAR = 525_600


def log_returns(df: DataFrame, keys: list[str], ts: str, price: str, steps=(1,), step: int | None = None) -> DataFrame:
    """Log returns over counts of rows; ``step``: seconds between rows without gaps."""
    p = F.col(price)
    return over_rows(df, keys, ts, lambda w: {f"log_return_{n}": log_ratio(p, F.lag(p, n).over(w)) for n in steps}, back=max(steps), step=step)


def return_to_last_known(df: DataFrame, keys: list[str], ts: str, price: str, name: str) -> DataFrame:
    """Log return against the last known price before the row, over rows without one."""
    known = last_known(df, keys, ts, [], F.col(price), "__before", inclusive=False)
    return known.withColumn(name, log_ratio(F.col(price), F.col("__before"))).drop("__before")


def realized(r: Column, window: str) -> Column:
    """Root of the sum of squared returns of a window of ``rolling``; null where the current return is."""
    return F.when(r.isNotNull(), F.sqrt(F.greatest(F.col(f"{window}.total"), F.lit(0.0))))


def realized_volatility(df: DataFrame, keys: list[str], ts: str, r: str, windows=RV_WINDOWS, prefix: str = "") -> DataFrame:
    out = rolling(df, keys, ts, {"__r2": F.col(r) * F.col(r)}, windows, moments=False)
    return out.withColumns({f"{prefix}rv_{n}": realized(F.col(r), f"__r2_{n}") for n in windows}).drop(*[f"__r2_{n}" for n in windows])


def annualized(df: DataFrame, windows=RV_WINDOWS) -> DataFrame:
    return df.withColumns({
        f"rv_{n}_annualized_pct": F.col(f"rv_{n}") * math.sqrt(MINUTES_PER_YEAR / (s / 60)) * 100 for n, s in windows.items()
    })


def parkinson(df: DataFrame, keys: list[str], ts: str, high: str, low: str, seconds: int = HOUR) -> DataFrame:
    """Range volatility: root of the sum of ln(high/low)^2 / (4 ln 2)."""
    x = log_ratio(F.col(high), F.col(low))
    out = rolling(df, keys, ts, {"__range": x * x}, {"w": seconds}, moments=False)
    return out.withColumn("parkinson_rv", F.sqrt(F.greatest(F.col("__range_w.total"), F.lit(0.0)) / (4 * math.log(2)))).drop("__range_w")


def rolling_zscore(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int | dict[str, int], name: str) -> DataFrame:
    """Z-scores over trailing windows; several (``seconds`` by suffix of ``name``) share one exchange."""
    spans = seconds if isinstance(seconds, dict) else {"": seconds}
    out = rolling(df, keys, ts, {"__z": F.col(value)}, spans)
    return out.withColumns({name + n: zscore(F.col(value), f"__z_{n}") for n in spans}).drop(*[f"__z_{n}" for n in spans])


def rolling_percentile(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, name: str) -> DataFrame:
    """Share of the values in the closed window [t - seconds, t] that are at most the current one."""
    return percentile_rank(df, keys, ts, value, seconds, name)


def row_window_features(df: DataFrame, keys: list[str], ts: str, value: str, r: str, rows=(15, 60)) -> DataFrame:
    """Z-scores and volatility over counts of rows, at least two of them with values."""
    x, y = F.col(value), F.col(r)

    def make(series):
        out = {}
        for n in rows:
            w = series.rowsBetween(-(n - 1), 0)
            enough, std = F.count(x).over(w) >= 2, F.stddev_samp(x).over(w)
            out[f"zscore_{n}"] = F.when(enough & (std > 0), (x - F.avg(x).over(w)) / std)
            out[f"rv_{n}"] = F.when(F.count(y).over(w) >= 2, F.sqrt(F.sum(y * y).over(w)))
        return out

    return over_rows(df, keys, ts, make, back=max(rows))


def ema(df: DataFrame, keys: list[str], ts: str, value: str, spans=(3, 10)) -> DataFrame:
    """Exponential means without adjustment.  Weights fade with rows, those without a value included.

    The mean so far has weight (1 - a)^gap beside a for a new value, so y' = (1 - g) y + g x with g = a / ((1 - a)^gap + a).  With
    p the running sum of ln(1 - g), y is e^p times the running sum of g x e^-p: two running sums over the rows whose weight
    is above 1e-12 (and as many again, as gaps let weights fade less), not a fold over the series.  Where no value is
    missing, the few rows are folded as the recursion says, to its last digit.
    """
    x = F.col(value).cast("double")
    alpha = {span: 2 / (span + 1) for span in spans}
    reach = max(math.ceil(math.log(1e-12) / math.log(1 - a)) * 2 for a in alpha.values())
    # Short blocks, for e^-p grows along one.
    rows, w = blocks(df, keys, ts, back=reach, long=256)
    before, so_far = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__gap", F.col("__n") - F.last(F.when(x.isNotNull(), F.col("__n")), True).over(before))
    old = {span: F.when(F.col("__gap") == 1, 1 - a).otherwise(F.pow(F.lit(1 - a), F.col("__gap"))) for span, a in alpha.items()}
    share = {span: F.when(x.isNotNull(), F.coalesce(a / (old[span] + a), F.lit(1.0))) for span, a in alpha.items()}  # of the new value; the first has all
    rows = rows.withColumn("__steps", F.sum(F.when(x.isNotNull() & (F.col("__gap") == 1), 1).otherwise(0)).over(so_far))
    rows = rows.withColumns({f"__p_{s}": F.sum(F.when(x.isNotNull() & (F.col("__gap") > 1), F.ln(1 - share[s])).otherwise(0.0)).over(so_far) for s in spans})
    # Steps of one row, nearly all, go by a power, which loses no digits; e^p is for the others.
    faded = {s: F.pow(F.lit(1 - alpha[s]), F.col("__steps")) * F.exp(f"__p_{s}") for s in spans}
    rows = rows.withColumns({f"__s_{s}": F.sum(share[s] * x / faded[s]).over(so_far) for s in spans})
    near = {s: w.rowsBetween(-(math.ceil(math.log(1e-12) / math.log(1 - a)) - 1), 0) for s, a in alpha.items()}
    full = {s: F.count(x).over(near[s]) == F.count(F.lit(1)).over(near[s]) for s in spans}
    held = {s: F.collect_list(x).over(near[s]) for s in spans}
    fold = {s: F.aggregate(held[s], F.get(held[s], 0), _step(a)) for s, a in alpha.items()}
    rows = rows.withColumns({f"ema_{s}": F.when(x.isNotNull(), F.when(full[s], fold[s]).otherwise(faded[s] * F.col(f"__s_{s}"))) for s in spans})
    return whole(rows).drop("__gap", "__steps", *[f"__{y}_{s}" for y in "ps" for s in spans])


def _step(a: float):
    def step(mean, value):
        return mean + a * (value - mean)

    return step


def momentum(df: DataFrame, keys: list[str], ts: str, p: str, v: str) -> DataFrame:
    """Breakout, VWAP, Bollinger and z-score distances, turnover, persistence of direction (5 and 15 minutes)."""
    price, volume = F.col(p), F.col(v)
    spans = {"5m": 5 * MINUTE, "15m": 15 * MINUTE}
    df = over_rows(df, keys, ts, lambda w: {"__r": log_ratio(price, F.lag(price).over(w))}, back=1)
    sign = F.when(F.col("__r") > 0, 1.0).when(F.col("__r") < 0, -1.0).otherwise(0.0)
    df = rolling(df, keys, ts, {"__p": price, "__pv": price * volume, "__v": volume, "__s": sign}, spans)
    for name, seconds in spans.items():
        df = trailing(df, keys, ts, seconds, {"__max": max2(price)})
        enough = F.col(f"__p_{name}.n") >= 2
        mean, std = F.when(enough, F.col(f"__p_{name}.mean")), F.col(f"__p_{name}.std")
        turnover = F.col(f"__pv_{name}.total")
        vwap = ratio(turnover, F.col(f"__v_{name}.total"))
        df = df.withColumns({
            f"trend_persistence_{name}": F.when(F.col(f"__s_{name}.n") >= 2, F.col(f"__s_{name}.mean")),
            f"breakout_distance_{name}": ratio(price, F.col("__max")) - 1,
            f"price_zscore_{name}": ratio(price - mean, std),
            f"bollinger_distance_{name}": ratio(price - mean, 2 * std),
            f"vwap_distance_{name}": ratio(price - vwap, vwap),
            f"turnover_notional_{name}": turnover,
        }).drop("__max")
    return df.drop("__r", *[f"{x}_{n}" for x in ("__p", "__pv", "__v", "__s") for n in spans])


def half_life(df: DataFrame, keys: list[str], ts: str, p: str, seconds: int = 5 * MINUTE) -> DataFrame:
    """ln 2 / -ln phi of an AR(1) on the distance from the rolling mean, if 0 < phi < 1 and three products exist."""
    price, span = F.col(p), {"w": seconds}
    df = rolling(df, keys, ts, {"__p": price}, span)
    df = df.withColumn("__d", price - F.when(F.col("__p_w.n") >= 2, F.col("__p_w.mean")))
    df = over_rows(df, keys, ts, lambda w: {"__d1": F.lag("__d").over(w)}, back=1)
    df = rolling(df, keys, ts, {
        "__num": F.col("__d") * F.col("__d1"), "__den": F.when(F.col("__d").isNotNull(), F.col("__d1") * F.col("__d1"))}, span, moments=False)
    enough = lambda x: F.when(F.col(f"{x}.n") >= 3, F.col(f"{x}.total"))
    phi = ratio(enough("__num_w"), enough("__den_w"))
    return df.withColumn("half_life", F.when((phi > 0) & (phi < 1), math.log(2) / -F.ln(phi))).drop("__p_w", "__d", "__d1", "__num_w", "__den_w")


def oi_delta(df: DataFrame, keys: list[str], ts: str, oi: str, step: int | None = None) -> DataFrame:
    now = F.col(oi)

    def make(w):
        before = F.lag(oi).over(w)
        return {"oi_delta": now - before, "oi_change_pct": ratio(now - before, before)}

    return over_rows(df, keys, ts, make, back=1, step=step)


def flow_signals(df: DataFrame, keys: list[str], ts: str, step: int | None = None) -> DataFrame:
    """Imbalance, price impact, leverage build-up, short stress from r, oi, buy_volume, sell_volume, quote_volume."""
    r, oi, up = F.col("r"), F.col("oi"), F.col("__up")
    b, s = F.col("buy_volume"), F.col("sell_volume")
    return over_rows(df, keys, ts, lambda w: {"__up": oi > F.lag(oi).over(w)}, back=1, step=step).withColumns({
        "trade_imbalance": ratio(b - s, b + s), "price_impact": ratio(F.abs(r), F.col("quote_volume")),
        "leverage_build_up": ((r > 0) & up).cast("int"), "short_stress": ((r < 0) & up).cast("int"),
    }).drop("__up")


def _least_ahead(df: DataFrame, w: WindowSpec, value: str, horizons: dict[str, int]) -> DataFrame:
    """The least value of the next h rows (fewer at the end) of each horizon, by doubling spans: log h steps instead of h a row."""
    span, reach = 1, {}
    df, reach[1] = df.withColumn("__least_1", F.lead(value).over(w)), "__least_1"
    while span * 2 <= max(horizons.values()):
        name = f"__least_{span * 2}"
        df = df.withColumn(name, F.least(F.col(reach[span]), F.lead(reach[span], span).over(w)))
        span *= 2
        reach[span] = name
    for name, h in horizons.items():
        half = reach[1 << h.bit_length() - 1]
        rest = h - (1 << h.bit_length() - 1)
        df = df.withColumn(f"__ahead_{name}", F.least(F.col(half), F.lead(half, rest).over(w)) if rest else F.col(half))
    return df.drop(*reach.values())


HORIZONS = {"1h": 60, "4h": 240, "1d": 1440}


def forward_targets(df: DataFrame, keys: list[str], ts: str, p: str, rv: str, horizons: dict[str, int] = HORIZONS, step: int | None = None) -> DataFrame:
    """Labels over the next h rows of each horizon; all null where row +h doesn't exist.  Reads funding, spread, z."""
    rows, w = blocks(df, keys, ts, ahead=max(horizons.values()), step=step)
    rows = _least_ahead(rows, w, p, horizons)
    price, out = F.col(p), {}
    for name, h in horizons.items():
        there = F.lead(F.lit(1), h).over(w).isNotNull()
        fwd = log_ratio(F.lead(price, h).over(w), price)
        out |= {
            f"target_forward_return_{name}": F.when(there, fwd),
            f"target_forward_drawdown_{name}": F.when(there & (price > 0), F.col(f"__ahead_{name}") / price - 1),
            f"target_cost_adjusted_return_{name}": F.when(there, fwd - 0.0002 - F.abs(F.coalesce(F.col("funding"), F.lit(0.0))) * h / 480),
            f"target_future_rv_{name}": F.when(there, F.lead(rv, h).over(w)),
            f"target_future_iv_spread_change_{name}": F.when(there, F.lead("spread", h).over(w) - F.col("spread")),
            f"label_regime_shift_{name}": F.when(there, F.abs(F.lead("z", h).over(w) - F.col("z")) >= 1.0),
        }
    return whole(rows.withColumns(out)).drop(*[f"__ahead_{n}" for n in horizons])


def live_extended(df: DataFrame, keys: list[str] = ("exchange", "symbol"), ts: str = "timestamp_m1", step: int | None = None) -> DataFrame:
    """Ratios, returns and 15-minute z-scores of the live table, from this row and earlier ones; absent sources count as nulls."""
    keys = list(keys)
    df = df.withColumns({c: F.lit(None).cast("double") for c in LIVE_INPUTS if c not in df.columns})
    c, x = F.col, "live_extended_"
    steps = {"volatility_index": "volatility_index_close", "index_price": "index_price"}
    df = over_rows(df, keys, ts, lambda w: {
        f"{x}{n}_log_return_{k}m": log_ratio(c(p), F.lag(p, k).over(w)) for n, p in steps.items() for k in (1, 5)}, back=5, step=step)
    df = df.withColumns({
        f"{x}volatility_index_range_ratio": ratio(c("volatility_index_high") - c("volatility_index_low"), c("volatility_index_close")),
        f"{x}futures_basis_ratio": ratio(c("futures_summary_mark_price") - c("futures_summary_index_price"), c("futures_summary_index_price")),
        f"{x}futures_open_interest_turnover_ratio": ratio(c("futures_summary_open_interest"), c("futures_summary_turnover")),
        f"{x}options_surface_quote_fill_ratio": ratio(c("options_surface_fresh_quote_count"), c("options_surface_contract_count")),
        f"{x}options_surface_stale_quote_ratio": ratio(c("options_surface_stale_quote_count"), c("options_surface_contract_count")),
        f"{x}options_surface_skew_term_ratio": ratio(c("options_surface_skew"), c("options_surface_term_structure")),
        f"{x}perps_l2_spread_bps": ratio(c("perps_l2_spread"), c("perps_l2_mid_price")) * 10_000,
        f"{x}options_l2_depth_imbalance_ratio": ratio(
            c("options_l2_top_bid_depth") - c("options_l2_top_ask_depth"), c("options_l2_top_bid_depth") + c("options_l2_top_ask_depth")),
        f"{x}options_l2_quote_gap_ratio": 1 - c("options_l2_quote_coverage_ratio"),
    })
    series = {"futures_mark_price": "futures_summary_mark_price", "perps_l2_spread": "perps_l2_spread", "index_price": "index_price"}
    df = rolling(df, keys, ts, {f"__{n}": c(p) for n, p in series.items()}, {"15m": 15 * MINUTE})
    for n, p in series.items():
        w = f"__{n}_15m"
        mean, std = F.when(c(f"{w}.n") >= 2, c(f"{w}.mean")), c(f"{w}.std")
        df = df.withColumns({f"{x}{n}_mean_15m": mean, f"{x}{n}_std_15m": std, f"{x}{n}_zscore_15m": ratio(c(p) - mean, std)}).drop(w)
    return df


#: The columns of the live table that ``live_extended`` reads.
LIVE_INPUTS = (
    "volatility_index_high", "volatility_index_low", "volatility_index_close", "index_price", "futures_summary_mark_price",
    "futures_summary_index_price", "futures_summary_open_interest", "futures_summary_turnover", "options_surface_fresh_quote_count",
    "options_surface_contract_count", "options_surface_stale_quote_count", "options_surface_skew", "options_surface_term_structure",
    "perps_l2_spread", "perps_l2_mid_price", "options_l2_top_bid_depth", "options_l2_top_ask_depth", "options_l2_quote_coverage_ratio",
)
