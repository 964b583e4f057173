"""Assembly of wide tables: sources, prefixed, left-joined in turn onto a grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import micros
from tidemark.operators import features as T
from tidemark.operators.dedup import keep_last
from tidemark.operators.grid import span_grid
from tidemark.operators.resample import resample
from tidemark.plans.contracts import ALIASES, GOLD, KEYS_ONLY, OBSERVED_ONLY, PREPARED, SHARED

KEYS = ["exchange", "symbol", "timestamp_m1"]


def prefixed(df: DataFrame, prefix: str, keys: list[str] = KEYS) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in keys])


def assemble(grid: DataFrame, required: dict[str, DataFrame], optional: dict[str, tuple[str, DataFrame | None]] | None = None) -> DataFrame:
    """The grid with each source's columns (prefixed by its name) and a flag whether the source has the row.

    optional: name -> (DDL of its columns, frame or None); an absent one contributes typed nulls.
    All joins share the grid's keys, so one partitioning serves them all.
    """
    out = grid
    for name, df in required.items():
        out = _joined(out, name, df)
    for name, (ddl, df) in (optional or {}).items():
        if df is not None:
            out = _joined(out, name, df)
            continue
        for field in (x.split() for x in ddl.split(",")):
            out = out.withColumn(f"{name}_{field[0]}", F.lit(None).cast(field[1]))
        out = out.withColumn(f"{name}_available", F.lit(False))
    return out


def _joined(out: DataFrame, name: str, df: DataFrame) -> DataFrame:
    flag = f"{name}_available"
    side = prefixed(df, name).withColumn(flag, F.lit(True))
    return out.join(side, KEYS, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def build(dataset: str, sources: dict[str, DataFrame], seconds: int = 60) -> DataFrame:
    """A Gold table on the union grid of its required sources; coarser than a minute it is resampled.

    sources: by name; time columns may be open_time, timestamp or timestamp_m1.  Absent optional sources add typed nulls, so the
    columns don't depend on what is there; each source has a flag for the minutes that it knows.  Columns that two sources share are an error
    unless the contract knows of them.
    """
    required, optional = GOLD[dataset]
    if lacking := [s for s in required if s not in sources]:
        raise KeyError(f"{dataset} needs {lacking}")
    ready = {s: prepared(s, sources[s]) for s in (*required, *(o for o in optional if o in sources))}
    out = chained(dataset, grid_of(dataset, ready), ready, KEYS)
    if dataset == "live.extended":
        out = T.live_extended(out)
    return out if seconds == 60 else resample(out, KEYS[:2], KEYS[2], seconds)


def grid_of(dataset: str, ready: dict[str, DataFrame]) -> DataFrame:
    """The minutes of a table, from its required sources."""
    of_grid = [s for s in GOLD[dataset][0] if not (dataset in LIVE_TABLES and s in KEYS_ONLY)]
    minutes = reduce(DataFrame.unionByName, [ready[s].select(*KEYS) for s in of_grid])
    return minutes.distinct() if dataset in OBSERVED_ONLY else span_grid(minutes, KEYS[:2], KEYS[2])


def chained(dataset: str, out: DataFrame, ready: dict[str, DataFrame], on: list[str], hint: str | None = None) -> DataFrame:
    """The grid with the columns of each source, or typed nulls, and a flag whether the source has the row."""
    required, optional = GOLD[dataset]
    for name in (*required, *optional):
        flag = f"{name}_available"
        if name not in ready:
            out = out.withColumns({c: F.lit(None).cast(kind) for c, (_, kind) in PREPARED.get(name, {}).items()} | {flag: F.lit(False)})
            continue
        side = ready[name]
        clash = (set(side.columns) & set(out.columns)) - set(on)
        if clash - SHARED.get(name, set()):
            raise ValueError(f"{name} shares columns with earlier sources: {sorted(clash)}")
        side = side.withColumnsRenamed({c: f"{c}_right" for c in clash}).withColumn(flag, F.lit(True))
        out = out.join(side.hint(hint) if hint else side, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return out


LIVE_TABLES = ("live.full", "live.extended")


def prepared(name: str, df: DataFrame) -> DataFrame:
    """A source on the minute grid, one row a key, with the columns that its contract gives a Gold table, in order.

    Older names are renamed, columns that the source lacks are typed nulls, contracts of a minute are aggregated, of several
    rows of a key the one that was ingested last stays.
    """
    renamed = {a: b for a, b in ALIASES.get(name, {}).items() if a in df.columns and b not in df.columns}
    df = df.withColumnsRenamed(renamed)
    time = next(c for c in ("timestamp_m1", "ts_minute", "open_time", "trade_time", "snapshot_date", "timestamp") if c in df.columns)
    df = df.withColumn("__at", F.col(time).cast("timestamp_ntz"))
    df = df.drop("timestamp_m1", "ts_minute").withColumn(KEYS[2], F.date_trunc("minute", "__at").cast("timestamp_ntz"))
    if name in KEYS_ONLY:
        return df.select(*KEYS).distinct()
    if name == "gold_l2":
        return prefixed(keep_last(df, KEYS, *_newest(df)).drop("__at", "timestamp"), "l2")
    if name == "options_l2_1m_feature" or name == "options_l2_snapshot_1m_observed":
        df = options_book(df)
    elif name in ("options_ticker_snapshot_1m_observed", "options_instrument_ticker_snapshot_1m_observed"):
        df = options_quotes(df)
    else:
        df = keep_last(df, KEYS, *_newest(df))
        if name == "perps_l2_snapshot_1m_observed":
            df = book_snapshot(df)
        if name in ("perps_l2_1m_feature", "perps_l2_snapshot_1m_observed"):
            df = df.withColumns({"as_of": F.col(KEYS[2]), "live_snapshot_derived": F.lit(True)})
        if name == "historical_volatility_observed":
            df = df.withColumn("historical_volatility_available", F.lit(True))
        if name == "volatility_index_1m_feature":
            df = df.withColumn("live_snapshot_derived", F.lit(True))
    return df.select(*KEYS, *[(F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)).alias(out) for out, (c, kind) in PREPARED[name].items()])


def _newest(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in ("ingested_at", "__at", "instrument_name") if c in df.columns]


def _age(df: DataFrame) -> Column:
    """Whole seconds between a quote's time and its arrival."""
    if "ingested_at" not in df.columns:
        return F.lit(None).cast("double")
    return F.abs(((micros(F.col("ingested_at")) - micros(F.col("__at"))) / 1_000_000).cast("long")).cast("double")


def book_snapshot(df: DataFrame) -> DataFrame:
    """Top of the book of a snapshot without its depth."""
    bid, ask, b, a = (F.col(f"best_{side}_{what}").cast("double") for what in ("price", "size") for side in ("bid", "ask"))
    return df.withColumns({
        "mid_price": (bid + ask) / 2, "spread": ask - bid, "top_bid_size": b, "top_ask_size": a, "top_of_book_imbalance": F.when(b + a > 0, (b - a) / (b + a)),
        "quote_available": bid.isNotNull() & ask.isNotNull(), "stale_quote": F.lit(False), "quote_age_seconds": _age(df)})


def options_book(df: DataFrame) -> DataFrame:
    """Liquidity of all contracts of a minute: their number, shares quoted and stale, median spread, summed sizes and depths, greatest age.

    From books (best prices and sizes) or from the minutes of each contract, of which the last of a contract counts.
    """
    snapshot = "quote_available" not in df.columns and "best_bid_size" in df.columns
    last = keep_last(df, [*KEYS, "instrument_name"], *_newest(df))
    last = book_snapshot(last) if snapshot else last
    own = lambda c: (F.col(c) if c in last.columns else F.lit(None)).cast("double")
    share = lambda c: F.avg(own(c))
    total = lambda c: F.coalesce(F.sum(own(c)), F.lit(0.0))
    depths = [f"{side}_depth_{n}bps" for n in (10, 50) for side in ("bid", "ask")]
    return last.groupBy(*KEYS).agg(
        F.count_distinct("instrument_name").alias("contract_count"), share("quote_available").alias("quote_coverage_ratio"), share("stale_quote").alias("stale_quote_ratio"),
        F.median(own("spread")).alias("median_spread"), total("top_bid_size").alias("top_bid_depth"), total("top_ask_size").alias("top_ask_depth"),
        *[(F.lit(None).cast("double") if snapshot else total(c)).alias(c) for c in depths], F.max(own("quote_age_seconds")).alias("max_quote_age_seconds"),
        F.max(KEYS[2]).alias("as_of"), F.lit(True).alias("live_snapshot_derived"))


def options_quotes(df: DataFrame) -> DataFrame:
    """A surface of all quotes of a minute: median volatility, contracts, fresh (with bid, ask and mark) and other quotes, greatest age.

    Rows that are surfaces already (``atm_iv``, with or without prefix) are taken as they are, the last of a minute.
    """
    if "atm_iv" in df.columns or "options_surface_atm_iv" in df.columns:
        last = keep_last(df, KEYS, *_newest(df))
        return last.withColumnsRenamed({c: c.removeprefix("options_surface_") for c in last.columns if c.startswith("options_surface_") and c.removeprefix("options_surface_") not in last.columns})
    last = keep_last(df, [*KEYS, "instrument_name"], *_newest(df))
    quoted = F.lit(True)
    for c in ("bid_price", "ask_price", "mark_price"):
        quoted = quoted & (F.col(c).isNotNull() if c in df.columns else F.lit(False))
    iv = F.median(F.col("implied_volatility") if "implied_volatility" in last.columns else F.lit(None).cast("double"))
    return last.withColumns({"__fresh": quoted, "__age": _age(last)}).groupBy(*KEYS).agg(
        iv.alias("atm_iv"), iv.alias("short_dated_iv"), F.count_distinct("instrument_name").alias("contract_count"), F.count_if("__fresh").alias("fresh_quote_count"),
        F.count_if(~F.col("__fresh")).alias("stale_quote_count"), F.max("__age").alias("max_quote_age_seconds"), F.avg(F.col("__fresh").cast("double")).alias("quote_coverage_ratio"))


def with_strategy_features(gold: DataFrame) -> DataFrame:
    """Regime table with momentum, cost, trend and reversion features."""
    keys, ts, p, s = KEYS[:2], KEYS[2], "perp_close_price", "spot_ohlcv_close_price"
    out = T.log_returns(gold, keys, ts, p, (1, 5, 15), step=60)
    out = out.withColumnsRenamed({f"log_return_{n}": f"momentum_log_return_{n}m" for n in (1, 5, 15)})
    scaled = {f"momentum_vol_scaled_{n}m": F.when(F.col("rv_1h") != 0, F.col(f"momentum_log_return_{n}m") / F.col("rv_1h")) for n in (5, 15)}
    out = out.withColumns(scaled | {"cost_spot_perp_spread": F.when(F.col(s) != 0, F.col(p) / F.col(s)) - 1, "cost_turnover_notional_1m": F.col(p) * F.col("perp_volume")})
    out = T.momentum(out, keys, ts, p, "perp_volume")
    out = T.rolling_zscore(out, keys, ts, "cost_spot_perp_spread", {f"{n}m": 60 * n for n in (5, 15)}, "reversion_spot_perp_spread_zscore_")
    return T.half_life(T.ema(out, keys, ts, p), keys, ts, p)


def with_targets(gold: DataFrame) -> DataFrame:
    """Labels at one hour, four hours and a day from perp_close_price, rv_1h, iv_minus_rv_1h, iv_rv_zscore_1d, funding_rate_last_known."""
    own = gold.withColumns({"funding": F.col("funding_rate_last_known"), "spread": F.col("iv_minus_rv_1h"), "z": F.col("iv_rv_zscore_1d")})
    return T.forward_targets(own, KEYS[:2], KEYS[2], "perp_close_price", "rv_1h", step=60).drop("funding", "spread", "z")
