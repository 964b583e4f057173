"""Contracts: the columns, in order, of each dataset, and what Gold tables are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The columns of each dataset, whole and in the contract's order.
COLUMNS: dict[str, list[str]] = {k: v.split() for k, v in {
    "ohlcv": """
        schema_version dataset_type exchange symbol instrument_type event_time ingested_at run_id source_endpoint open_time close_time timeframe
        open_price high_price low_price close_price volume quote_volume trade_count origin_payload
    """,
    "funding_observed": """
        funding_time exchange symbol base_asset instrument_type funding_rate funding_interval_hours ingested_at_min ingested_at_max source_row_count
        silver_built_at data_quality_status
    """,
    "funding_1m_feature": """
        timestamp exchange symbol funding_rate_last_known funding_observed_at minutes_since_funding is_funding_observation_minute
        funding_data_available
    """,
    "open_interest_observed": """
        timestamp exchange symbol open_interest open_interest_source_timestamp ingested_at source_endpoint
    """,
    "open_interest_1m_feature": """
        timestamp_m1 exchange symbol open_interest open_interest_is_observed open_interest_is_ffill minutes_since_open_interest_observation
        open_interest_observation_lag_sec open_interest_source_timestamp
    """,
    "trades_1m_feature": """
        timestamp_m1 exchange symbol instrument_type open_price high_price low_price close_price volume quote_volume trade_count buy_volume
        sell_volume buy_trade_count sell_trade_count buy_volume_share
    """,
    "trades_observed": """
        trade_time exchange symbol instrument_type trade_id price quantity side
    """,
    "historical_prediction_1m_feature": """
        timestamp_m1 exchange symbol historical_prediction_spot_log_return_1m historical_prediction_perps_log_return_1m
        historical_prediction_spot_rv_15m historical_prediction_spot_rv_1h historical_prediction_spot_rv_1d historical_prediction_perps_rv_15m
        historical_prediction_perps_rv_1h historical_prediction_perps_rv_1d historical_prediction_spot_perp_basis
        historical_prediction_basis_change_1m historical_prediction_basis_zscore_1h historical_prediction_open_interest_delta_1m
        historical_prediction_open_interest_pct_change_1m historical_prediction_open_interest_zscore_1h historical_prediction_funding_rate_change_1m
        historical_prediction_funding_rate_zscore_1d historical_prediction_funding_basis_divergence historical_prediction_perps_trade_imbalance
        historical_prediction_perps_trade_count_zscore_1h historical_prediction_perps_quote_volume_zscore_1h
        historical_prediction_perps_price_impact_1m historical_prediction_options_trade_imbalance
        historical_prediction_options_trade_count_zscore_1h historical_prediction_options_quote_volume_zscore_1h
        historical_prediction_leverage_build_up_signal historical_prediction_short_stress_signal historical_prediction_flow_volatility_pressure
    """,
    "volatility_observed": """
        timestamp exchange symbol instrument_type dataset_type volatility_value volatility_open volatility_high volatility_low volatility_close
        volatility_source_timestamp ingested_at source_endpoint
    """,
    "volatility_index_1m_feature": """
        timestamp_m1 exchange symbol iv_open iv_high iv_low iv_close iv_range iv_return_1m iv_change_5m iv_change_15m iv_change_1h iv_zscore_1d
        iv_zscore_7d iv_percentile_30d iv_30d_annualized_pct iv_source_dataset iv_source_timestamp minutes_since_iv_observation iv_data_available
    """,
    "index_price_observed": """
        timestamp exchange symbol index_name index_price index_price_source_timestamp ingested_at source_endpoint
    """,
    "index_price_1m_feature": """
        timestamp_m1 exchange symbol index_price index_price_is_observed index_price_source_timestamp minutes_since_index_price_observation
    """,
    "futures_summary_observed": """
        timestamp exchange symbol instrument_type mark_price index_price open_interest volume turnover funding_rate ingested_at source_endpoint
    """,
    "futures_summary_1m_feature": """
        timestamp_m1 exchange symbol instrument_type mark_price index_price mark_index_spread mark_index_ratio open_interest volume turnover
        funding_rate summary_is_observed minutes_since_summary_observation
    """,
    "options_ticker_observed": """
        timestamp exchange symbol instrument_name underlying expiry strike underlying_price index_price option_type mark_price bid_price ask_price
        implied_volatility delta gamma vega theta open_interest volume ingested_at source_endpoint
    """,
    "l2_observed": """
        timestamp exchange symbol instrument_type instrument_name underlying expiry strike option_type best_bid_price best_bid_size best_ask_price
        best_ask_size bids asks ingested_at source_endpoint
    """,
    "l2_1m_feature": """
        timestamp_m1 exchange symbol instrument_type instrument_name underlying expiry strike option_type best_bid_price best_ask_price mid_price
        spread top_bid_size top_ask_size top_of_book_imbalance bid_depth_10bps ask_depth_10bps bid_depth_50bps ask_depth_50bps quote_available
        quote_age_seconds stale_quote minutes_since_l2_observation
    """,
    "recent_trade_observed": """
        trade_time exchange symbol instrument_type instrument_name underlying expiry strike option_type trade_id deduplication_key
        trade_id_is_source price quantity side snapshot_timestamp snapshot_derived ingested_at source_endpoint
    """,
    "instrument_metadata_observed": """
        snapshot_date exchange instrument_name symbol instrument_type base_currency quote_currency settlement_currency expiry strike option_type
        tick_size contract_size min_trade_amount creation_timestamp is_active is_listed listing_state ingested_at source_endpoint
    """,
    "historical_volatility_observed": """
        timestamp exchange symbol historical_volatility historical_volatility_source_timestamp ingested_at source_endpoint
    """,
    "options_surface_1m_feature": """
        timestamp_m1 exchange symbol atm_iv short_dated_iv skew term_structure put_call_iv_spread contract_count fresh_quote_count stale_quote_count
        max_quote_age_seconds quote_coverage_ratio
    """,
    "realized_volatility_1m_feature": """
        timestamp_m1 exchange symbol canonical_rv_source canonical_rv_source_available rv_5m rv_15m rv_1h rv_4h rv_1d rv_5m_annualized_pct
        rv_15m_annualized_pct rv_1h_annualized_pct rv_4h_annualized_pct rv_1d_annualized_pct rv_30d rv_30d_annualized_pct spot_log_return spot_rv_5m
        spot_rv_15m spot_rv_1h spot_rv_4h spot_rv_1d spot_rv_30d spot_rv_5m_annualized_pct spot_rv_15m_annualized_pct spot_rv_1h_annualized_pct
        spot_rv_4h_annualized_pct spot_rv_1d_annualized_pct spot_rv_30d_annualized_pct perps_log_return perps_rv_5m perps_rv_15m perps_rv_1h
        perps_rv_4h perps_rv_1d perps_rv_30d perps_rv_5m_annualized_pct perps_rv_15m_annualized_pct perps_rv_1h_annualized_pct
        perps_rv_4h_annualized_pct perps_rv_1d_annualized_pct perps_rv_30d_annualized_pct parkinson_rv_1h jump_proxy spot_available perps_available
        spot_perps_basis_available
    """,
    "iv_rv_1m_feature": """
        timestamp_m1 exchange symbol canonical_rv_source iv_minus_rv_1h iv_minus_rv_1d iv_rv_ratio_1h iv_rv_ratio_1d iv_rv_spread_30d_pct
        iv_rv_ratio_30d iv_rv_zscore_1d iv_rv_percentile_30d minutes_since_iv_observation minutes_since_rv_observation iv_available rv_available
    """,
}.items()}

#: Columns that are carried from the source, with their types; null where a source lacks them.
CARRIED = {
    "schema_version": "string", "dataset_type": "string", "instrument_type": "string", "event_time": "timestamp_ntz", "run_id": "string",
    "source_endpoint": "string", "close_time": "timestamp_ntz", "timeframe": "string", "origin_payload": "string", "ingested_at": "timestamp_ntz",
    "iv_source_dataset": "string", "iv_source_timestamp": "timestamp_ntz", "canonical_rv_source": "string", "quote_volume": "double", "trade_count": "bigint",
}

#: What is done about missing data.
POLICY = {
    "ohlcv": "drop_invalid", "funding_observed": "observed_only", "funding_1m_feature": "forward_fill", "open_interest_observed": "observed_only",
    "open_interest_1m_feature": "forward_fill", "trades_1m_feature": "observed_plus_confirmed_empty", "trades_observed": "drop_invalid",
    "historical_prediction_1m_feature": "observed_only", "volatility_observed": "observed_only", "volatility_index_1m_feature": "observed_only",
    "index_price_observed": "observed_only", "index_price_1m_feature": "forward_fill", "futures_summary_observed": "observed_only",
    "futures_summary_1m_feature": "forward_fill", "options_ticker_observed": "observed_only", "l2_observed": "drop_invalid", "l2_1m_feature": "observed_only",
    "recent_trade_observed": "drop_invalid", "instrument_metadata_observed": "none", "historical_volatility_observed": "observed_only",
    "options_surface_1m_feature": "observed_only", "realized_volatility_1m_feature": "observed_only", "iv_rv_1m_feature": "observed_only",
}

#: Gold tables: required and optional sources, with the prefix that each one's columns get there.
_HISTORY = ("spot_ohlcv", "perps_ohlcv", "funding_1m_feature", "open_interest_1m_feature", "perps_trades_1m_feature", "options_trades_1m_feature")
_REGIME = ("spot_ohlcv", "perps_ohlcv", "funding_1m_feature", "open_interest_1m_feature", "realized_volatility_1m_feature", "iv_rv_1m_feature")
_STATE = ("perps_l2_1m_feature", "options_l2_1m_feature", "options_surface_1m_feature", "index_price_1m_feature", "futures_summary_1m_feature", "historical_volatility_observed")
_LIVE = (
    "volatility_index_snapshot_1m_observed", "index_price_snapshot_1m_observed", "futures_summary_snapshot_1m_observed", "options_ticker_snapshot_1m_observed",
    "options_instrument_ticker_snapshot_1m_observed", "perps_l2_snapshot_1m_observed", "options_l2_snapshot_1m_observed", "recent_trade_snapshot_1m_observed",
    "instrument_metadata_snapshot_daily_observed", "futures_instrument_metadata_snapshot_daily_observed",
)
GOLD: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "history.full": (_HISTORY, ()),
    "history.extended": ((*_HISTORY, "historical_prediction_1m_feature"), ()),
    "history.extended_full": ((*_HISTORY, "historical_prediction_1m_feature"), ()),
    "market.core": (("spot_ohlcv", "perps_ohlcv"), ()),
    "market.core.funding": (("spot_ohlcv", "perps_ohlcv", "funding_1m_feature"), ()),
    "market.perps_trades": (("perps_trades_1m_feature",), ()),
    "market.options_trades": (("options_trades_1m_feature",), ()),
    "market.index_price": (("index_price_1m_feature",), ()),
    "market.futures_summary": (("futures_summary_1m_feature",), ()),
    "market.iv_rv": (_REGIME, ("historical_volatility_observed",)),
    "market.regime_features": (_REGIME, _STATE),
    "market.prediction_targets": (("perps_ohlcv", "funding_1m_feature", "realized_volatility_1m_feature", "iv_rv_1m_feature"), ()),
    "market.full": ((*_REGIME, "perps_trades_1m_feature"), ()),
    "hybrid.full_l2": ((*_REGIME, "perps_trades_1m_feature"), ("gold_l2",)),
    "live.full": (_LIVE, ()),
    "live.extended": (_LIVE, ()),
    "live.volatility_features": (("volatility_index_1m_feature",), ()),
    "live.microstructure_features": (("perps_l2_1m_feature", "options_l2_1m_feature"), ()),
}
#: Tables on whose rows only observed minutes stand; the others have every minute of their span.
OBSERVED_ONLY = ("live.volatility_features", "live.microstructure_features", "live.full", "live.extended")
#: Sources that only give their minutes: they are there for lineage, and in live tables they make no minute of their own.
KEYS_ONLY = ("recent_trade_snapshot_1m_observed", "instrument_metadata_snapshot_daily_observed", "futures_instrument_metadata_snapshot_daily_observed")


def _made(names: str, kind: str = "double", prefix: str = "") -> dict[str, tuple[str, str]]:
    """Column of the Gold table -> column of the source and type."""
    return {prefix + n: (n, kind) for n in names.split()}


def _prices(prefix: str) -> dict[str, tuple[str, str]]:
    return _made("open_price high_price low_price close_price volume quote_volume", prefix=prefix) | _made("trade_count", "bigint", prefix)


def _trades(prefix: str) -> dict[str, tuple[str, str]]:
    return _prices(prefix) | _made("buy_volume sell_volume", prefix=prefix) | _made("buy_trade_count sell_trade_count", "bigint", prefix) | _made("buy_volume_share", prefix=prefix)


_RV = "rv_5m rv_15m rv_1h rv_4h rv_1d"
_ANNUAL = "rv_5m_annualized_pct rv_15m_annualized_pct rv_1h_annualized_pct rv_4h_annualized_pct rv_1d_annualized_pct"
_INDEX = _made("index_price") | _made("index_price_is_observed", "boolean") | _made("minutes_since_index_price_observation", "bigint")
_SUMMARY = (
    _made("instrument_type", "string", "futures_summary_")
    | _made("mark_price index_price mark_index_spread mark_index_ratio open_interest volume turnover funding_rate", prefix="futures_summary_")
    | {"futures_summary_is_observed": ("summary_is_observed", "boolean")} | _made("minutes_since_summary_observation", "bigint")
)
_SURFACE = (
    _made("atm_iv short_dated_iv skew term_structure put_call_iv_spread", prefix="options_surface_")
    | _made("contract_count fresh_quote_count stale_quote_count", "bigint", "options_surface_") | _made("max_quote_age_seconds quote_coverage_ratio", prefix="options_surface_")
)
_PERPS_BOOK = (
    _made("best_bid_price best_ask_price mid_price spread top_bid_size top_ask_size top_of_book_imbalance bid_depth_10bps ask_depth_10bps bid_depth_50bps"
          " ask_depth_50bps quote_age_seconds", prefix="perps_l2_")
    | _made("quote_available stale_quote", "boolean", "perps_l2_") | {"perps_l2_minutes_since_observation": ("minutes_since_l2_observation", "bigint")}
    | _made("as_of", "timestamp_ntz", "perps_l2_") | _made("live_snapshot_derived", "boolean", "perps_l2_")
)
_OPTIONS_BOOK = (
    _made("contract_count", "bigint", "options_l2_")
    | _made("quote_coverage_ratio stale_quote_ratio median_spread top_bid_depth top_ask_depth bid_depth_10bps ask_depth_10bps bid_depth_50bps ask_depth_50bps"
            " max_quote_age_seconds", prefix="options_l2_")
    | _made("as_of", "timestamp_ntz", "options_l2_") | _made("live_snapshot_derived", "boolean", "options_l2_")
)
_VOLATILITY_INDEX = {f"volatility_index_{x}": (f"volatility_{x}", "double") for x in ("value", "open", "high", "low", "close")}

#: The columns that each source gives a Gold table, in order, with what they are made of.
PREPARED: dict[str, dict[str, tuple[str, str]]] = {
    "spot_ohlcv": _prices("spot_ohlcv_"),
    "perps_ohlcv": _prices("perp_"),
    "open_interest_1m_feature": {"open_interest_open_interest": ("open_interest", "double")} | _made("open_interest_is_observed open_interest_is_ffill", "boolean")
    | _made("minutes_since_open_interest_observation open_interest_observation_lag_sec", "bigint") | _made("open_interest_source_timestamp", "timestamp_ntz"),
    "funding_1m_feature": _made("funding_rate_last_known") | _made("funding_observed_at", "timestamp_ntz") | _made("minutes_since_funding", "bigint")
    | _made("is_funding_observation_minute funding_data_available", "boolean"),
    "perps_trades_1m_feature": _trades("perps_trades_"),
    "options_trades_1m_feature": _trades("options_trades_"),
    "historical_prediction_1m_feature": _made(" ".join(COLUMNS["historical_prediction_1m_feature"][3:])),
    "volatility_index_data_observed": _VOLATILITY_INDEX,
    "volatility_index_snapshot_1m_observed": _VOLATILITY_INDEX,
    "volatility_index_1m_feature": _made("iv_open iv_high iv_low iv_close iv_range iv_return_1m iv_change_5m iv_change_15m iv_change_1h iv_zscore_1d iv_zscore_7d"
                                         " iv_percentile_30d iv_30d_annualized_pct")
    | _made("iv_source_dataset", "string") | _made("iv_source_timestamp", "timestamp_ntz") | _made("minutes_since_iv_observation", "bigint")
    | _made("iv_data_available", "boolean") | {"as_of": ("iv_source_timestamp", "timestamp_ntz")} | _made("live_snapshot_derived", "boolean"),
    "iv_rv_1m_feature": _made("canonical_rv_source", "string")
    | _made("iv_minus_rv_1h iv_minus_rv_1d iv_rv_ratio_1h iv_rv_ratio_1d iv_rv_spread_30d_pct iv_rv_ratio_30d iv_rv_zscore_1d iv_rv_percentile_30d")
    | _made("minutes_since_iv_observation minutes_since_rv_observation", "bigint") | _made("iv_available rv_available", "boolean"),
    "realized_volatility_1m_feature": _made("canonical_rv_source", "string") | _made("canonical_rv_source_available", "boolean")
    | _made(f"{_RV} {_ANNUAL} rv_30d rv_30d_annualized_pct")
    | {k: v for side in ("spot_", "perps_") for k, v in {f"{side}{n}": (f"{side}{n}", "double") for n in f"log_return {_RV} rv_30d {_ANNUAL} rv_30d_annualized_pct".split()}.items()}
    | _made("parkinson_rv_1h jump_proxy") | _made("spot_available perps_available spot_perps_basis_available", "boolean"),
    "index_price_1m_feature": _INDEX,
    "index_price_snapshot_1m_observed": _INDEX,
    "futures_summary_1m_feature": _SUMMARY,
    "futures_summary_snapshot_1m_observed": _SUMMARY,
    "options_surface_1m_feature": _SURFACE,
    "options_ticker_snapshot_1m_observed": _SURFACE,
    "options_instrument_ticker_snapshot_1m_observed": _SURFACE,
    "perps_l2_1m_feature": _PERPS_BOOK,
    "perps_l2_snapshot_1m_observed": _PERPS_BOOK,
    "options_l2_1m_feature": _OPTIONS_BOOK,
    "options_l2_snapshot_1m_observed": _OPTIONS_BOOK,
    "historical_volatility_observed": {"historical_volatility_reference": ("historical_volatility", "double")}
    | _made("historical_volatility_source_timestamp", "timestamp_ntz") | _made("historical_volatility_available", "boolean"),
} | {name: {} for name in KEYS_ONLY}
#: Older names of columns in sources.
ALIASES = {
    "open_interest_1m_feature": {
        "oi_is_observed": "open_interest_is_observed", "oi_is_ffill": "open_interest_is_ffill", "oi_source_timestamp": "open_interest_source_timestamp",
        "minutes_since_oi_observation": "minutes_since_open_interest_observation", "oi_observation_lag_sec": "open_interest_observation_lag_sec",
    },
}
#: Columns that a later source shares with an earlier one of the same table: they get ``_right`` at their end.  Any other clash is an error.
SHARED = {"iv_rv_1m_feature": {"canonical_rv_source"}, "options_instrument_ticker_snapshot_1m_observed": set(_SURFACE)}


def carried(df: DataFrame, name: str, kind: str | None = None):
    """A column of ``df``, or nulls of its type where it has none."""
    kind = kind or CARRIED[name]
    return (F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name)


def conform(df: DataFrame, dataset: str) -> DataFrame:
    """The columns of a contract, in its order; a missing one is an error, unless it is carried from the source."""
    return df.select(*[carried(df, c) if c in CARRIED and c not in df.columns else F.col(c) for c in COLUMNS[dataset]])


def missing_columns(df: DataFrame, dataset: str) -> list[str]:
    return [c for c in COLUMNS[dataset] if c not in df.columns]


def valid_metadata(kind: str = "instrument_type"):
    """Instrument metadata: positive sizes; options need strike, expiry and type, futures an expiry, others none."""
    option = F.col("strike").isNotNull() & (F.col("strike") > 0) & F.col("expiry").isNotNull() & F.col("option_type").isin("C", "P")
    rule = F.when(F.col(kind) == "option", option).when(F.col(kind) == "future", F.col("expiry").isNotNull()).otherwise(True)
    return F.coalesce((F.col("tick_size") > 0) & (F.col("contract_size") > 0) & rule, F.lit(False))
