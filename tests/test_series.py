"""Hand-computed expectations of operators on small frames."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import bars as B
from tidemark.operators import features as T
from tidemark.operators import gaps as G
from tidemark.operators import sync as S
from tidemark.operators.asof import asof, leaks, require_no_leak
from tidemark.operators.book import book_features, valid_book
from tidemark.operators.grid import fixed_grid, span_grid
from tidemark.operators.resample import resample
from tidemark.plans import gold, silver
from tidemark.plans.contracts import COLUMNS, GOLD, POLICY, missing_columns, valid_metadata

T0 = datetime(2026, 1, 1)


def at(minutes, seconds=0):
    return T0 + timedelta(minutes=minutes, seconds=seconds)


def near(xs, ys, rel=1e-9):
    assert len(xs) == len(ys)
    for x, y in zip(xs, ys):
        assert (x is None) == (y is None), (xs, ys)
        assert x is None or x == pytest.approx(y, rel=rel)


def test_trades_keep_the_last_valid_arrival(spark):
    rows = [("d", "btc/usd", at(0), "1", 100.0, 1.0, "BUY", at(1)), ("d", "btc-usd", at(0), "1", 101.0, 1.0, "buy ", at(2)), ("d", "btc_usd", at(0), "2", -1.0, 1.0, "sell", at(1)),
            ("d", "btc-usd", at(0), "3", float("nan"), 1.0, "sell", at(1)), ("d", "btc-usd", at(0), "4", None, 1.0, "sell", at(1))]
    raw = spark.createDataFrame(rows, "exchange string, symbol string, trade_time timestamp_ntz, trade_id string, price double, quantity double, side string, ingested_at timestamp_ntz")
    got = silver.trades_observed(raw).collect()
    assert [(r.symbol, r.price, r.side) for r in got] == [("BTC-USD", 101.0, "buy")]
    assert silver.trades_observed(raw.limit(0)).count() == 0


def test_bars_fill_empty_minutes_across_slices(spark):
    ticks = spark.createDataFrame([("d", "B", at(0, 5), 1, 10.0, 2.0, "buy"), ("d", "B", at(0, 5), 2, 12.0, 1.0, "sell"), ("d", "B", at(3000), 3, 9.0, 1.0, "none")],
                                  "exchange string, symbol string, trade_time timestamp_ntz, trade_id long, price double, quantity double, side string")
    grid = span_grid(B.minute_bars(ticks), B.KEYS, "timestamp_m1")
    rows = {r.timestamp_m1: r for r in silver.trade_feature(ticks, grid).collect()}
    assert len(rows) == 3001
    first, filled = rows[at(0)], rows[at(2999)]
    assert (first.open_price, first.close_price, first.volume, first.buy_volume_share) == (10.0, 12.0, 3.0, pytest.approx(2 / 3))
    assert (filled.open_price, filled.close_price, filled.volume, filled.trade_count, filled.buy_volume_share) == (12.0, 12.0, 0.0, 0, 0.0)


def test_realized_volatility_windows(spark):
    times, closes = (0, 5, 15, 60, 61), (100.0, 105.0, 110.0, 120.0, 1000.0)
    df = spark.createDataFrame([("d", "B", at(t), c) for t, c in zip(times, closes)], "exchange string, symbol string, ts timestamp_ntz, p double")
    out = T.realized_volatility(T.return_to_last_known(df, ["symbol"], "ts", "p", "r"), ["symbol"], "ts", "r").orderBy("ts").collect()
    r = [None] + [math.log(b / a) for a, b in zip(closes, closes[1:])]
    near([x.rv_5m for x in out], [None, r[1], r[2], r[3], math.hypot(r[3], r[4])])
    assert out[3].rv_1h == pytest.approx(math.sqrt(r[1] ** 2 + r[2] ** 2 + r[3] ** 2))


def test_lookback_changes_and_closed_percentile(spark):
    iv = spark.createDataFrame([("d", "B", at(t), v, v, v, v) for t, v in ((0, 50.0), (5, 55.0), (15, 70.0), (60, 80.0), (61, 1010.0))],
                               "exchange string, symbol string, timestamp timestamp_ntz, volatility_open double, volatility_high double, volatility_low double, volatility_close double")
    got = silver.volatility_feature(iv).orderBy("timestamp_m1").collect()
    near([r.iv_change_5m for r in got], [None, 5.0, 15.0, 10.0, 940.0])
    near([r.iv_change_15m for r in got], [None, None, 20.0, 10.0, 940.0])
    near([r.iv_change_1h for r in got], [None, None, None, 30.0, 960.0])
    q = spark.createDataFrame([("B", datetime(2026, 1, 1), 10.0), ("B", datetime(2026, 1, 2), 20.0), ("B", datetime(2026, 2, 1), 10.0), ("E", datetime(2026, 2, 1), 5.0)], "symbol string, ts timestamp_ntz, v double")
    pct = T.rolling_percentile(q, ["symbol"], "ts", "v", 30 * 86400, "p").orderBy("symbol", "ts").collect()
    near([r.p for r in pct], [1.0, 1.0, 0.5, 1.0])


def test_resample_rules(spark):
    cols = "symbol string, ts timestamp_ntz, perp_open double, perp_high double, perp_low double, perp_close double, perps_trades_volume double, perps_trades_buy_volume double, perps_trades_buy_volume_share double, oi double, funding_data_available boolean"
    rows = [("B", at(i), 100.0 + i, 101.0 + i if i < 5 else 106.0, 99.0 + i if i < 5 else 104.0, 100.5 + i, 10.0 * (i + 1) if i < 4 else None if i == 4 else 60.0, 6.0 * (i + 1) if i < 4 else None if i == 4 else 36.0, 0.1, 1000.0 + i, None if i else True) for i in range(6)]
    a, b = resample(spark.createDataFrame(rows, cols), ["symbol"], "ts", 300).orderBy("ts").collect()
    assert (a.perp_open, a.perp_high, a.perp_low, a.perp_close, a.oi) == (100.0, 105.0, 99.0, 104.5, 1004.0)
    assert (a.perps_trades_volume, a.perps_trades_buy_volume_share, a.funding_data_available) == (100.0, pytest.approx(0.6), True)
    assert (b.perp_open, b.perps_trades_volume, b.funding_data_available) == (105.0, 60.0, False)
    minutes = spark.createDataFrame([("B", at(i), 1.0) for i in range(60)], "symbol string, ts timestamp_ntz, x_close double")
    assert [resample(minutes, ["symbol"], "ts", s).count() for s in (300, 1800, 3600)] == [12, 2, 1]


def test_forward_targets(spark):
    rows = [("B", at(i), 100.0 + i, 22.0 + i, 0.001, 0.0 + i, 0.0) for i in range(65)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, p double, rv double, funding double, spread double, z double")
    out = T.forward_targets(df, ["symbol"], "ts", "p", "rv", {"1h": 60}).orderBy("ts").collect()
    assert out[0].target_forward_return_1h == pytest.approx(math.log(160 / 100))
    assert out[0].target_cost_adjusted_return_1h == pytest.approx(math.log(160 / 100) - 0.0002 - 0.001 * 60 / 480)
    assert (out[0].target_future_rv_1h, out[0].target_future_iv_spread_change_1h, out[0].target_forward_drawdown_1h) == (82.0, 60.0, pytest.approx(0.01))
    assert all(r.target_forward_return_1h is None and r.target_forward_drawdown_1h is None for r in out[5:])


def test_symbols_do_not_mix(spark):
    rows = [("B", at(i), p) for i, p in enumerate((100.0, 110.0, 121.0))] + [("E", at(i), p) for i, p in enumerate((10.0, 20.0, 40.0))]
    out = T.log_returns(spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, p double"), ["symbol"], "ts", "p").orderBy("symbol", "ts").collect()
    near([r.log_return_1 for r in out], [None, math.log(1.1), math.log(1.1), None, math.log(2), math.log(2)])


def test_asof_keeps_nulls_of_the_state_and_resets(spark):
    left = spark.createDataFrame([("B", datetime(2026, 1, 30)), ("B", datetime(2026, 1, 31)), ("B", datetime(2026, 2, 1)), ("E", datetime(2026, 1, 31))], "symbol string, ts timestamp_ntz")
    right = spark.createDataFrame([("B", datetime(2026, 1, 31), 5.0), ("B", datetime(2026, 1, 29), 1.0), ("E", datetime(2026, 1, 1), 3.0), ("E", datetime(2026, 1, 2), None)], "symbol string, ts timestamp_ntz, v double")
    got = {(r.symbol, r.ts.day): r.v for r in asof(left, right, "ts", ["symbol"], ["v"]).collect()}
    assert got == {("B", 30): 1.0, ("B", 31): 5.0, ("B", 1): 5.0, ("E", 31): None}
    reset = {(r.symbol, r.ts.day): r.v for r in asof(left, right, "ts", ["symbol"], ["v"], reset="month").collect()}
    assert reset[("B", 1)] is None and reset[("B", 31)] == 5.0
    bad = left.withColumn("seen", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    assert leaks(bad, "ts", "seen").count() == 4
    with pytest.raises(Exception, match="later than its row"):
        require_no_leak(bad, "ts", "seen").collect()


def test_funding_feature(spark):
    raw = spark.createDataFrame([("d", "BTC/PERP", at(2), 0.01, at(3)), ("d", "BTC-PERP", at(2), 0.02, at(4)), ("d", "BTC-PERP", at(5), 7.0, at(5)), ("d", "BTC-PERP", at(6), None, at(6)), ("d", "BTC-PERP", at(8), 0.03, at(9))],
                                "exchange string, symbol string, open_time timestamp_ntz, funding_rate double, ingested_at timestamp_ntz")
    seen = silver.funding_observed(raw)
    assert [(r.funding_rate, r.source_row_count, r.base_asset) for r in seen.orderBy("funding_time").collect()] == [(0.02, 2, "BTC"), (0.03, 1, "BTC")]
    rows = silver.funding_feature(seen).orderBy("timestamp").collect()
    assert len(rows) == 9
    assert [r.funding_rate_last_known for r in rows] == [None, None] + [0.02] * 6 + [0.03]
    assert [r.minutes_since_funding for r in rows] == [None, None, 0, 1, 2, 3, 4, 5, 0]
    assert [r.is_funding_observation_minute for r in rows] == [False, False, True] + [False] * 5 + [True]


def test_books(spark):
    level = "array<struct<price: double, amount: double>>"
    rows = [("ok", [(100.0, 1.0), (99.9, 2.0)], [(100.1, 3.0), (101.0, 4.0)]), ("unsorted", [(99.0, 1.0), (100.0, 2.0)], [(101.0, 1.0)]), ("negative", [(100.0, -1.0)], [(101.0, 1.0)]),
            ("crossed", [(102.0, 1.0)], [(101.0, 1.0)]), ("one side", [], [(101.0, 1.0)]), ("null", None, [(101.0, 1.0)])]
    df = spark.createDataFrame(rows, f"id string, bids {level}, asks {level}")
    assert {r.id for r in df.where(valid_book(F.col("bids"), F.col("asks"))).collect()} == {"ok", "one side"}
    ok = book_features(df.where("id = 'ok'")).first()
    assert (ok.mid, ok.spread, ok.bid_size, ok.ask_size) == (pytest.approx(100.05), pytest.approx(0.1), 3.0, 7.0)
    assert (ok.bid_depth_10bps, ok.ask_depth_10bps, ok.bid_depth_50bps, ok.ask_depth_50bps) == (1.0, 3.0, 3.0, 3.0)
    assert book_features(df.where("id = 'one side'")).first().bid_depth_10bps is None


def test_option_names(spark):
    names = ["BTC-27MAR26-50000-C", "ETH-3APR26-2500.5-P", "BTC-99XXX26-1-C", "BTC-PERPETUAL", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = df.select(*[c.alias(n) for n, c in X.option_parts(F.col("name")).items()]).collect()
    assert (got[0].underlying, str(got[0].expiry), got[0].strike, got[0].option_type) == ("BTC", "2026-03-27", 50000.0, "C")
    assert (str(got[1].expiry), got[1].strike) == ("2026-04-03", 2500.5)
    assert got[2].expiry is None and got[3].underlying is None and got[4].strike is None


def test_gaps_and_islands(spark):
    df = spark.createDataFrame([("B", at(m)) for m in (0, 1, 4, 5, 9)], "symbol string, ts timestamp_ntz")
    got = [(r.gap_start, r.gap_end, r.missing_steps) for r in G.missing_ranges(df, ["symbol"], "ts", 60).orderBy("gap_start").collect()]
    assert got == [(at(2), at(3), 2), (at(6), at(8), 3)]
    label = df.withColumn("label", F.lit("x"))
    assert [(r.interval_start, r.steps) for r in G.islands(label, ["symbol"], "ts", "label", 60).orderBy("interval_start").collect()] == [(at(0), 2), (at(4), 2), (at(9), 1)]
    classes = spark.createDataFrame([(True, None, None), (None, True, None), (None, None, True), (None, False, None)], "o boolean, e boolean, g boolean")
    names = [r[0] for r in classes.select(G.classify(F.col("o"), F.col("e"), F.col("g"))).collect()]
    assert names == ["observed", "confirmed_empty", "expected_provider_gap", "unverified"]
    assert [G.STATUS[n] for n in names][-1] == "RECONCILE_REQUIRED"
    assert fixed_grid(spark, "2026-01-01 00:00:00", "2026-01-01 01:00:00", 60, "ts").count() == 61


def test_delta_and_versions(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "n"), (4, "same")], "id long, v string")
    b = spark.createDataFrame([(2, "n"), (3, None), (4, "same"), (5, "gone")], "id long, v string")
    assert {r.id: r.action for r in S.delta(a, b, ["id"], ["v"]).collect()} == {1: "insert", 2: "update", 3: "update", 4: "unchanged", 5: "delete"}
    base = {"join_policy": "left", "sources": ["a", "b"], "columns": ["x", "y"], "data_hash": "1"}
    cases = {"none": {}, "patch": {"data_hash": "2"}, "minor": {"columns": ["x", "y", "z"]}, "major": {"columns": ["y", "x"]}}
    cases = [(want, base | change) for want, change in cases.items()] + [
        (want, base | c) for want, c in (("major", {"sources": ["a"]}), ("minor", {"sources": ["a", "b", "c"]}), ("major", {"join_policy": "inner"}), ("major", {"columns": ["x"]}), ("major", {"columns": None}))]
    row = lambda c: c and (c["join_policy"], c["sources"], c["columns"], c["data_hash"])
    contract = "struct<join_policy: string, sources: array<string>, columns: array<string>, data_hash: string>"
    df = spark.createDataFrame([("1.4.2", row(base), row(after), want) for want, after in cases] + [(None, None, row(base), "major")], f"version string, before {contract}, after {contract}, want string")
    got = df.withColumn("bump", S.version_bump(F.col("before"), F.col("after"))).withColumn("next", S.bumped(F.col("version"), F.col("bump"))).collect()
    assert [r.bump for r in got] == [r.want for r in got]
    assert {(r.bump, r.next) for r in got} == {("major", "2.0.0"), ("minor", "1.5.0"), ("patch", "1.4.3"), ("none", "1.4.2"), ("major", "1.0.0")}


def test_contracts_and_gold(spark):
    assert set(POLICY) == set(COLUMNS)
    assert all(required for required, _ in GOLD.values())
    candle = "open_time timestamp_ntz, exchange string, symbol string, open_price double, high_price double, low_price double, close_price double, volume double, quote_volume double, trade_count long, ingested_at timestamp_ntz"
    rows = [(at(m), "d", "B", 100.0 + m, 101.0 + m, 99.0 + m, 100.5 + m, 1.0, 100.0, 3, at(m)) for m in range(0, 12, 2)]
    perps = silver.ohlcv(spark.createDataFrame(rows + [(at(1), "d", "B", 1.0, 0.5, 0.4, 1.0, 1.0, 1.0, 1, at(1))], candle))
    spot = silver.ohlcv(spark.createDataFrame([(at(m + 1), *r[1:]) for m, r in zip(range(0, 6, 2), rows)], candle))
    assert missing_columns(perps, "ohlcv") == []
    core = gold.build("market.core", {"spot_ohlcv": spot, "perps_ohlcv": perps})
    got = core.orderBy("timestamp_m1").collect()
    assert len(got) == 11 and [r.perps_ohlcv_available for r in got] == [m % 2 == 0 for m in range(11)]
    assert gold.build("market.core", {"spot_ohlcv": spot, "perps_ohlcv": perps}, 300).count() == 3
    with pytest.raises(KeyError):
        gold.build("market.core", {"spot_ohlcv": spot})
    rv = silver.realized_volatility_feature(spot, perps)
    assert rv.columns == COLUMNS["realized_volatility_1m_feature"] and {r.canonical_rv_source for r in rv.collect()} == {"perps"}
    strategy = gold.with_strategy_features(core.withColumn("rv_1h", F.lit(0.1)))
    assert strategy.count() == 11 and "half_life" in strategy.columns
    labels = gold.with_targets(core.withColumns({c: F.lit(0.1) for c in ("rv_1h", "iv_minus_rv_1h", "iv_rv_zscore_1d", "funding_rate_last_known")}))
    assert labels.where("target_forward_return_1h IS NOT NULL").count() == 0


def test_other_silver_builders(spark):
    oi = spark.createDataFrame([("d", "b", at(0, 30), 5.0, at(1)), ("d", "b", at(0, 30), 5.0, at(2)), ("d", "b", at(3), -1.0, at(3)), ("d", "b", at(4), 6.0, at(4))],
                               "exchange string, symbol string, open_time timestamp_ntz, open_interest double, ingested_at timestamp_ntz")
    seen = silver.open_interest_observed(oi)
    assert seen.count() == 2
    feature = silver.open_interest_feature(seen).orderBy("timestamp_m1").collect()
    assert [r.open_interest for r in feature] == [5.0] * 4 + [6.0] and feature[1].open_interest_is_ffill
    old = spark.createDataFrame([("d", "b", at(0), 40.0, at(1)), ("d", "b", at(1), 41.0, at(1))], "exchange string, symbol string, open_time timestamp_ntz, value double, ingested_at timestamp_ntz")
    new = spark.createDataFrame([("d", "b", at(0), 50.0, 52.0, 49.0, 51.0, at(0))], "exchange string, symbol string, open_time timestamp_ntz, open double, high double, low double, close double, ingested_at timestamp_ntz")
    vol = silver.volatility_observed(new, old)
    assert [r.volatility_close for r in vol.orderBy("timestamp").collect()] == [51.0, 41.0]
    both = silver.iv_rv_feature(silver.volatility_feature(vol), spark.createDataFrame([("d", "B", at(1), 1.0, 2.0, None)], "exchange string, symbol string, timestamp_m1 timestamp_ntz, rv_1h double, rv_1d double, rv_30d_annualized_pct double"))
    assert [r.iv_minus_rv_1h for r in both.orderBy("timestamp_m1").collect()] == [None, 40.0]
    price = spark.createDataFrame([("d", "B", at(0, 10), 10.0), ("d", "B", at(2), 0.0), ("d", "B", at(3), 12.0)], "exchange string, symbol string, timestamp timestamp_ntz, index_price double")
    assert [r.index_price for r in silver.index_price_feature(price).orderBy("timestamp_m1").collect()] == [10.0, 10.0, 10.0, 12.0]
    fut = spark.createDataFrame([("d", "B", at(0), 11.0, 10.0, 1.0, 2.0, 3.0, None), ("d", "B", at(2), 9.0, 0.0, 1.0, 2.0, 3.0, 0.1)], "exchange string, symbol string, timestamp timestamp_ntz, mark_price double, index_price double, open_interest double, volume double, turnover double, funding_rate double")
    assert [r.mark_index_ratio for r in silver.futures_summary_feature(fut).orderBy("timestamp_m1").collect()] == [1.1, 1.1, None]
    option = "exchange string, instrument_name string, timestamp timestamp_ntz, ingested_at timestamp_ntz, implied_volatility double, strike double, underlying_price double, expiry date, option_type string, bid_price double, ask_price double"
    q = lambda iv, name, sec=0: ("d", name, at(0, sec), at(0, sec + 5), iv, 100.0, 100.0, datetime(2026, 1, 5).date(), "C", 1.0, 2.0)
    surface = silver.option_surface_feature(spark.createDataFrame([q(0.5, "a"), q(0.7, "b")], option), spark.createDataFrame([q(0.6, "a"), q(0.8, "a", 30)], option)).first()
    assert (surface.atm_iv, surface.short_dated_iv, surface.contract_count, surface.fresh_quote_count) == (pytest.approx(0.75), pytest.approx(0.75), 2, 2)
    grid = spark.createDataFrame([("d", "B", at(i), 100.0 + i, 101.0 + i, 5.0 + i, 0.01, 3.0, 1.0, 4, 10.0, 1.0, 1.0, 2, 5.0) for i in range(70)],
                                 "exchange string, symbol string, timestamp_m1 timestamp_ntz, spot_close double, perps_close double, open_interest double, funding_rate double, perps_buy_volume double, perps_sell_volume double, perps_trade_count long, perps_quote_volume double, options_buy_volume double, options_sell_volume double, options_trade_count long, options_quote_volume double")
    hp = silver.historical_prediction_feature(grid).orderBy("timestamp_m1").collect()
    assert hp[0].historical_prediction_perps_rv_15m is None and hp[5].historical_prediction_leverage_build_up_signal == 1
    assert hp[5].historical_prediction_perps_trade_imbalance == 0.5
    book = spark.createDataFrame([("d", "B", "i", at(0, s), at(0, s + 2), [(100.0, 1.0)], [(101.0 + s, 3.0)]) for s in (10, 50)],
                                 "exchange string, symbol string, instrument_name string, event_time timestamp_ntz, ingested_at timestamp_ntz, bids array<struct<price: double, amount: double>>, asks array<struct<price: double, amount: double>>")
    l2 = silver.l2_feature(silver.l2_observed(book)).first()
    assert (l2.spread, l2.top_of_book_imbalance, l2.quote_age_seconds, l2.stale_quote) == (51.0, -0.5, 2.0, False)
    meta = spark.createDataFrame([("option", 1.0, 1.0, 5.0, at(0), "C"), ("option", 1.0, 1.0, None, at(0), "C"), ("future", 1.0, 1.0, None, None, None), ("spot", 0.0, 1.0, None, None, None), ("spot", 1.0, 1.0, None, None, None)],
                                 "instrument_type string, tick_size double, contract_size double, strike double, expiry timestamp_ntz, option_type string")
    assert [r[0] for r in meta.select(valid_metadata()).collect()] == [True, False, False, False, True]


def test_digests_tell_types_apart_and_refuse(spark):
    rows = spark.createDataFrame([(1, 1, "1", 1.0, True, 0.0), (2, 1, "1", 1.0, True, -0.0)], "id long, i int, s string, f double, b boolean, z double")
    named = rows.select("id", *[F.struct(F.col(c).alias("x")).alias(c) for c in ("i", "s", "f", "b", "z")])
    each = [named.select("id", f"{c}.x").select(S.row_digest(named.select(f"{c}.x"), ["x"]).alias("d"), "id").orderBy("id").collect() for c in ("i", "s", "f", "b", "z")]
    assert len({e[0].d for e in each}) == 5 and each[4][0].d == each[4][1].d
    bad = spark.createDataFrame([(1, float("nan"))], "id long, f double")
    with pytest.raises(Exception, match="finite"):
        S.delta(bad, bad, ["id"], ["f"]).collect()
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id long, s string")
    with pytest.raises(Exception, match="repeats"):
        S.delta(twice, twice.limit(1), ["id"], ["s"]).collect()


def test_book_masks(spark):
    from tidemark.operators.book import quality_mask

    level = "array<struct<price: double, amount: double>>"
    df = book_features(spark.createDataFrame([("ok", [(100.0, 1.0)], [(100.1, 3.0)]), ("one side", [], [(101.0, 1.0)])], f"id string, bids {level}, asks {level}"))
    assert [r.id for r in quality_mask(df).collect()] == ["ok"]
    with pytest.raises(Exception, match="unusable"):
        quality_mask(df, strict=True).collect()


def test_gold_shares_are_made_of_sums(spark):
    rows = [("B", at(0), 10.0, 9.0, 0.9), ("B", at(1), 100.0, 10.0, 0.1)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, perps_trades_volume double, perps_trades_buy_volume double, perps_trades_buy_volume_share double")
    assert resample(df, ["symbol"], "ts", 300).first().perps_trades_buy_volume_share == pytest.approx(19 / 110)


def test_surfaces_of_underlyings_do_not_mix(spark):
    option = "exchange string, instrument_name string, timestamp timestamp_ntz, ingested_at timestamp_ntz, implied_volatility double, strike double, underlying_price double, expiry date, option_type string, bid_price double, ask_price double"
    q = lambda iv, name: ("d", name, at(0), at(0, 5), iv, 100.0, 100.0, datetime(2026, 1, 5).date(), "C", 1.0, 2.0)
    df = spark.createDataFrame([q(0.5, "BTC-27MAR26-100-C"), q(0.9, "ETH-27MAR26-100-C")], option)
    assert {r.symbol: r.atm_iv for r in silver.option_surface_feature(df, df.limit(0)).collect()} == {"BTC": 0.5, "ETH": 0.9}


def test_exponential_means_fade_over_gaps(spark):
    rows = [("B", at(i), p) for i, p in enumerate((1.0, None, 4.0, None, None, 2.0))]
    got = T.ema(spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, p double"), ["symbol"], "ts", "p", (3,)).orderBy("ts").collect()
    second = (0.25 * 1 + 0.5 * 4) / 0.75
    near([r.ema_3 for r in got], [1.0, None, second, None, None, (0.125 * second + 0.5 * 2) / 0.625])


def test_rolling_moments_match_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = [(s, at(rng.randrange(6000)), None if rng.random() < 0.2 else rng.choice([5.0, 5.0, rng.random() * 1e3])) for s in "AB" for _ in range(300)] + [("A", None, 3.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, x double")
    from tidemark.functions.windows import rolling

    spans = {"s": 600, "m": 7200, "d": 2 * 86_400}
    got = rolling(df, ["symbol"], "ts", {"v": F.col("x")}, spans).collect()
    assert len(got) == len(rows)
    for r in got:
        for name, seconds in spans.items():
            if r.ts is None:
                continue
            xs = [x for s, t, x in rows if s == r.symbol and t is not None and x is not None and r.ts - timedelta(seconds=seconds) < t <= r.ts]
            w = r[f"v_{name}"]
            assert w.n == len(xs)
            mean = sum(xs) / len(xs) if xs else None
            std = math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) if len(xs) > 1 else None
            near([w.total, w.mean], [sum(xs) if xs else None, mean], 1e-9)
            assert (w.std is None) == (std is None) and (std is None or abs(w.std - std) < 1e-11 * max(1, std)) and (len(set(xs)) != 1 or not w.std)


@pytest.mark.parametrize("spike", [1e3, 1e8, 1e12])
def test_a_spike_leaves_no_trace_in_later_windows(spark, spike):
    import random

    from tidemark.functions.windows import rolling

    rng = random.Random(8)
    rows = [(at(m), 1 + rng.uniform(-0.01, 0.01)) for m in range(1440) if rng.random() < 0.9]
    rows[200] = rows[200][0], spike
    rows[700:800] = [(t, 0.1) for t, _ in rows[700:800]]
    spans = {"h": 3600, "q": 4 * 3600, "d": 86_400}
    got = rolling(spark.createDataFrame(rows, "ts timestamp_ntz, x double"), [], "ts", {"v": F.col("x")}, spans).orderBy("ts").collect()
    for i, r in enumerate(got):
        for name, seconds in spans.items():
            xs = [x for t, x in rows[: i + 1] if r.ts - timedelta(seconds=seconds) < t]
            mean = math.fsum(xs) / len(xs)
            w = r[f"v_{name}"]
            assert w.n == len(xs) and abs(w.mean - mean) <= 1e-12 * abs(mean) and abs(w.total - math.fsum(xs)) <= 1e-12 * abs(w.total)
            if len(xs) > 1:
                std = math.sqrt(math.fsum((x - mean) ** 2 for x in xs) / (len(xs) - 1))
                assert w.std == 0 if len(set(xs)) == 1 else abs(w.std - std) <= 1e-9 * std


def test_rows_are_reached_across_blocks(spark, monkeypatch):
    from tidemark.functions import windows

    monkeypatch.setattr(windows, "BLOCK_ROWS", 4)
    rows = [(s, at(i * i), float(i)) for s in "AB" for i in range(50)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, x double")
    out = windows.over_rows(df, ["symbol"], "ts", lambda w: {"a": F.lag("x", 3).over(w), "b": F.lead("x", 2).over(w)}, back=3, ahead=2).orderBy("symbol", "ts").collect()
    assert [(r.a, r.b) for r in out] == [(i - 3.0 if i > 2 else None, i + 2.0 if i < 48 else None) for i in range(50)] * 2


def test_recent_trades_and_metadata(spark):
    when, later = at(0), at(1)
    row = lambda name, kind, i, price, snap, side: ("D", "f", name, kind, i, when, snap, snap, price, 2.0, side)
    cols = "exchange string, source string, instrument_name string, instrument_type string, trade_id string, exchange_timestamp timestamp_ntz, snapshot_time timestamp_ntz, ingested_at timestamp_ntz, price double, amount double, direction string"
    rows = [row("BTC-PERPETUAL", "perp", "known-1", 100.0, when, "buy"), row("BTC-PERPETUAL", "perp", "known-1", 101.0, later, "buy"),
            row("BTC-19JUN26-65000-C", "option", None, 0.1, when, "sell"), row("BTC-19JUN26-65000-C", "option", None, 0.1, later, "sell"),
            row("BTC-19JUN26-65000-C", "option", None, -1.0, later, "sell"), row("BTC-BAD", "option", "x", 1.0, later, "?")]
    got = silver.recent_trades_observed(spark.createDataFrame(rows, cols)).orderBy("instrument_name").collect()
    assert [(r.instrument_name, r.price, r.trade_id_is_source, r.snapshot_timestamp, r.strike, r.side) for r in got] == [
        ("BTC-19JUN26-65000-C", 0.1, False, later, 65000.0, "sell"), ("BTC-PERPETUAL", 101.0, True, later, None, "buy")]
    assert got[0].deduplication_key.startswith("fallback:|d|BTC-19JUN26-65000-C|") and got[1].deduplication_key == "id:known-1"
    assert got[0].asDict().keys() == dict.fromkeys(COLUMNS["recent_trade_observed"]).keys()


def test_live_tables(spark):
    """Snapshots of many instruments become one row a minute; observed minutes only, coarser forms too."""
    from tidemark.plans.contracts import _LIVE

    one = spark.createDataFrame([("d", "B", at(m), 10.0 + m, 11.0, 9.0, 12.0 + m, at(m)) for m in (0, 3)],
                                "exchange string, symbol string, timestamp timestamp_ntz, volatility_close double, index_price double, mark_price double, open_interest double, ingested_at timestamp_ntz")
    book = spark.createDataFrame([("d", "B", n, at(0), 99.0, 1.0, 101.0 + k, 3.0, at(0)) for k, n in enumerate("xy")],
                                 "exchange string, symbol string, instrument_name string, timestamp timestamp_ntz, best_bid_price double, best_bid_size double, best_ask_price double, best_ask_size double, ingested_at timestamp_ntz")
    quotes = spark.createDataFrame([("d", "B", n, at(0), iv, at(0)) for n, iv in (("x", 0.4), ("y", 0.6))], "exchange string, symbol string, instrument_name string, timestamp timestamp_ntz, implied_volatility double, ingested_at timestamp_ntz")
    sources = {s: quotes if "ticker" in s else book if "l2" in s else one for s in _LIVE}
    got = gold.build("live.extended", sources).orderBy("timestamp_m1").collect()
    assert [r.timestamp_m1 for r in got] == [at(0), at(3)]
    assert (got[0].options_l2_top_bid_depth, got[0].options_l2_median_spread, got[0].options_surface_atm_iv, got[0].options_surface_atm_iv_right) == (2.0, 2.5, 0.5, 0.5)
    assert (got[0].options_surface_contract_count, got[0].live_extended_options_surface_quote_fill_ratio, got[0].live_extended_options_surface_stale_quote_ratio) == (2, 0.0, 1.0)
    assert got[0].live_extended_options_l2_depth_imbalance_ratio == pytest.approx(-0.5)
    assert got[1].live_extended_futures_mark_price_mean_15m == 9.0 and got[1].live_extended_options_surface_skew_term_ratio is None
    assert gold.build("live.full", sources, 300).count() == 1


def test_gold_sources_have_their_contracted_columns(spark):
    from tidemark.plans.contracts import PREPARED

    perps = spark.createDataFrame([("d", "B", "p", at(0), 99.0, 101.0, 100.0, 2.0, 1.0, 3.0, 5.0, True, False, 3.0)],
        "exchange string, symbol string, instrument_name string, timestamp_m1 timestamp_ntz, best_bid_price double, best_ask_price double, mid_price double, spread double, top_bid_size double, top_ask_size double, bid_depth_10bps double, quote_available boolean, stale_quote boolean, quote_age_seconds double")
    got = gold.prepared("perps_l2_1m_feature", perps).first()
    assert got.__fields__ == [*gold.KEYS, *PREPARED["perps_l2_1m_feature"]] and len(got.__fields__) == 20
    assert (got.perps_l2_best_bid_price, got.perps_l2_spread, got.perps_l2_bid_depth_10bps, got.perps_l2_quote_available, got.perps_l2_stale_quote, got.perps_l2_quote_age_seconds) == (99.0, 2.0, 5.0, True, False, 3.0)
    assert got.perps_l2_as_of == at(0) and got.perps_l2_live_snapshot_derived and got.perps_l2_ask_depth_50bps is None
    raw = perps.withColumnsRenamed({"timestamp_m1": "timestamp", "top_bid_size": "best_bid_size", "top_ask_size": "best_ask_size"}).drop("mid_price", "spread", "quote_available", "stale_quote")
    got = gold.prepared("perps_l2_snapshot_1m_observed", raw.withColumn("ingested_at", F.lit(at(0, 7)))).first()
    assert (got.perps_l2_mid_price, got.perps_l2_spread, got.perps_l2_top_of_book_imbalance, got.perps_l2_quote_age_seconds, got.perps_l2_stale_quote) == (100.0, 2.0, -0.5, 7.0, False)
    options = perps.withColumn("instrument_name", F.lit("a")).unionByName(perps.withColumns({"instrument_name": F.lit("b"), "quote_available": F.lit(False), "stale_quote": F.lit(True), "top_bid_size": F.lit(6.0), "spread": F.lit(None).cast("double"), "quote_age_seconds": F.lit(4.0)}))
    got = gold.prepared("options_l2_1m_feature", options).first()
    assert (got.options_l2_contract_count, got.options_l2_quote_coverage_ratio, got.options_l2_stale_quote_ratio, got.options_l2_median_spread, got.options_l2_top_bid_depth,
            got.options_l2_bid_depth_10bps, got.options_l2_max_quote_age_seconds) == (2, 0.5, 0.5, 2.0, 7.0, 10.0, 4.0)
    quotes = spark.createDataFrame([("d", "B", n, at(0), iv, b, 2.0, 1.5, at(0, 9)) for n, iv, b in (("x", 0.4, 1.0), ("y", 0.6, 1.0), ("z", 0.5, None))],
        "exchange string, symbol string, instrument_name string, timestamp timestamp_ntz, implied_volatility double, bid_price double, ask_price double, mark_price double, ingested_at timestamp_ntz")
    got = gold.prepared("options_ticker_snapshot_1m_observed", quotes).first()
    assert (got.options_surface_atm_iv, got.options_surface_contract_count, got.options_surface_fresh_quote_count, got.options_surface_stale_quote_count, got.options_surface_max_quote_age_seconds) == (0.5, 3, 2, 1, 9.0)
    assert got.options_surface_quote_coverage_ratio == pytest.approx(2 / 3) and got.options_surface_skew is None
    ready = spark.createDataFrame([("d", "B", at(0), 0.5, 10, at(1)), ("d", "B", at(0), 0.55, 12, at(2))], "exchange string, symbol string, timestamp_m1 timestamp_ntz, options_surface_atm_iv double, options_surface_contract_count long, ingested_at timestamp_ntz")
    got = gold.prepared("options_ticker_snapshot_1m_observed", ready).collect()
    assert [(r.options_surface_atm_iv, r.options_surface_contract_count) for r in got] == [(0.55, 12)]
    hv = spark.createDataFrame([("d", "B", at(0), 55.0, at(0))], "exchange string, symbol string, timestamp timestamp_ntz, historical_volatility double, historical_volatility_source_timestamp timestamp_ntz")
    assert gold.prepared("historical_volatility_observed", hv).columns[3:] == ["historical_volatility_reference", "historical_volatility_source_timestamp", "historical_volatility_available"]


def test_gold_columns_do_not_depend_on_what_is_there(spark, monkeypatch):
    from tidemark.plans import contracts

    one = spark.createDataFrame([("d", "B", at(0), 1.0, "perps")], "exchange string, symbol string, timestamp_m1 timestamp_ntz, spread double, canonical_rv_source string")
    required, optional = contracts.GOLD["market.regime_features"]
    sources = dict.fromkeys(required, one)
    bare, full = gold.build("market.regime_features", sources), gold.build("market.regime_features", sources | {o: one.withColumn("instrument_name", F.lit("x")) for o in optional})
    assert bare.dtypes == full.dtypes
    assert bare.first().perps_l2_spread is None and full.first().perps_l2_spread == 1.0 and not bare.first().perps_l2_1m_feature_available
    assert {"canonical_rv_source", "canonical_rv_source_right"} <= set(bare.columns)
    monkeypatch.setitem(contracts.PREPARED, "funding_1m_feature", {"rv_1h": ("spread", "double")})
    with pytest.raises(ValueError, match="shares columns"):
        gold.build("market.regime_features", sources)


def test_ranks_equal_counting():
    import random
    import time

    import numpy as np

    from tidemark.functions.windows import Ranks

    rng = random.Random(4)
    for n, kinds in ((1, 1), (7, 2), (200, 5), (300, 1000)):
        x, w = np.array([float(rng.randrange(kinds)) for _ in range(n)]), np.array([rng.randrange(1, 4) for _ in range(n)])
        low = np.array([rng.randrange(n) for _ in range(50)])
        high = np.array([rng.randrange(a, n) + 1 for a in low])
        bound = x[[rng.randrange(n) for _ in range(50)]]
        want = [int(sum(w[i] for i in range(a, b) if x[i] <= c)) for a, b, c in zip(low, high, bound)]
        assert Ranks(x, w).at_most(low, high, bound).tolist() == want
    x = np.random.default_rng(1).random(200_000)
    at = np.arange(len(x))
    began = time.perf_counter()
    share = Ranks(x, np.ones(len(x), np.int64)).at_most(np.maximum(at - 100_000, 0), at + 1, x)  # windows of 100,000 rows
    assert time.perf_counter() - began < 5 and share[-1] == (x[-100_001:] <= x[-1]).sum()


@pytest.mark.parametrize("name", ["month_difference", "symbol_intersection", "anti_both_ways"])
def test_few_values_meet_as_values(spark, name):
    """Both sides of the join are made distinct below its exchange: no task gets the rows of a month or of a nation."""
    from tidemark.queries import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = QUERIES[name](spark, "/root/testdata/sf0.001")
        left, right, *_ = out._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1].split("FileScan")
        assert "HashAggregate" in left and "HashAggregate" in right
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_set_operations_hold_nulls_equal(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,)], "x int")
    b = spark.createDataFrame([(2,), (2,), (None,)], "x int")
    assert sorted(r.x for r in S.only_in(a, b).collect()) == [1, 3]
    assert [r.x for r in S.only_in(b, a).collect()] == []
    assert sorted(str(r.x) for r in S.in_both(a, b).collect()) == ["2", "None"]


def test_a_grid_is_made_by_many_tasks(spark):
    """Days are few bytes: adaptive execution must not merge them into one task."""
    df = spark.createDataFrame([("a", at(0)), ("a", at(40 * 1440))], "symbol string, ts timestamp_ntz")
    grid = span_grid(df, ["symbol"], "ts")
    assert grid.select(F.spark_partition_id().alias("p"), "symbol").distinct().count() > 1
    assert grid.count() == 40 * 1440 + 1
