import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.numbers import exact_sum
from tickloom.operators import candles, quotes, trades
from tickloom.sources.dims import seed_dims
from workload import inputs

T0 = 1_704_067_200_000


def _trades(spark, rows):
    """Rows ``(symbol, id, price, quantity, maker, ms after T0)``."""
    full = [("trade", s, i, p, q, m, T0 + t, T0 + t) for s, i, p, q, m, t in rows]
    return trades.with_event_time(spark.createDataFrame(full, schemas.TRADE), "trade_time")


def test_ties_edges_and_single_trades(spark):
    df = _trades(spark, [
        ("BTCUSDT", 2, 20.0, 1.0, True, 10), ("BTCUSDT", 1, 10.0, 1.0, False, 10),
        ("BTCUSDT", 4, 40.0, 2.0, None, 999), ("BTCUSDT", 3, 30.0, 1.0, True, 999),
        ("BTCUSDT", 5, 50.0, 4.0, False, 1000),
    ])
    first, second = trades.ohlcv(df, "1 second").orderBy("window_start").collect()
    assert (first.open, first.high, first.low, first.close) == (10.0, 40.0, 10.0, 40.0)
    assert (first.window_start, first.window_end) == (T0, T0 + 1000)
    assert (float(first.volume), first.vwap, first.trade_count) == (5.0, 28.0, 4)
    assert (float(first.buy_volume), float(first.sell_volume)) == (1.0, 2.0)
    assert (first.buy_count, first.sell_count) == (1, 2)
    assert (second.open, second.close, second.vwap) == (50.0, 50.0, 50.0)


def test_order_flow_without_makers_is_even(spark):
    df = _trades(spark, [("BTCUSDT", 1, 1.0, 3.0, None, 0), ("ETHUSDT", 2, 1.0, 3.0, False, 0)])
    rows = trades.order_flow_fact(trades.ohlcv(df, "1 second"), seed_dims(spark)).orderBy(
        "symbol_key").collect()
    assert [float(r.buy_pct) for r in rows] == [50.0, 100.0]
    assert [float(r.net_flow) for r in rows] == [0.0, 3.0]


def test_unknown_symbols_and_window_lengths_are_dropped(spark):
    df = _trades(spark, [("XYZUSDT", 1, 1.0, 3.0, None, 0), ("ETHUSDT", 2, 1.0, 3.0, False, 0)])
    dims = seed_dims(spark)
    assert trades.trade_agg_fact(trades.ohlcv(df, "1 second"), dims).count() == 1
    assert trades.trade_agg_fact(trades.ohlcv(df, "7 seconds"), dims).count() == 0


def test_filters(spark):
    bad = [(None, 1, 1.0, 1.0), ("A", 2, None, 1.0), ("A", 3, 0.0, 1.0), ("A", 4, 1.0, None),
           ("A", 5, 1.0, -1.0)]
    rows = [(s, i, p, q, True, 0) for s, i, p, q in bad + [("A", 6, 1.0, 1.0)]]
    assert [r.trade_id for r in trades.valid_trades(_trades(spark, rows)).collect()] == [6]
    k = spark.createDataFrame(
        [("A", True, 1.0, 0.0), ("A", False, 1.0, 1.0), ("A", None, 1.0, 1.0),
         (None, True, 1.0, 1.0), ("A", True, 0.0, 1.0), ("A", True, 1.0, -1.0)],
        "symbol string, is_closed boolean, close double, volume double",
    )
    assert candles.closed_klines(k).count() == 1


def test_rollup_equals_direct_aggregation_and_bounds_hold(spark, sf):
    direct = inputs.windows_5s(spark, sf)
    rolled = trades.rollup(inputs.windows_1s(spark, sf), 5_000)
    assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0
    bad = direct.filter(
        "low > least(open, close, vwap + 1e-9) or high < greatest(open, close, vwap - 1e-9)"
        " or buy_volume + sell_volume > volume"
    )
    assert bad.count() == 0


def test_result_does_not_depend_on_partitioning(spark, sf):
    ticks = trades.valid_trades(inputs.raw_trades(spark, sf))
    one, many = (
        trades.ohlcv(trades.with_event_time(df, "trade_time"), "5 seconds")
        for df in (ticks.coalesce(1), ticks.repartition(7))
    )
    assert one.exceptAll(many).count() == 0


def test_crossed_books_go_after_averaging(spark):
    rows = [
        ("BTCUSDT", 10.0, 1.0, 9.0, 1.0, 0), ("BTCUSDT", 10.0, 1.0, 13.0, 3.0, 500),  # mean 11
        ("ETHUSDT", 10.0, 1.0, 9.0, 1.0, 0), ("ETHUSDT", 10.0, 1.0, 10.5, 1.0, 500),  # crossed
        ("BNBUSDT", 10.0, 0.0, 11.0, 0.0, 0),
    ]
    full = [("bookticker", s, b, bq, a, aq, T0 + t) for s, b, bq, a, aq, t in rows]
    df = trades.with_event_time(spark.createDataFrame(full, schemas.BOOKTICKER), "ingested_at")
    got = quotes.spread_fact(quotes.spread_snapshot(df), seed_dims(spark)).orderBy("symbol_key")
    btc, bnb = got.collect()
    assert (float(btc.spread), float(btc.mid_price)) == (1.0, 10.5)
    assert float(btc.spread_pct) == pytest.approx(9.523810)
    assert float(btc.liquidity_imbalance) == pytest.approx(-0.333333)
    assert float(bnb.liquidity_imbalance) == 0.0


def test_joins_with_dims_do_not_shuffle_or_use_udfs(spark, sf):
    plan = inputs.fact(spark, sf, "trade_agg")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_tiny_trades_keep_their_amounts(spark):
    df = _trades(spark, [
        ("BTCUSDT", 1, 0.00001234, 0.001, True, 0), ("ETHUSDT", 2, 0.00001, 1e-9, True, 0),
        ("ETHUSDT", 3, 0.00003, 1e-9, True, 1), ("BNBUSDT", 4, 1e9, 1e9, True, 0),
    ])
    rows = {r.symbol: r for r in trades.ohlcv(df, "1 second").collect()}
    assert rows["BTCUSDT"].vwap == pytest.approx(0.00001234, rel=1e-12)
    assert rows["ETHUSDT"].vwap == pytest.approx(0.00002, rel=1e-12)
    assert float(rows["ETHUSDT"].volume) == 2e-9 and float(rows["BNBUSDT"].notional) == 1e18


def test_outliers_fit_the_fact(spark):
    df = _trades(spark, [("BTCUSDT", 1, 1e-4, 1.0, True, 0), ("BTCUSDT", 2, 1e6, 1.0, True, 1)])
    row = trades.trade_agg_fact(trades.ohlcv(df, "1 second"), seed_dims(spark)).first()
    assert float(row.price_change_pct) == pytest.approx(1e12, rel=1e-6)


ODD_NUMBERS = [None, float("nan"), float("inf"), float("-inf"), -1.0, 0.0, 1e-300, 1.0, 9.9e9, 1e10, 9.9e15, 1e16, 1e19, 1e300]


def test_filters_keep_exactly_what_has_no_reason(spark):
    from tickloom.operators import candles, rejects

    pairs = [(s, a, b) for s in ("X", None) for a in ODD_NUMBERS for b in ODD_NUMBERS]
    df = spark.createDataFrame(pairs, "symbol string, a double, b double").withColumn("is_closed", F.lit(True))
    shapes = {
        "trades": (trades.valid_trades, {"price": "a", "quantity": "b"}),
        "quotes": (quotes.valid_quotes, {"bid_price": "a", "ask_price": "b", "bid_qty": "a", "ask_qty": "b"}),
        "klines": (candles.closed_klines, {"close": "a", "volume": "b", "open": "b", "high": "a", "low": "b"}),
    }
    for kind, (keep, columns) in shapes.items():
        rows = df.withColumns({c: F.col(v) for c, v in columns.items()})
        kept, refused = keep(rows).count(), rejects.rejected(rows, kind)
        assert 0 < kept == len(pairs) - refused.count(), kind
        assert refused.join(keep(rows), ["symbol", "a", "b"], "left_semi").isEmpty(), kind


def test_sums_beyond_all_amounts_are_set_aside(spark, tmp_path):
    """Good trades whose window is too large to store, and a ratio to almost nothing."""
    from tickloom.sources.dims import seed_dims
    from tickloom.sources.tables import Tables
    from tickloom.streaming import sinks
    from workload import inputs

    t0 = 1_704_067_200_000
    rows = [("BTCUSDT", 1e-7, 9e15, t0 + k) for k in range(9)] + [("ETHUSDT", 1e-8, 1.0, t0), ("ETHUSDT", 9e9, 1.0, t0 + 1), ("BNBUSDT", 5.0, 2.0, t0)]
    rows += [("SOLUSDT", 9e9, 1e8 - 1, t0 + k) for k in range(20)]
    df = spark.createDataFrame(rows, "symbol string, price double, quantity double, trade_time long").withColumns(
        {"trade_id": F.col("trade_time"), "buyer_maker": F.lit(True)})
    bars = trades.ohlcv(trades.with_event_time(trades.valid_trades(df), "trade_time"), "5 seconds")
    tables = Tables(spark, root=str(tmp_path), calendar=inputs.CALENDAR)
    for _ in range(2):  # a replay adds nothing
        sinks.trades_batch(tables)(bars, 0)
    stored = {r.symbol_key: r for r in tables.fact("trade_agg").collect()}
    names = {r.symbol: r.symbol_key for r in seed_dims(spark)["symbol"].collect()}
    assert set(stored) == {names["BNBUSDT"], names["SOLUSDT"]}
    found = {r.row.split('"symbol_key":')[1].split(",")[0]: r.reason for r in tables.rejects("trade_agg").collect()}
    assert found == {str(names["BTCUSDT"]): "volume out of range", str(names["ETHUSDT"]): "price_change_pct out of range"}
    sums = spark.createDataFrame([(float("nan"),), (1.0,)], "x double").agg(exact_sum("x")).first()[0]
    assert sums is None
    assert spark.createDataFrame([(9e17,)] * 20, "x double").agg(exact_sum("x")).first()[0] is None
