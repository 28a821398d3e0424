import pytest

from tickloom.operators import alerts as rules

T0 = 1_704_067_200_000
NOW = T0 + 60_000


def _windows(spark, rows):
    """Rows ``(symbol_key, seconds, close, volume)``."""
    return spark.createDataFrame(
        [(s, T0 + t * 1000, c, v) for s, t, c, v in rows],
        "symbol_key int, window_start long, close double, volume double",
    ).selectExpr("symbol_key", "window_start", "cast(close as decimal(18,8)) as close",
                 "cast(volume as decimal(24,8)) as volume")


def _quotes(spark, rows):
    return spark.createDataFrame(
        [(s, T0 + t * 1000, x, q) for s, t, x, q in rows],
        "symbol_key int, snapshot_time long, spread double, q double",
    ).selectExpr("symbol_key", "snapshot_time", "cast(spread as decimal(18,8)) as spread",
                 "cast(q as decimal(24,8)) as bid_qty", "cast(0 as decimal(24,8)) as ask_qty")


def _got(df):
    return {r.symbol_key: (r.threshold_pct, r.severity) for r in df.collect()}


def test_spike_at_threshold_fires_and_edge_cases_do_not(spark):
    df = _windows(spark, [
        (1, 0, 100.0, 1.0), (1, 5, 101.0, 1.0),  # exactly 1 %
        (2, 0, 100.0, 1.0), (2, 50, 98.0, 1.0),  # 2 %, whatever the gap
        (3, 5, 100.0, 1.0),  # one window only
        (4, 0, 0.0, 1.0), (4, 5, 100.0, 1.0),  # previous close 0
        (5, 0, 100.0, 1.0), (5, 5, 100.9, 1.0),
        (6, 0, 100.0, 1.0), (6, 5, 150.0, 1.0), (6, 10, 150.0, 1.0),  # only the last two count
    ])
    want = {1: (1.0, "MEDIUM"), 2: (2.0, "HIGH")}
    assert _got(rules.price_spikes(df, NOW)) == want
    replay = {(r.symbol_key, r.triggered_at) for r in rules.price_spikes_replay(df).collect()}
    assert replay == {(1, T0 + 5000), (2, T0 + 50_000), (6, T0 + 5000)}


def test_as_of_ignores_later_rows_and_old_ones_on_request(spark):
    df = _windows(spark, [(1, 0, 100.0, 1.0), (1, 5, 110.0, 1.0), (1, 90, 110.0, 1.0)])
    assert _got(rules.price_spikes(df, NOW)) == {1: (10.0, "HIGH")}
    assert _got(rules.price_spikes(df, NOW, max_age_ms=10_000)) == {}


def test_surge_uses_an_average_that_includes_the_latest(spark):
    df = _windows(spark, [
        (1, 0, 1.0, 1.0), (1, 1, 1.0, 1.0), (1, 2, 1.0, 1.0), (1, 3, 1.0, 9.0),  # 9 / 3 = 3
        (2, 0, 1.0, 0.0), (2, 1, 1.0, 0.0),  # baseline 0
        *[(3, i, 1.0, 1.0) for i in range(9)], (3, 9, 1.0, 11.0),  # 11 / 2 = 5.5
    ])
    want = {1: (3.0, "MEDIUM"), 3: (5.5, "HIGH")}
    assert _got(rules.volume_surges(df, NOW)) == want
    assert _got(rules.volume_surges_replay(df)) == want


def test_baseline_span_includes_both_ends(spark):
    span = rules.DEFAULTS.surge_span_ms // 1000
    edge = [(1, 60 - span, 1.0, 1.0), (1, 61 - span, 1.0, 1.0), (1, 60, 1.0, 10.0)]
    assert _got(rules.volume_surges(_windows(spark, edge), NOW)) == {}  # 10 / 4
    outside = [(1, 59 - span, 1.0, 1.0), *edge[1:]]
    assert _got(rules.volume_surges(_windows(spark, outside), NOW)) == {}  # 10 / 5.5


def test_widening_and_liquidity(spark):
    df = _quotes(spark, [
        (1, 0, 1.0, 10.0), (1, 1, 1.0, 10.0), (1, 2, 1.0, 10.0), (1, 3, 3.0, 10.0),  # 3 / 1.5
        (2, 0, 1.0, 96.0), (2, 1, 1.0, 4.0),  # 8 %
        (3, 0, 1.0, 9.0), (3, 1, 1.0, 1.0),  # exactly 20 %: does not fire
    ])
    assert _got(rules.spread_widening(df, NOW)) == {1: (2.0, "MEDIUM")}
    assert _got(rules.low_liquidity(df, NOW)) == {2: (8.0, "LOW")}
    assert _got(rules.spread_widening_replay(df)) == {1: (2.0, "MEDIUM")}
    assert _got(rules.low_liquidity_replay(df)) == {2: (8.0, "LOW")}


@pytest.mark.parametrize("rule", [rules.price_spikes, rules.volume_surges])
def test_a_single_row_raises_nothing(spark, rule):
    assert rule(_windows(spark, [(1, 0, 1.0, 1.0)]), NOW).count() == 0


def test_polls_by_minute_sums_equal_polls_by_rows(spark, tmp_path):
    """Random rows over a day and a half, in batches with replays, late rows and silent symbols."""
    import random

    from pyspark.sql import functions as F

    from tickloom.functions import clock
    from tickloom.sources.tables import Tables
    from workload import inputs

    r = random.Random(11)
    tables = Tables(spark, root=str(tmp_path), calendar=inputs.CALENDAR)
    end = 36 * 3600

    def bars(rows):
        df = spark.createDataFrame(rows, "symbol_key int, window_key int, window_start long, close double, volume double")
        return df.withColumn("datetime_key", clock.datetime_key("window_start")).withColumns({
            "window_end": F.col("window_start") + 5000, "trade_count": F.lit(1), **{c: F.col("close") for c in ("open", "high", "low", "vwap")},
            **{c: F.lit(0) for c in ("price_change", "price_change_pct")}})

    def snaps(rows):
        df = spark.createDataFrame(rows, "symbol_key int, snapshot_time long, spread double, bid_qty double")
        return df.withColumn("datetime_key", clock.datetime_key("snapshot_time")).withColumns({
            "bid_price": F.lit(1), "ask_price": F.lit(2), "mid_price": F.lit(1.5), "spread_pct": F.lit(1), "ask_qty": F.col("bid_qty") / 3,
            "liquidity_imbalance": F.lit(0)})

    def times(s, lo, hi, n):  # symbol 5 stops after four hours, symbol 6 after 35
        stop = {5: 4 * 3600, 6: 35 * 3600}.get(s, hi)
        return [T0 + 5000 * r.randrange(lo // 5, max(lo + 5, min(hi, stop)) // 5) for _ in range(n if lo < stop else 0)]

    def batch(lo, hi, n):
        trades = {(s, w, t): (r.choice([100, 100.5, 103]), r.choice([1, 2, 50])) for s in range(1, 8) for w in (1, 2) for t in times(s, lo, hi, n)}
        quotes = {(s, t): (r.choice([1, 1, 9]), r.choice([1, 90, 900])) for s in range(1, 8) for t in times(s, lo, hi, n)}
        return bars([(*k, float(a), float(b)) for k, (a, b) in trades.items()]), snaps([(*k, float(a), float(b)) for k, (a, b) in quotes.items()])

    def store(pair):
        for name, df in zip(("trade_agg", "spread_snapshot"), pair, strict=True):
            tables.insert(df.persist(), name, unique=True)

    store(batch(0, 30 * 3600, 300))
    tables.keep_minutes()
    for lo in (30 * 3600, 35 * 3600 + 1800):
        pair = batch(lo, min(lo + 3 * 3600, end), 150)
        store(pair)
        store(pair)
    store(batch(28 * 3600, 29 * 3600, 40))  # late
    tables.append(batch(end - 600, end, 60)[1], "spread_snapshot")  # a bulk write
    limits = rules.Thresholds(spike_pct=0.1, surge_ratio=1.2, widening_ratio=1.1, liquidity_pct=80.0)
    fired = set()
    for as_of in (T0 + end * 1000 - 1_234, T0 + 29 * 3_600_000 + 59_999, T0 + 3 * 3_600_000, T0 - 1):
        rows, sums = (sorted(map(tuple, rules.detect_alerts(tables, as_of, limits, by_minutes=b).collect())) for b in (False, True))
        assert rows == sums, as_of
        fired |= {r[2] for r in rows}
    assert len(fired) == 4
    sums = tables.minute_sums("trade_agg", T0, T0 + end * 1000)
    direct = tables.fact("trade_agg").groupBy("symbol_key", "window_key", (clock.floor_div("window_start", 60_000) * 60_000).alias("minute")).agg(
        F.count("*").alias("n"), F.sum("volume").cast("decimal(38,8)").alias("volume"))
    assert sums.exceptAll(direct).isEmpty() and direct.exceptAll(sums).isEmpty()
