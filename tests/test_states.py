import random

import pytest
from pyspark.sql import functions as F

from tickloom.plans import marts, states
from tickloom.schemas import FACTS
from tickloom.sources.tables import Tables
from workload import inputs

T0, HOUR, DAY = 1_704_067_200_000, 3_600_000, 86_400_000


def _rows(spark, name, rows):
    types = {f.name: f.dataType for f in FACTS[name].schema}
    df = spark.createDataFrame(rows)
    return df.select(*[(F.col(c) if c in df.columns else F.lit(0)).cast(t).alias(c) for c, t in types.items()])


def _quotes(spark, rng, n, low, high):
    return _rows(spark, "spread_snapshot", [
        {"symbol_key": 1 + rng.randrange(3), "datetime_key": 202401010000, "snapshot_time": t,
         "spread": rng.choice([0.0, 0.01, 1.5]), "spread_pct": rng.random(), "bid_qty": rng.random() * 9,
         "ask_qty": rng.random() * 9, "liquidity_imbalance": rng.random() - 0.5}
        for t in rng.sample(range(low, high), n)])


def _candles(spark, rng, days):
    return _rows(spark, "kline_closed", [
        {"symbol_key": s, "datetime_key": 202401010000, "interval_key": 1, "open_time": T0 + d * DAY + m * 60_000,
         "open": rng.random() + 1, "high": 3 + rng.random(), "low": rng.random(), "close": rng.random() + 1,
         "volume": rng.random() * 1e6, "trade_count": rng.randrange(9), "amplitude": rng.random(),
         "is_bullish": rng.random() < 0.5}
        for d in days for s in (1, 2) for m in rng.sample(range(1440), 5)])


@pytest.fixture()
def tables(spark, tmp_path):
    return Tables(spark, root=str(tmp_path), calendar=inputs.CALENDAR)


def _same(a, b):
    got, want = ([tuple(r) for r in df.collect()] for df in (a, b))
    assert got == want and got


def test_daily_performance_reads_days_that_changed(spark, tables, monkeypatch):
    rng, summed, real = random.Random(5), [], states._sum_days
    monkeypatch.setattr(states, "_sum_days", lambda t, s, v: summed.append([d.day - 1 for d in v]) or real(t, s, v))
    as_of = T0 + 12 * DAY + 7 * HOUR
    assert marts.daily_performance_by_day(tables, as_of).count() == 0  # no fact yet
    tables.append(_candles(spark, rng, [0, *range(5, 13)]), "kline_closed")
    for _ in range(2):
        _same(marts.daily_performance_by_day(tables, as_of, 10), marts.mart_daily_performance(tables, as_of, 10))
    assert sorted(summed.pop()) == list(range(5, 13)) and not summed
    tables.insert(_candles(spark, rng, [7, 12]), "kline_closed")
    _same(marts.daily_performance_by_day(tables, as_of, 10), marts.mart_daily_performance(tables, as_of, 10))
    assert sorted(summed.pop()) == [7, 12] and not summed
    tables.compact("kline_closed", tables.days("kline_closed")[3])  # another version, the same rows
    _same(marts.daily_performance_by_day(tables, as_of), marts.mart_daily_performance(tables, as_of))
    assert sorted(summed.pop()) == [0, 7]
    assert states.vacuum(tables, marts.DAYS) == 0 and states.vacuum(tables, marts.DAYS, 0) == 3
    _same(marts.daily_performance_by_day(tables, as_of), marts.mart_daily_performance(tables, as_of))
    assert not summed


def test_sessions_equal_the_full_form_wherever_the_span_begins(spark, tables):
    rng = random.Random(6)
    tables.append(_quotes(spark, rng, 900, T0 + 2 * DAY, T0 + 5 * DAY), "spread_snapshot")
    edge = T0 + 3 * DAY + HOUR
    tables.insert(_rows(spark, "spread_snapshot", [
        {"symbol_key": 1, "datetime_key": 202401010000, "snapshot_time": t, "spread": 9.0, "spread_pct": 9.0,
         "bid_qty": 1.0, "ask_qty": 1.0, "liquidity_imbalance": 0.0} for t in (edge - 1, edge, edge + 1)]), "spread_snapshot")
    for since in (edge - 1, edge, edge + 1, edge + 1_234_567):
        as_of = since + DAY
        _same(marts.spread_by_session_by_day(tables, as_of), marts.mart_spread_by_session(tables, as_of))
    assert marts.spread_by_session_by_day(tables, T0 + 20 * DAY).count() == 0


def test_catalogs_that_keep_no_states(spark, tables):
    assert states.kept(tables)
    assert not states.kept(Tables(spark, facts={"kline_closed": spark.range(0)}))
