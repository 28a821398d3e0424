import json

import pytest

from tickloom.plans import marts, quality, serving
from tickloom.sources.tables import Tables
from tickloom.streaming.progress import parse_progress, progress_alerts
from workload import inputs

T0 = 1_704_067_200_000


@pytest.fixture(scope="module")
def tables(spark, sf):
    return inputs.tables(spark, sf)


@pytest.mark.parametrize("call", [
    lambda t: serving.price_history(t, "BTCUSDT", "2s"),
    lambda t: serving.price_history(t, "BTCUSDT", "1s", 0),
    lambda t: serving.price_history(t, "BTCUSDT", "1s", 1441),
    lambda t: serving.orderflow_history(t, "BTCUSDT", 301),
    lambda t: serving.technical(t, "BTCUSDT", 201),
    lambda t: serving.alerts(t, 0, limit=501),
    lambda t: serving.alerts(t, 0, severity="low"),
    lambda t: serving.spread_history(t, "BTCUSDT", 0),
])
def test_arguments_are_checked(tables, call):
    with pytest.raises(ValueError):
        call(tables)


def test_symbols_are_upper_cased_and_unknown_ones_not_found(tables):
    assert serving.require_rows(serving.price_history(tables, "btcusdt"), "btcusdt").count() > 0
    with pytest.raises(LookupError):
        serving.require_rows(serving.price_history(tables, "nope"), "nope")


def test_history_is_oldest_first_and_limited(tables):
    rows = serving.price_history(tables, "BTCUSDT", "1s", 7).collect()
    times = [r.window_start for r in rows]
    assert len(rows) == 7 and times == sorted(times)
    newest = [r.open_time for r in serving.technical(tables, "BTCUSDT", 5).collect()]
    assert newest == sorted(newest, reverse=True)


def test_one_symbol_query_filters_in_the_scan(tables):
    plan = serving.price_history(tables, "BTCUSDT")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan or "Limit" in plan
    assert "SortMergeJoin" not in plan and "Subquery" in plan


def test_as_of_lookup_broadcasts_only_after_its_check(spark, sf, tables, monkeypatch):
    plan = serving.latest_prices(tables)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    wide = Tables(spark, root=tables.root, calendar=tables.calendar)
    wide.__dict__["few_symbols"] = False
    a, b = serving.latest_prices(tables), serving.latest_prices(wide)
    assert a.exceptAll(b).count() == 0 and a.count() == 8


def test_marts_are_published(spark, tables, sf):
    names = marts.refresh_marts(tables, inputs.CALENDAR_AS_OF)
    assert len(names) == 6
    kinds = {t.name: t.tableType for t in spark.catalog.listTables() if t.name in names}
    assert kinds["mart_daily_performance"] == "MANAGED"
    assert kinds["mart_latest_prices"] == "TEMPORARY"
    assert spark.table("mart_daily_performance").count() > 0
    detail = spark.sql("DESCRIBE EXTENDED mart_daily_performance").collect()
    assert any(r.col_name == "Statistics" and "rows" in r.data_type for r in detail)
    with pytest.raises(ValueError):
        marts.materialize(spark.range(1), "x", "cube")


# -- quality --------------------------------------------------------------------------------


def _facts(spark, **columns):
    base = {
        "symbol_key": "1", "datetime_key": "202401010000L", "window_key": "1",
        "window_start": f"{T0}L + id * 1000", "window_end": f"{T0}L + id * 1000 + 1000",
        "open": "1", "high": "1", "low": "1", "close": "1", "volume": "1", "vwap": "1",
        "trade_count": "1", "price_change": "0", "price_change_pct": "0", **columns,
    }
    return spark.range(20).selectExpr(*[f"{v} as {k}" for k, v in base.items()])


def _failures(spark, df):
    t = Tables(spark, facts={"trade_agg": df}, calendar=inputs.CALENDAR)
    rows = quality.run_checks(t, T0 + 3_600_000, ["trade_agg"]).collect()
    return {r.check.removeprefix("trade_agg."): r.failures for r in rows if r.failures}


@pytest.mark.parametrize("columns, want", [
    ({}, {}),
    ({"price_change_pct": "if(id = 3, null, 0)"}, {"price_change_pct.not_null": 1}),
    ({"window_start": f"{T0}L + (id div 2) * 1000"}, {"key.unique": 10}),
    ({"window_start": f"{T0}L + if(id = 1, 9000000, id) * 1000"}, {"window_start.not_future": 1}),
    ({"symbol_key": "if(id < 2, 99, 1)"}, {"symbol_key.references": 2}),
    ({"window_key": "if(id < 4, 3, 1)"}, {"window_key.references": 4}),
    ({"datetime_key": "if(id = 0, 202402010000L, 202401010000L)"}, {"datetime_key.references": 1}),
])
def test_suite_finds_each_fault_and_nothing_else(spark, columns, want):
    assert _failures(spark, _facts(spark, **columns)) == want


def test_ledger_reads_changed_days_only(spark, tmp_path, monkeypatch):
    t, read = Tables(spark, root=str(tmp_path), calendar=inputs.CALENDAR), []
    whole = quality._checked_days
    monkeypatch.setattr(quality, "_checked_days", lambda tables, fact, as_of, days: read.append(sorted(str(d) for d in days)) or whole(tables, fact, as_of, days))

    def both(as_of):
        read.clear()
        days = {tuple(r) for r in quality.run_checks_by_day(t, as_of, ["trade_agg", "order_flow"]).collect()}
        assert days == {tuple(r) for r in quality.run_checks(t, as_of, ["trade_agg", "order_flow"]).collect()}
        return list(read)

    day = 86_400_000
    assert both(T0) == []  # nothing is stored
    start = f"{T0}L + (id div 7) * {day}L + if(id % 7 = 6, 5, id % 7) * 1000"
    t.append(_facts(spark, window_start=start, symbol_key="if(id = 9, 99, 1)", price_change_pct="if(id = 3, null, 0)"), "trade_agg")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert both(T0 + 9 * day) == [days]
    assert both(T0 + 9 * day) == []
    assert both(T0 + 2 * day - 20_000) == [days[2:]]  # its rows are in the future now
    assert both(T0 + 2 * day - 10_000) == [days[2:]]
    assert both(T0 + 9 * day) == []
    t.append(_facts(spark, window_start=f"{T0 + day}L + id * 1000"), "trade_agg")
    assert both(T0 + 9 * day) == [days[1:2]]  # more copies of keys
    t.compact("trade_agg", t.days("trade_agg")[0])
    assert both(T0 + 9 * day) == [days[:1]]


def test_single_checks(spark):
    r = spark.createDataFrame([(101.0,), (-1.0,), (50.0,), (None,)], "rsi_14 double")
    assert quality.rsi_in_range(r).count() == 2
    s = spark.createDataFrame([(0.0,), (1.0,)], "spread double")
    assert quality.spread_positive(s).count() == 1
    v = spark.createDataFrame([("LOW",), ("low",), (None,)], "severity string")
    assert quality.check_accepted(v, "severity", quality.SEVERITIES).count() == 1


def test_rates_and_guards(spark):
    now = T0 + 20_000
    good = _facts(spark)
    bad = _facts(spark, vwap="if(id = 0, null, 1)", window_start=f"{T0}L + (id div 2) * 1000")
    quality.require_rate(quality.null_rate(good, ["vwap"], now), quality.NULL_RATE, "nulls")
    with pytest.raises(quality.QualityError):
        quality.require_rate(quality.null_rate(bad, ["vwap"], now), quality.NULL_RATE, "nulls")
    key = ["symbol_key", "window_start"]
    assert quality.duplicate_rate(good, key, now).first()["rate"] == 0
    with pytest.raises(quality.QualityError):
        quality.require_rate(
            quality.duplicate_rate(bad, key, now), quality.DUPLICATE_RATE, "copies")
    none = quality.null_rate(good, ["vwap"], now + 10**9).first()
    assert (none.total, none.rate) == (0, 0.0)
    quality.require_fresh(quality.check_fresh(good, "window_start", now), "trades")
    with pytest.raises(quality.QualityError):
        quality.require_fresh(quality.check_fresh(good, "window_start", now + 10**6), "trades")
    with pytest.raises(quality.QualityError):
        quality.require_empty(good, "rows")


def test_gaps_and_stalls(spark):
    holes = _facts(spark, window_start=f"{T0}L + (id + if(id >= 10, 6, 0)) * 1000")
    got = quality.window_gaps(holes, as_of_ms=T0 + 60_000, block_ms=5_000).collect()
    assert [tuple(r) for r in got] == [(1, 1)]
    assert quality.window_gaps(_facts(spark), as_of_ms=T0 + 60_000).count() == 0
    minutes = spark.createDataFrame([(T0 + m * 60_000,) for m in (0, 0, 1, 5, 6)], "ts long")
    rows = quality.insert_rate(minutes, "ts").orderBy("minute_start").collect()
    assert [(r.rows, r.empty_minutes, r.stalled) for r in rows] == [
        (2, 0, False), (1, 0, False), (1, 3, True), (1, 0, False)]


def test_progress_rules_need_the_whole_span(spark):
    def line(second, lag, rows, ms):
        stamp = f"2024-01-01T{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}.000Z"
        return (json.dumps({
            "name": "trades", "timestamp": stamp, "batchId": second, "numInputRows": rows,
            "durationMs": {"triggerExecution": ms},
            "sources": [{"metrics": {"maxOffsetsBehindLatest": str(lag)}}],
        }),)

    lines = [line(s, 20_000 if s >= 60 else 0, 5 if s < 300 else 0, 10) for s in range(0, 600, 30)]
    lines.append(line(605, 0, 5, 9_000))
    got = {}
    for r in progress_alerts(parse_progress(spark.createDataFrame(lines, "value string"))).collect():
        got.setdefault(r.rule, []).append(r.batch_id)
    assert sorted(got["lag"]) == list(range(180, 600, 30))
    assert sorted(got["stalled"]) == list(range(480, 600, 30))
    assert got["slow_batch"] == [605]


def test_trades_are_aggregated_once_for_both_facts(spark, sf, monkeypatch):
    calls, ohlcv = [], inputs.trades.ohlcv
    monkeypatch.setattr(inputs.trades, "ohlcv", lambda *a: calls.append(a[1]) or ohlcv(*a))
    t = inputs.Warehouse(spark, sf, "tick")
    for name in ("trade_agg", "order_flow"):
        stored = t.fact(name)
        expected = inputs.fact(spark, sf, name).select(*stored.columns)
        assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()
        assert stored.count() > 0
    assert calls == ["1 second"] * 3  # the two expected facts, and one for both that are stored
