import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import candles
from tickloom.operators.indicators import technical_indicators
from tickloom.sources.tables import Tables
from tickloom.sources.topics import decode, read_topic
from tickloom.streaming import frames, sinks
from tickloom.streaming.queries import Spec, run_all
from workload import inputs

T0, MINUTE, DAY = 1_704_067_200_000, 60_000, 86_400_000


def _candle(symbol, at, shift=0):
    k = at // MINUTE % 97 + shift
    return {"symbol": symbol, "interval": "1m", "open_time": T0 + at, "close_time": T0 + at + MINUTE - 1,
            "open": 100.0 + k, "high": None if k % 31 == 0 else 103.0 + k % 7, "low": 98.0 - k % 5,
            "close": 100.0 + k * 37 % 11, "volume": 1.0 + k % 13, "trade_count": 3, "is_closed": True,
            "ingested_at": T0 + at}


def _dims(tables):
    return {n: tables.dim(n) for n in ("symbol", "kline_interval")}


@pytest.fixture()
def setup(spark, tmp_path, monkeypatch):
    tables = Tables(spark, root=str(tmp_path / "tables"), calendar=inputs.CALENDAR)
    looked, real = [], sinks._from_stored
    monkeypatch.setattr(sinks, "_from_stored", lambda *a: looked.append(a[1].count()) or real(*a))

    def run(name, rows, checkpoint="cp", sink=None):
        topic = tmp_path / f"topic-{checkpoint}"
        topic.mkdir(exist_ok=True)
        (topic / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
        facts = candles.kline_fact(candles.closed_klines(
            decode(read_topic(spark, str(topic), "text"), schemas.KLINE)), _dims(tables))
        found = frames.with_kept_frame(facts, frames.last_candles(tables))
        run_all(spark, [Spec("f", found, sink or sinks.framed_batch(tables), str(tmp_path / checkpoint))])

    return tables, run, looked


def _expected(spark, tables, batches):
    """Each batch's candles judged by all that are stored with it; the first of a key holds."""
    stored, out = {}, {}
    for rows in batches:
        fresh = {(r["symbol"], r["open_time"]): r for r in reversed(rows)}
        fresh = {k: r for k, r in fresh.items() if k not in stored}
        stored |= fresh
        df = spark.createDataFrame(list(stored.values()), schemas.KLINE)
        for r in technical_indicators(candles.kline_fact(df, _dims(tables))).join(
            spark.createDataFrame([(k[1],) for k in fresh], "open_time long").distinct(), "open_time", "left_semi"
        ).collect():
            out.setdefault((r.symbol_key, r.open_time), r.asDict())
    return out


def _got(tables):
    rows = tables.fact("technical_indicator").collect()
    assert len({(r.symbol_key, r.open_time) for r in rows}) == len(rows)
    return {(r.symbol_key, r.open_time): r.asDict() for r in rows}


def test_kept_frames_equal_the_stored_path(spark, setup):
    tables, run, looked = setup
    gone = {20, 100, 119}
    first = [_candle(s, m * MINUTE) for m in range(120) if m not in gone for s in ("BTCUSDT", "ETHUSDT")]
    # Late within the kept candles, copies (one with other values), a new listing, the next minutes.
    second = [_candle("BTCUSDT", m * MINUTE) for m in (119, 122, 100, 121, 120)]
    second += [_candle("BTCUSDT", 118 * MINUTE, shift=5), _candle("BTCUSDT", 122 * MINUTE), _candle("SOLUSDT", 0)]
    third = [_candle("BTCUSDT", 20 * MINUTE), _candle("ETHUSDT", 120 * MINUTE)]  # later than what is kept
    run("a", first)
    run("b", second)
    assert not looked  # no batch so far read the stored candles
    run("c", third)
    assert looked == [1]
    assert _got(tables) == _expected(spark, tables, [first, second, third])
    assert tables.fact("kline_closed").count() == len(_got(tables)) == 120 + 120 + 3 + 1 - 2


def test_a_new_query_starts_from_what_is_stored(spark, setup):
    tables, run, looked = setup
    first = [_candle("BTCUSDT", m * MINUTE) for m in range(90)] + [_candle("ETHUSDT", m * DAY) for m in range(-20, 0)]
    run("a", first)
    second = [_candle("BTCUSDT", 90 * MINUTE), _candle("ETHUSDT", 90 * MINUTE)]
    run("b", second, checkpoint="other")
    assert not looked and _got(tables) == _expected(spark, tables, [first, second])


def test_failed_batch_leaves_the_state_as_it_was(spark, setup):
    tables, run, _ = setup
    first, second = ([_candle("BTCUSDT", m * MINUTE) for m in part] for part in (range(40), range(40, 45)))
    run("a", first)

    def half(df, batch_id):
        if df.count():
            tables.insert(df.drop("frame"), "kline_closed")
            raise RuntimeError("lost driver")

    with pytest.raises(Exception, match="lost driver"):
        run("b", second, sink=half)
    run("c", [])
    assert _got(tables) == _expected(spark, tables, [first, second])


def test_days_before_a_time(spark, tmp_path):
    tables = Tables(spark, root=str(tmp_path / "tables"), calendar=inputs.CALENDAR)
    keys = spark.createDataFrame([("BTCUSDT",), ("ETHUSDT",)], "symbol string").join(
        tables.dim("symbol"), "symbol").select("symbol_key")
    assert tables.preceding_days("kline_closed", keys, None, 5) is None
    rows = [_candle("BTCUSDT", d * DAY + m * MINUTE) for d in range(12) for m in range(10)]
    rows += [_candle("ETHUSDT", d * DAY) for d in (0, 3)]
    tables.append(candles.kline_fact(spark.createDataFrame(rows, schemas.KLINE), _dims(tables)), "kline_closed")

    def days(before, depth):
        return [d.day - 1 for d in tables.preceding_days("kline_closed", keys, before, depth)]

    assert days(None, 5) == [0, 3, 11]  # the short series opens its own days, none between
    assert days(None, 15) == [0, 3, 10, 11]
    assert days(T0 + 6 * DAY + 2 * MINUTE, 5) == [0, 3, 5, 6]
    assert days(T0, 5) == []


def test_indicators_beside_the_store_for_a_sparse_series(spark, tmp_path):
    """A series with few candles, a day apart, keeps its frame beside a busy one."""
    tables = Tables(spark, root=str(tmp_path / "tables"), calendar=inputs.CALENDAR)
    sink = sinks.indicators_batch(tables)
    first = [_candle("BTCUSDT", m * MINUTE) for m in range(90)] + [_candle("ETHUSDT", m * DAY) for m in range(-20, 0)]
    second = [_candle("BTCUSDT", 90 * MINUTE), _candle("ETHUSDT", 90 * MINUTE)]
    for i, rows in enumerate((first, second)):
        sink(spark.createDataFrame(rows, schemas.KLINE), i)
    assert _got(tables) == _expected(spark, tables, [first, second])
    assert tables.fact("technical_indicator").filter(F.col("bb_middle").isNotNull()).count() > 70


def test_kept_frames_in_a_session_with_sparks_own_state_store(spark, setup):
    tables, run, _ = setup
    key = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    own, first = spark.conf.get(key), [_candle("BTCUSDT", m * MINUTE) for m in range(40)]
    spark.conf.set(key, heap)
    try:
        run("a", first)
        assert spark.conf.get(key) == heap  # the session's settings are as before
    finally:
        spark.conf.set(key, own)
    assert _got(tables) == _expected(spark, tables, [first])
