import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import trades
from tickloom.session import SETTINGS
from tickloom.sources.tables import Tables
from tickloom.sources.topics import decode, read_topic
from tickloom.streaming import sinks
from tickloom.streaming.queries import Spec, late_drops, run_all, watermarked
from workload import inputs, streams

T0 = 1_704_067_200_000


def _feed(folder, name, rows):
    """Writes ``(trade_id, ms after T0)`` messages as one file."""
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"symbol": "BTCUSDT", "trade_id": i, "price": 1.0 + i, "quantity": 1.0,
                         "buyer_maker": i % 2 == 0, "trade_time": T0 + t}) for i, t in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture()
def setup(spark, tmp_path):
    tables = Tables(spark, root=str(tmp_path / "tables"), calendar=inputs.CALENDAR)

    def run(sink=None):
        ticks = trades.valid_trades(
            decode(read_topic(spark, str(tmp_path / "topic"), "text"), schemas.TRADE))
        frame = trades.ohlcv(watermarked(ticks, "trade_time"), "5 seconds")
        spec = Spec("t", frame, sink or sinks.trades_batch(tables), str(tmp_path / "cp"))
        return run_all(spark, [spec])[0]

    return tables, tmp_path / "topic", run


def _stored(tables):
    rows = tables.fact("trade_agg").orderBy("window_start").collect()
    return [((r.window_start - T0) // 1000, r.trade_count) for r in rows]


def test_windows_close_once_and_late_rows_are_counted(setup):
    tables, topic, run = setup
    _feed(topic, "a", [(1, 0), (2, 4_000), (3, 6_000), (4, 12_500)])
    query = run()
    assert _stored(tables) == [(0, 2), (5, 1)]  # 10.5 s watermark; 10-15 s stays open
    assert late_drops(query) == 0
    _feed(topic, "b", [(5, 1_000), (6, 13_000), (7, 30_000)])  # the first is too late
    query = run()  # resumes from the checkpoint
    assert _stored(tables) == [(0, 2), (5, 1), (10, 2)]
    assert late_drops(query) == 1
    assert tables.fact("order_flow").count() == 3


def test_failed_batch_is_replayed_without_duplicates(setup):
    tables, topic, run = setup
    _feed(topic, "a", [(i, i * 1_000) for i in range(40)])
    store, failed = sinks.trades_batch(tables), []

    def crash_after_write(df, batch_id):
        store(df, batch_id)
        if df.count() and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost driver")

    with pytest.raises(Exception, match="lost driver"):
        run(crash_after_write)
    before = _stored(tables)
    run(store)
    assert failed and _stored(tables) == before
    keys = tables.fact("trade_agg").select("symbol_key", "window_start", "window_key")
    assert keys.distinct().count() == keys.count() == len(before)


def test_indicators_of_a_late_candle_use_only_what_came_before_it(spark, tmp_path):
    tables = Tables(spark, root=str(tmp_path / "tables"), calendar=inputs.CALENDAR)
    sink = sinks.indicators_batch(tables)

    def batch(minutes):
        return spark.createDataFrame(
            [("BTCUSDT", "1m", T0 + m * 60_000, T0 + m * 60_000 + 59_999, 1.0, 2.0, 1.0,
              1.0 + m % 5, float(m), 1, True) for m in minutes],
            "symbol string, interval string, open_time long, close_time long, open double, "
            "high double, low double, close double, volume double, trade_count int, "
            "is_closed boolean",
        )

    late = 30
    sink(batch([m for m in range(60) if m != late]), 0)
    sink(batch([late]), 1)
    sink(batch(range(60, 70)), 2)
    sink(batch(range(60, 70)), 2)  # replayed
    got = {(r.open_time - T0) // 60_000: r for r in tables.fact("technical_indicator").collect()}
    assert len(got) == 70 and tables.fact("technical_indicator").count() == 70
    closes = {m: 1.0 + m % 5 for m in range(70)}
    for m in (late, 65):
        last20 = [closes[x] for x in range(m - 19, m + 1)]
        assert float(got[m].bb_middle) == pytest.approx(sum(last20) / 20)


def test_archive_folders(spark, tmp_path):
    topic = tmp_path / "topic"
    _feed(topic, "a", [(1, 0), (2, 3_600_000), (3, 3_600_001)])
    rows = decode(read_topic(spark, str(topic), "text"), schemas.TRADE)
    sinks.archive_stream(
        rows, str(tmp_path / "out"), ["symbol", "year", "month", "day", "hour"], "trade_time",
        str(tmp_path / "cp"), interval=None,
    ).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert (tmp_path / "out/symbol=BTCUSDT/year=2024/month=01/day=01/hour=01").is_dir()
    assert out.filter(F.col("hour") == 1).count() == 2 and out.count() == 3


def test_archive_of_a_hot_folder_is_dealt_evenly(spark, tmp_path):
    hot = spark.range(9_000).selectExpr("'BTCUSDT' as symbol", f"{T0} + id as trade_time", "id as trade_id")
    rest = spark.range(1_000).selectExpr("concat('S', id % 50) as symbol", f"{T0} + id as trade_time", "id as trade_id")
    odd = spark.sql("select 'BTCUSDT' as symbol, cast(null as bigint) as trade_time, -1L as trade_id")
    rows, cols = hot.unionByName(rest).unionByName(odd), ["symbol", "year", "month", "day", "hour"]
    sink = sinks.archive_batch(str(tmp_path), cols, "trade_time", rows_per_file=1_000)
    for batch in (0, 1, 1):  # the last is a replay
        sink(rows, batch)
    stored = spark.read.parquet(str(tmp_path)).withColumn("file", F.input_file_name())
    assert stored.groupBy("batch").count().orderBy("batch").collect() == [(0, 10_001), (1, 10_001)]
    again = stored.filter("batch = 1")
    assert again.select("symbol", "trade_time", "trade_id").exceptAll(rows).isEmpty()
    sizes = [r["count"] for r in again.filter("symbol = 'BTCUSDT' and trade_time is not null").groupBy("file").count().collect()]
    assert len(sizes) == 9 and max(sizes) < 1_300 and min(sizes) > 700
    others = again.filter("symbol <> 'BTCUSDT'").groupBy("symbol").agg(F.countDistinct("file").alias("n"))
    assert others.filter("n > 1").isEmpty() and others.count() == 50


def test_progress_is_logged_beyond_what_a_session_remembers(spark, tmp_path):
    from tickloom.streaming.progress import ProgressLog, late_rows, parse_progress, progress_alerts

    log = ProgressLog(spark, str(tmp_path / "log"))
    assert log.rows().count() == 0
    for i in range(300):
        log.record(json.dumps({
            "name": "q", "runId": f"r{i // 150}", "batchId": i, "timestamp": f"2024-01-01T00:{i // 10:02d}:{i % 10 * 6:02d}.000Z", "numInputRows": 2,
            "durationMs": {"triggerExecution": 6000 if i == 7 else 10}, "stateOperators": [{"numRowsDroppedByWatermark": i % 3}],
            "sources": [{"metrics": {"maxOffsetsBehindLatest": "20000" if i < 30 else "0"}}]}))
    for _ in range(2):  # before and after it is compacted
        assert [tuple(r) for r in late_rows(log.rows()).collect()] == [("q", 600, 300)]
        fired = {(r.rule, r.batch_id) for r in progress_alerts(parse_progress(log.rows())).collect()}
        assert ("slow_batch", 7) in fired and {r for r, _ in fired} == {"slow_batch", "lag"}
        assert min(b for r, b in fired if r == "lag") == 20  # held for two minutes
        log.compact()
    assert len(list((tmp_path / "log").glob("part-*"))) == 1


def test_listener_logs_every_run(spark, setup, tmp_path):
    from tickloom.streaming.progress import ProgressLog, late_rows

    tables, topic, run = setup
    log = ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        for name, rows in (("a", [(1, 0), (2, 12_500)]), ("b", [(3, 1_000), (4, 30_000)])):
            _feed(topic, name, rows)
            log.wait_for([run()])
    finally:
        spark.streams.removeListener(log)
    assert [tuple(r) for r in late_rows(log.rows()).collect()] == [("t", 4, 1)]


def test_alert_queries_run_side_by_side(spark, sf, monkeypatch):
    started = []

    def note(_, specs):
        started.append([spec.name for spec in specs])
        assert all(spec.frame.sparkSession.read.text(f"{spec.checkpoint.rpartition('/')[0]}/topic").count() for spec in specs)
        return []

    monkeypatch.setattr(streams, "run_all", note)
    assert streams.run_alerts(spark, sf).isEmpty()
    assert started == [["trades", "quotes"]] * streams.SLICES


def test_state_writes_look_no_key_up_to_count_rows(setup):
    tables, topic, run = setup
    _feed(topic, "a", [(1, 0), (2, 4_000), (3, 6_000), (4, 12_500)])
    totals = {op["numRowsTotal"] for p in run().recentProgress for op in p["stateOperators"]}
    assert totals == {0} and _stored(tables) == [(0, 2), (5, 1)]  # a window is kept, but not counted


@pytest.mark.parametrize("named", [True, False])
def test_state_stores_share_one_bound_of_memory(spark, setup, named):
    """Else each store has write buffers of its own, and an executor as many as it has partitions of state."""
    tables, topic, run = setup
    own = {k: spark.conf.get(k) for k in SETTINGS if ".stateStore." in k}
    manager = spark._jvm.org.apache.spark.sql.execution.streaming.state.RocksDBMemoryManager
    store, others, found = sinks.trades_batch(tables), manager.getNumRocksDBInstances(False), []

    def sink(df, batch_id):  # the query's own stores are open now; those of ended queries go at any time
        store(df, batch_id)
        found.append((manager.getNumRocksDBInstances(True), manager.getNumRocksDBInstances(False)))

    _feed(topic, "a", [(i, i * 1_000) for i in range(40)])
    try:
        for k in {} if named else own:  # a session with Spark's own settings
            spark.conf.unset(k)
        run(sink)
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)
    assert found and all(bounded > 0 and unbounded <= others for bounded, unbounded in found)
    assert sum(n for _, n in _stored(tables)) == 35
