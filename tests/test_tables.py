import re
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.operators.upsert import apply_retention, insert_if_absent
from tickloom.plans import staging
from tickloom.sources import dims
from tickloom.sources.shared import Busy
from tickloom.sources.tables import Tables
from workload import inputs

D0 = 1_704_067_200_000  # 2024-01-01


def _snap(spark, rows):
    """Rows ``(symbol_key, ms after D0, bid)``."""
    return spark.createDataFrame(
        [(s, 0, D0 + t, b) for s, t, b in rows],
        "symbol_key int, datetime_key long, snapshot_time long, bid double",
    ).withColumn("datetime_key", clock.datetime_key("snapshot_time")).selectExpr(
        "symbol_key", "datetime_key", "snapshot_time", "bid as bid_price", "bid + 1 as ask_price",
        "bid + 0.5 as mid_price", "1 as spread", "1 as spread_pct", "1 as bid_qty",
        "1 as ask_qty", "0 as liquidity_imbalance",
    )


@pytest.fixture()
def tables(spark, tmp_path):
    return Tables(spark, root=str(tmp_path / "t"), calendar=inputs.CALENDAR)


def _bids(tables, **kw):
    rows = tables.fact("spread_snapshot", **kw).collect()
    return sorted((r.symbol_key, r.snapshot_time - D0, float(r.bid_price)) for r in rows)


def test_insert_keeps_the_first_of_a_key_in_and_across_batches(spark, tables):
    first = _snap(spark, [(1, 0, 10.0), (1, 0, 9.0), (2, 0, 5.0)])
    tables.insert(first, "spread_snapshot", [F.col("bid_price").desc()])
    want = [(1, 0, 10.0), (2, 0, 5.0)]
    assert _bids(tables) == want
    tables.insert(first, "spread_snapshot")  # the same batch again
    tables.insert(_snap(spark, [(2, 0, 99.0), (2, 1000, 6.0)]), "spread_snapshot")
    assert _bids(tables) == [*want, (2, 1000, 6.0)]


def test_half_written_batch_is_completed_by_its_replay(spark, tables):
    rows = [(s, t * 1000, float(s)) for s in range(1, 4) for t in range(50)]
    tables.append(_snap(spark, rows[:77]), "spread_snapshot")
    tables.insert(_snap(spark, rows), "spread_snapshot", span=(D0, D0 + 49_000), unique=True)
    assert _bids(tables) == sorted(rows)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, -1, id) as k", "id")
    out = insert_if_absent(df.filter("id < 10"), df, ["k"], [F.col("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial, in each task, and final
    assert out.count() == 660
    assert not {r.k for r in out.collect()} & {-1, 1, 2}


def test_time_bounds_prune_days_and_rows(spark, tables):
    rows = [(1, d * clock.DAY + h * clock.HOUR, 1.0) for d in range(5) for h in (0, 12)]
    tables.insert(_snap(spark, rows), "spread_snapshot")
    assert tables.days("spread_snapshot") == [date(2024, 1, d) for d in range(1, 6)]
    low, high = D0 + clock.DAY + 1, D0 + 2 * clock.DAY
    assert [t for _, t, _ in _bids(tables, from_ms=low, to_ms=high)] == [
        clock.DAY + 12 * clock.HOUR, 2 * clock.DAY]
    plan = tables.fact("spread_snapshot", low, high)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "GreaterThanOrEqual(snapshot_time" in plan


def test_staging_reads_only_what_it_returns(spark, tables):
    tables.insert(_snap(spark, [(1, 0, 1.0)]), "spread_snapshot")
    df = staging.stg_spread_snapshot(tables).select("symbol", "spread", "trading_session")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "bid_price" not in plan and "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_reach_back_widens_until_every_key_has_enough(spark, tables):
    rows = [(1, d * clock.DAY, 1.0) for d in range(20)] + [(2, 0, 1.0), (2, clock.DAY, 1.0)]
    tables.insert(_snap(spark, rows), "spread_snapshot")
    one, both = (spark.createDataFrame([(k,) for k in ks], "symbol_key int") for ks in ([1], [1, 2]))
    before = D0 + 20 * clock.DAY

    def seen(keys, depth):
        since = tables.reach_back("spread_snapshot", keys, before, depth)
        return [t for _, t, _ in _bids(tables, from_ms=since, to_ms=before - 1)]

    assert seen(one, 1) == [19 * clock.DAY]
    assert len(seen(one, 3)) == 4  # widened once, to four days
    assert len(seen(both, 2)) == 22  # the sparse key needs the whole table


def test_retention_drops_days_and_cuts_the_edge_day(spark, tables):
    rows = [(1, d * clock.DAY + h * clock.HOUR, 1.0) for d in range(4) for h in (1, 20)]
    tables.insert(_snap(spark, rows), "spread_snapshot")
    as_of = D0 + 31 * clock.DAY + 12 * clock.HOUR  # cutoff: second day, noon
    assert tables.expire("spread_snapshot", as_of) == 3
    assert [t for _, t, _ in _bids(tables)] == [t for _, t, _ in rows][3:]
    assert tables.expire("spread_snapshot", as_of) == 0
    kept, deleted = apply_retention(_snap(spark, rows), "snapshot_time", 30, as_of)
    assert (kept.count(), deleted.first()[0]) == (5, 3)


def test_unstored_fact_is_empty_with_its_schema(spark, tables):
    df = tables.fact("price_alert")
    assert df.count() == 0 and "severity" in df.columns


def test_stored_calendar_and_computed_calendar_agree(spark, tables, tmp_path):
    rows = [(1, t * clock.HOUR, 1.0) for t in range(-30, 24 * 33)]  # some lie outside
    tables.insert(_snap(spark, rows), "spread_snapshot")
    stored = Tables(
        spark, root=tables.root,
        calendar=dims.dim_datetime(spark, inputs.CALENDAR.start, inputs.CALENDAR.end),
    )
    a, b = staging.stg_spread_snapshot(tables), staging.stg_spread_snapshot(stored)
    assert a.count() == b.count() == 24 * 31
    assert a.exceptAll(b).count() == 0


def test_reference_calendar_size(spark):
    assert dims.dim_datetime(spark, date(2025, 1, 1), date(2027, 1, 1)).count() == 1_051_200


def test_symbol_universe(spark):
    symbols = dims.seed(spark, "symbol")
    assert dims.active_symbols(symbols).count() == 8
    assert [r.symbol for r in dims.active_symbols(symbols, ["btcusdt"]).collect()] == ["BTCUSDT"]
    off = symbols.withColumn("is_active", F.col("symbol") != "BTCUSDT")
    assert dims.active_symbols(off).count() == 7


def test_latest_reads_stop_at_the_newest_days_that_suffice(spark, tables):
    from tickloom.plans import serving

    def window(symbol, day, close, window_key=1):
        start = D0 + day * clock.DAY
        return (symbol, window_key, start, float(close))

    def store(rows):
        df = spark.createDataFrame(
            rows, "symbol_key int, window_key int, window_start long, close double")
        tables.append(
            df.withColumn("datetime_key", clock.datetime_key("window_start")).withColumns({
                "window_end": F.col("window_start") + 1000, "trade_count": F.lit(1),
                **{c: F.col("close") for c in ("open", "high", "low", "vwap", "volume")},
                **{c: F.lit(0) for c in ("price_change", "price_change_pct")},
            }), "trade_agg")

    store([window(s, d, 100 * s + d) for s in range(1, 9) for d in range(20)])
    got = {r.symbol: r for r in serving.latest_prices(tables).collect()}
    assert float(got["BTCUSDT"].last_price) == 119 and float(got["BTCUSDT"].price_change) == 1
    # The last row of each symbol, and the last one a minute before it.
    assert _opened(serving.latest_prices(tables)) == {"2024-01-19", "2024-01-20"}
    store([window(1, 25, 500), window(1, 26, 600, 2)])  # only one symbol goes on
    got = {r.symbol: r for r in serving.latest_prices(tables).collect()}
    assert len(got) == 8 and float(got["ETHUSDT"].last_price) == 219
    assert float(got["BTCUSDT"].last_price) == 500
    # The newest window of any length sets the cutoff, so the previous row is day 25 itself.
    assert float(got["BTCUSDT"].price_change) == 0
    history = serving.price_history(tables, "ETHUSDT", "1s", 5).collect()
    assert [float(r.close) for r in history] == [215, 216, 217, 218, 219]
    # An inactive symbol is served too, from however far back its last rows are.
    off = dims.seed(spark, "symbol").withColumn("is_active", F.col("symbol") != "ETHUSDT")
    quiet = Tables(spark, root=tables.root, calendar=tables.calendar, dimensions={"symbol": off})
    assert serving.latest_prices(quiet).count() == 8
    assert serving.price_history(quiet, "ETHUSDT", "1s", 5).count() == 5


def test_writers_side_by_side_lose_nothing(spark, tables):
    """Appends of several writers, and of one writer from two threads, at the same time."""
    def write(writer, first):
        own = tables.written_by(writer)
        for k in range(4):
            rows = [(first + k, t * 1000, 1.0) for t in range(20)]
            own.append(_snap(spark, rows), "spread_snapshot", rows=20)

    with ThreadPoolExecutor(3) as pool:
        for done in [pool.submit(write, *job) for job in (("a", 10), ("b", 20), ("b", 30))]:
            done.result()
    assert tables.fact("spread_snapshot").count() == 3 * 4 * 20
    tables.written_by("c").insert(_snap(spark, [(10, 0, 5.0), (99, 0, 5.0)]), "spread_snapshot")
    assert tables.fact("spread_snapshot").count() == 3 * 4 * 20 + 1  # keys hold across writers


def test_known_batches_leave_the_planned_files_and_days_are_compacted(spark, tables):
    path = Path(tables.path("spread_snapshot"))
    for k in range(3):
        rows = [(s, k * 1000, 1.0) for s in range(50)]
        tables.append(_snap(spark, rows).repartition(7), "spread_snapshot", rows=len(rows))
    assert len(list(path.rglob("part-*.parquet"))) == 3
    before = _bids(tables)
    tables.compact("spread_snapshot", date(2024, 1, 1))
    assert len(tables.fact("spread_snapshot").inputFiles()) == 1 and _bids(tables) == before
    tables.vacuum("spread_snapshot", 0)  # what readers may still hold is kept until then
    assert len(list(path.rglob("part-*.parquet"))) == 1 and _bids(tables) == before


def _bars(spark, rows):
    """Rows ``(symbol_key, window_key, ms after D0, close)``."""
    df = spark.createDataFrame(
        [(s, w, D0 + t, float(c)) for s, w, t, c in rows],
        "symbol_key int, window_key int, window_start long, close double")
    return df.withColumn("datetime_key", clock.datetime_key("window_start")).withColumns({
        "window_end": F.col("window_start") + 1000, "trade_count": F.lit(1),
        **{c: F.col("close") for c in ("open", "high", "low", "vwap", "volume")},
        **{c: F.lit(0) for c in ("price_change", "price_change_pct")},
    })


def _opened(df):
    return {m for f in df.inputFiles() for m in re.findall(r"dt=([0-9-]+)", f)}


@pytest.mark.parametrize("recorded,n_days", [(True, 1000), (False, 30)])
def test_silent_symbols_do_not_widen_the_newest_reads(spark, tables, monkeypatch, recorded, n_days):
    """Symbol 2 stopped on the first of the days, symbol 3 never traded, the others go on."""
    from tickloom.plans import marts, serving

    days = Tables(spark, root=tables.root, calendar=dims.Calendar(date(2024, 1, 1), date(2027, 1, 1)))
    rows = [(s, 1, d * clock.DAY + m * clock.MINUTE, 100 * s + d + m / 10)
            for d in range(n_days) for s in range(1, 9) for m in (0, 2) if s != 3 and (s != 2 or d == 0)]
    days.append(_bars(spark, rows), "trade_agg")
    if not recorded:
        monkeypatch.setattr(Tables, "seen", lambda self, name: None)
    for read in (serving.latest_prices, marts.mart_latest_prices):
        out = read(days)
        got = {r.symbol: float(r.last_price) for r in out.collect()}
        assert len(got) == 7 and sorted(got.values())[:2] == sorted([200.2, 99.2 + n_days])[:2]
        if recorded:
            assert _opened(out) == {"2024-01-01", "2026-09-26"}
    change = {r.symbol: float(r.price_change) for r in serving.latest_prices(days).collect()}
    assert set(change.values()) == {0.2}
    assert serving.price_history(days, "ETHUSDT", "1s", 5).count() == 2
    out = serving.price_history(days, "BTCUSDT", "1s", 5)
    assert [float(r.close) for r in out.collect()] == [97.2 + n_days, 98 + n_days, 98.2 + n_days, 99 + n_days, 99.2 + n_days]
    if recorded:
        assert len(_opened(out)) == 3


def test_record_survives_replays_and_compaction(spark, tables):
    first = _snap(spark, [(1, 0, 1.0), (2, 5, 1.0), (1, clock.DAY, 1.0)])
    for _ in range(3):
        tables.insert(first, "spread_snapshot")
    tables.append(_snap(spark, [(1, 9, 1.0)]), "spread_snapshot", rows=1)

    def record():
        return sorted((r.symbol_key, str(r.dt), r["first"] - D0, r["last"] - D0) for r in tables.seen("spread_snapshot").collect())

    want = [(1, "2024-01-01", 0, 9), (1, "2024-01-02", clock.DAY, clock.DAY), (2, "2024-01-01", 5, 5)]
    assert record() == want
    tables.compact("spread_snapshot", date(2024, 1, 1))
    assert record() == want and len(_bids(tables)) == 4
    assert len(list(Path(tables.root).glob("seen_*/writer=*/part-*.parquet"))) == 1


def _slow_keep(tables, meanwhile):
    """Makes a rewrite wait, after it has listed its files, until ``meanwhile`` is done."""
    whole = tables._rewrite

    def rewrite(name, writer, day, keep):
        def kept(df):
            meanwhile()
            return keep(df)
        whole(name, writer, day, kept)

    tables._rewrite = rewrite


@pytest.mark.parametrize("job", ["compact", "expire"])
def test_rewrites_keep_rows_that_are_appended_meanwhile(spark, tables, job):
    noon = 12 * clock.HOUR
    tables.append(_snap(spark, [(s, noon, 1.0) for s in range(100)]), "spread_snapshot", rows=100)
    late = tables.written_by("main")
    _slow_keep(tables, lambda: late.append(_snap(spark, [(s, noon + 1, 2.0) for s in range(50)]), "spread_snapshot", rows=50))
    if job == "compact":
        tables.compact("spread_snapshot", date(2024, 1, 1))
    else:
        tables.append(_snap(spark, [(7, 0, 1.0)]), "spread_snapshot", rows=1)
        assert tables.expire("spread_snapshot", D0 + 30 * clock.DAY + clock.HOUR) == 1
    assert len(_bids(tables)) == 150
    del tables._rewrite
    tables.compact("spread_snapshot", date(2024, 1, 1))  # of a generation and new files
    assert len(_bids(tables)) == 150
    assert tables.vacuum("spread_snapshot") == 0 and tables.vacuum("spread_snapshot", 0) > 0
    assert len(_bids(tables)) == 150
    tables.insert(_snap(spark, [(s, noon, 9.0) for s in range(120)]), "spread_snapshot")
    assert len(_bids(tables)) == 170


def test_rewrites_of_two_drivers_exclude_each_other(spark, tables):
    tables.append(_snap(spark, [(s, 0, 1.0) for s in range(100)]), "spread_snapshot", rows=100)
    other, busy = Tables(spark, root=tables.root, calendar=inputs.CALENDAR), []

    def meanwhile():
        with pytest.raises(Busy):
            other.compact("spread_snapshot", date(2024, 1, 1))
        busy.append(True)

    _slow_keep(tables, meanwhile)
    tables.compact("spread_snapshot", date(2024, 1, 1))
    assert busy == [True] and len(_bids(tables)) == 100
    other.compact("spread_snapshot", date(2024, 1, 1))  # the lease is free again
    assert len(_bids(tables)) == 100


def test_append_of_another_process_during_a_rewrite(spark, tables):
    """A writer of another process (plain Arrow files here) is not seen by any lock of this one."""
    tables.append(_snap(spark, [(s, 0, 1.0) for s in range(100)]), "spread_snapshot", rows=100)
    day = Path(tables.path("spread_snapshot")) / "writer=main" / "dt=2024-01-01"
    code = (
        "import pyarrow.parquet as pq, sys, glob\n"
        "t = pq.read_table(glob.glob(sys.argv[1] + '/part-*.parquet')[0], partitioning=None).slice(0, 50)\n"
        "pq.write_table(t, sys.argv[1] + '/part-other.parquet')\n")
    _slow_keep(tables, lambda: subprocess.run([sys.executable, "-c", code, str(day)], check=True, timeout=60))
    tables.compact("spread_snapshot", date(2024, 1, 1))
    assert tables.fact("spread_snapshot").count() == 150


def test_appends_of_nothing(spark, tables):
    none = _snap(spark, [(1, 0, 1.0)]).filter("symbol_key > 5")
    for rows in (None, 0):
        tables.append(none, "spread_snapshot", rows=rows)
    tables.append(none.join(none.select("symbol_key"), "symbol_key"), "spread_snapshot")
    assert _bids(tables) == []
    tables.append(_snap(spark, [(1, 0, 1.0)]), "spread_snapshot")
    assert tables.seen("spread_snapshot").count() == 1


def test_the_record_of_a_write_is_not_aggregated_by_one_task(spark, tables):
    """Shuffled parts that one task aggregates add up to its peak memory, and more of them come with the rows."""
    sc, conf = spark.sparkContext, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    rows, own = _snap(spark, [(s, t * 1000, 1.0) for s in range(1, 9) for t in range(9)]), {k: spark.conf.get(k) for k in conf}
    sc.setJobGroup("record", "a record")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        tables._note("spread_snapshot", rows)
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup("record") for s in status.getJobInfo(j).stageIds}
    assert 7 in {i.numTasks for s in stages if (i := status.getStageInfo(s))}  # the aggregate's own stage
    assert tables.seen("spread_snapshot").count() == 8
