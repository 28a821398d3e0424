"""Per-batch sinks. Each can be replayed: keyed inserts add only what is missing."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.functions.clock import DAY
from tickloom.operators import alerts as rules
from tickloom.operators.archive import add_partition_cols, archivable
from tickloom.operators.candles import kline_fact
from tickloom.operators.indicators import BLOCK_MS, MACD_FRAME, over_frames, technical_indicators
from tickloom.operators.quotes import spread_fact
from tickloom.operators.rejects import rejected
from tickloom.operators.trades import order_flow_fact, trade_agg_fact
from tickloom.schemas import misfit
from tickloom.sources.topics import encode
from tickloom.streaming.queries import trigger

Sink = Callable[[DataFrame, int], None]
ARCHIVE_ROWS = 500_000  # rows of a large archive file


def fan_out(
    df: DataFrame, tables, writes: dict[str, Callable[[DataFrame], DataFrame]]
) -> tuple[int, int] | None:
    """Writes a batch of closed windows to several facts, computing it once.

    Returns the time range of the batch, ``None`` for an empty one.
    """
    batch = df.persist()
    try:
        *span, rows = _measured(batch, "window_start")
        if not rows:
            return None
        for name, transform in writes.items():
            # Sums of good rows can still be too large to store; such windows are set aside.
            facts = transform(batch).withColumn("reason", misfit(name))
            tables.insert(facts.filter("reason IS NULL"), name, span=tuple(span), unique=True, rows=rows)
            tables.reject(facts.filter("reason IS NOT NULL"), name, f"{span[0]}-{span[1]}-{rows}")
        return tuple(span)
    finally:
        batch.unpersist()


def _measured(df: DataFrame, ts: str) -> tuple[int | None, int | None, int]:
    """First and last time, and the number of rows."""
    return tuple(df.agg(F.min(ts), F.max(ts), F.count("*")).first())


def _block(since: int | None, last: int, block_ms: int) -> int | None:
    """Cuts long spans into blocks; a batch with its look-back mostly is a short one."""
    return None if since is not None and last - since <= block_ms else block_ms


def _dims(tables) -> dict[str, DataFrame]:
    return {n: tables.dim(n) for n in ("symbol", "window_type", "kline_interval")}


def trades_batch(tables) -> Sink:
    """Closed trade windows into the OHLCV and order-flow facts."""
    dims = _dims(tables)
    writes = {
        "trade_agg": lambda batch: trade_agg_fact(batch, dims),
        "order_flow": lambda batch: order_flow_fact(batch, dims),
    }

    def sink(df: DataFrame, batch_id: int) -> None:
        fan_out(df, tables, writes)

    return sink


def rejects_batch(tables, kind: str) -> Sink:
    """Messages that are not used, with the reason, beside the query that uses the others."""
    def sink(df: DataFrame, batch_id: int) -> None:
        tables.reject(rejected(df, kind), kind, str(batch_id))

    return sink


def quotes_batch(tables) -> Sink:
    """Closed quote windows into the spread fact."""
    dims = _dims(tables)

    def sink(df: DataFrame, batch_id: int) -> None:
        fan_out(df, tables, {"spread_snapshot": lambda batch: spread_fact(batch, dims)})

    return sink


def indicators_batch(tables, block_ms: int = BLOCK_MS) -> Sink:
    """Closed candles into the candle fact and, over the stored history, the indicator fact.

    The candles are stored first and the indicators computed from what is stored, so a batch
    replayed after a crash between the two writes still gets its indicators.
    """
    dims = _dims(tables)
    series = ["symbol_key", "interval_key"]

    def sink(df: DataFrame, batch_id: int) -> None:
        facts = kline_fact(df, dims).persist()
        try:
            first, last, rows = _measured(facts, "open_time")
            if not rows:
                return
            span = first, last
            order = [F.col("close_time"), F.col("trade_count")]
            tables.insert(facts, "kline_closed", order, span, rows=rows)
            wanted = _from_stored(tables, facts, first, last, block_ms)
            tables.insert(wanted, "technical_indicator", span=span, unique=True, rows=rows)
        finally:
            facts.unpersist()

    return sink


def _from_stored(tables, facts: DataFrame, first: int, last: int, block_ms: int) -> DataFrame:
    """The indicators of candles that are stored, from the stored candles of their series."""
    name, series = "kline_closed", ["symbol_key", "interval_key"]
    wanted = facts.select(*series).distinct()
    days = tables.preceding_days(name, wanted, first, MACD_FRAME - 1)
    if days is None:
        since = tables.reach_back(name, wanted, first, MACD_FRAME - 1)
        stored = tables.fact(name, since, last)
    else:
        low, high = (date(1970, 1, 1) + timedelta(days=t // DAY) for t in (first, last))
        days = sorted({*days, *(d for d in tables.days(name) if low <= d <= high)})
        since = (days[0] - date(1970, 1, 1)).days * DAY
        stored = tables.fact(name, to_ms=last, days=days)
    # Only the batch's own series: a new listing widens the look-back, not the work.
    return technical_indicators(
        stored.join(wanted, series, "left_semi"), _block(since, last, block_ms)
    ).join(facts.select(*series, "open_time"), [*series, "open_time"], "left_semi")


def framed_batch(tables, block_ms: int = BLOCK_MS) -> Sink:
    """Candles with their kept frames into the candle fact and the indicator fact.

    No stored history is read, but the keys of the batch's own time range. Only candles that came
    later than their series' kept candles reach take their frames from the store.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        batch = df.persist()
        try:
            first, last, rows = _measured(batch, "open_time")
            if not rows:
                return
            tables.insert(batch.drop("frame"), "kline_closed", span=(first, last), unique=True, rows=rows)
            found = over_frames(batch.filter("frame is not null"))
            tables.insert(found, "technical_indicator", span=(first, last), unique=True, rows=rows)
            behind = batch.filter("frame is null")
            first, last, rows = _measured(behind, "open_time")
            if rows:
                found = _from_stored(tables, behind, first, last, block_ms)
                tables.insert(found, "technical_indicator", span=(first, last), unique=True, rows=rows)
        finally:
            batch.unpersist()

    return sink


def _store_alerts(tables, found: list[DataFrame], span: tuple[int, int]) -> None:
    """Stores the alerts of the batch's own time range."""
    fresh = rules.alert_fact(found, tables.dim("alert_type")).filter(
        F.col("triggered_at").between(*span)
    ).persist()
    try:  # few rows: they are counted to size the write
        tables.insert(fresh, "price_alert", span=span, unique=True, rows=fresh.count())
    finally:
        fresh.unpersist()


def trade_alerts_batch(tables, t: rules.Thresholds = rules.DEFAULTS) -> Sink:
    """Stores 5-second windows and judges each against its own past."""
    dims, symbols = _dims(tables), tables.symbols().select("symbol_key")
    writes = {
        "trade_agg": lambda batch: trade_agg_fact(batch, dims),
        "order_flow": lambda batch: order_flow_fact(batch, dims),
    }

    def sink(df: DataFrame, batch_id: int) -> None:
        span = fan_out(df, tables, writes)
        if span is None:
            return
        first, last = span
        since = tables.reach_back(
            "trade_agg", symbols, first, 1,
            lambda low, high: tables.windowed("trade_agg", "5s", from_ms=low, to_ms=high),
        )
        surge_since = first - t.surge_span_ms
        _store_alerts(tables, [
            rules.price_spikes_replay(
                tables.windowed("trade_agg", "5s", from_ms=since, to_ms=last), t,
                _block(since, last, rules.BLOCK_MS),
            ),
            rules.volume_surges_replay(
                tables.windowed("trade_agg", "5s", from_ms=surge_since, to_ms=last), t,
                _block(surge_since, last, rules.BLOCK_MS),
            ),
        ], span)

    return sink


def quote_alerts_batch(tables, t: rules.Thresholds = rules.DEFAULTS) -> Sink:
    """Stores spread snapshots and judges each against its own past."""
    dims = _dims(tables)

    def sink(df: DataFrame, batch_id: int) -> None:
        span = fan_out(df, tables, {"spread_snapshot": lambda batch: spread_fact(batch, dims)})
        if span is None:
            return
        first, last = span

        def judged(rule, span_ms: int) -> DataFrame:
            since = first - span_ms
            rows = rules.active_snapshots(tables, from_ms=since, to_ms=last)
            return rule(rows, t, _block(since, last, rules.BLOCK_MS))

        _store_alerts(tables, [
            judged(rules.spread_widening_replay, t.widening_span_ms),
            judged(rules.low_liquidity_replay, t.liquidity_span_ms),
        ], span)

    return sink


def dealt_by_folder(batch: DataFrame, folder: list[str], rows_per_file: int) -> DataFrame:
    """The rows dealt to writing tasks of similar size, from the batch's own counts by folder.

    A folder of more than ``rows_per_file`` rows is spread over as many tasks as it has such parts,
    each its own; any other folder is written by one task, together with others. Only the large
    folders are known to the driver and broadcast: there are at most rows / ``rows_per_file``.
    """
    counts = batch.groupBy(*folder).agg(F.count("*").alias("_n"))
    large = counts.filter(F.col("_n") > rows_per_file).collect()
    others = counts.filter(F.col("_n") <= rows_per_file).agg(F.sum("_n")).first()[0] or 0
    shared = max(1, -(-others // rows_per_file))
    slot, tasks = F.pmod(F.xxhash64(*folder), F.lit(shared)), shared
    if large:
        starts = []
        for row in large:
            starts.append((*row[:-1], tasks, parts := -(-row["_n"] // rows_per_file)))
            tasks += parts
        types = ", ".join(f"_{c} {batch.schema[c].dataType.simpleString()}" for c in folder)
        known = batch.sparkSession.createDataFrame(starts, f"{types}, _start long, _parts long")
        same = F.lit(True)
        for c in folder:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        spread = F.col("_start") + F.pmod(F.xxhash64(*batch.columns), F.col("_parts"))
        slot = F.coalesce(spread, slot)
        batch = batch.join(F.broadcast(known), same, "left").select(*batch.columns, slot.cast("int").alias("_slot"))
    else:
        batch = batch.withColumn("_slot", slot.cast("int"))
    return batch.repartitionById(tasks, "_slot").drop("_slot")


def archive_batch(path: str, partition_cols: list[str], ts: str, rows_per_file: int = ARCHIVE_ROWS) -> Sink:
    """Raw rows into folders by symbol and time; a replayed batch replaces its own files.

    The last folder level is the batch's number, which makes that so; readers can drop it.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        rows = add_partition_cols(archivable(df), ts).select(*df.columns, *[
            c for c in partition_cols if c not in df.columns
        ]).persist()
        try:
            if rows.isEmpty():
                return
            (
                dealt_by_folder(rows, partition_cols, rows_per_file).withColumn("batch", F.lit(batch_id))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(*partition_cols, "batch").parquet(path)
            )
        finally:
            rows.unpersist()

    return sink


def archive_stream(
    df: DataFrame, path: str, partition_cols: list[str], ts: str, checkpoint: str,
    interval: str | None = "5 minutes", rows_per_file: int = ARCHIVE_ROWS,
) -> StreamingQuery:
    """Raw rows to Parquet folders by symbol and hour (or day), see :func:`archive_batch`."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        archive_batch(path, partition_cols, ts, rows_per_file))
    return trigger(writer, interval).start()


def to_topic(df: DataFrame, topic: str, servers: str, checkpoint: str) -> DataStreamWriter:
    """Typed rows to a Kafka topic, keyed by symbol."""
    return (
        encode(df).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
