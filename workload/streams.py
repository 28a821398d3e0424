"""Bounded stream runs over the derived inputs.

The messages arrive in slices of time. After each slice the query is started again on the
same checkpoint with ``availableNow``, so every run also resumes state and watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators import alerts as rules
from tickloom.operators import candles, quotes, trades
from tickloom.operators.archive import ARCHIVES
from tickloom.session import scratch_dir
from tickloom.sources.tables import Tables
from tickloom.sources.topics import decode, read_topic
from tickloom.streaming import sinks
from tickloom.streaming.frames import last_candles, with_kept_frame
from tickloom.streaming.progress import ProgressLog
from tickloom.streaming.queries import Spec, run_all, start, watermarked
from workload import inputs

SLICES = 2


def deliver(messages: DataFrame, ts: str, folder: str, low: int, high: int) -> None:
    """Appends the messages of ``[low, high)`` to a topic folder, one JSON line each."""
    part = messages.filter((F.col(ts) >= low) & (F.col(ts) < high))
    part.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(folder)


def in_slices(
    messages: DataFrame, ts: str, folder: str, run: Callable[[], None], slices: int = SLICES
) -> None:
    topics_in_slices([(messages, ts, folder)], run, slices)


def topics_in_slices(
    topics: list[tuple[DataFrame, str, str]], run: Callable[[], None], slices: int = SLICES
) -> None:
    """Each topic's messages come in slices of its own time; a run finds one slice of each."""
    cuts = []
    for messages, ts, _ in topics:
        low, high = messages.agg(F.min(ts), F.max(ts)).first()
        cuts.append((low, (high - low) // slices + 1))
    for i in range(slices):
        for (messages, ts, folder), (low, step) in zip(topics, cuts):
            deliver(messages, ts, folder, low + i * step, low + (i + 1) * step)
        run()


def _topic(spark: SparkSession, folder: str, schema) -> DataFrame:
    return decode(read_topic(spark, folder, fmt="text"), schema)


def _trades(spark: SparkSession, root: str, duration: str, sink: Callable[[DataFrame, int], None]) -> Spec:
    ticks = trades.valid_trades(_topic(spark, f"{root}/topic", schemas.TRADE))
    frame = trades.ohlcv(watermarked(ticks, "trade_time"), duration)
    return Spec("trades", frame, sink, f"{root}/checkpoint")


def run_trades(spark: SparkSession, sf_dir: str, duration: str, sink) -> Tables:
    root = scratch_dir(spark, "trades")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)

    def run() -> None:
        run_all(spark, [_trades(spark, root, duration, sink(tables))])

    in_slices(inputs.raw_trades(spark, sf_dir), "trade_time", f"{root}/topic", run)
    return tables


def run_bad_trades(spark: SparkSession, sf_dir: str) -> Tables:
    """As :func:`run_trades`, with messages between that cannot be used; these go to the rejects."""
    root = scratch_dir(spark, "bad")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)
    messages = inputs.raw_trades(spark, sf_dir).unionByName(inputs.bad_trades(spark, sf_dir))

    def run() -> None:
        topic = _topic(spark, f"{root}/topic", schemas.TRADE)
        bars = trades.ohlcv(watermarked(trades.valid_trades(topic), "trade_time"), "5 seconds")
        run_all(spark, [
            Spec("bars", bars, sinks.trades_batch(tables), f"{root}/checkpoint"),
            Spec("rejects", topic, sinks.rejects_batch(tables, "trades"), f"{root}/checkpoint-rejects"),
        ])

    in_slices(messages, "trade_time", f"{root}/topic", run)
    return tables


def run_logged(spark: SparkSession, sf_dir: str) -> ProgressLog:
    """The log of :func:`run_late_trades`: its three runs on one checkpoint."""
    log = ProgressLog(spark, scratch_dir(spark, "progress"))
    spark.streams.addListener(log)
    try:
        run_late_trades(spark, sf_dir, log)
    finally:
        spark.streams.removeListener(log)
    return log


def run_late_trades(spark: SparkSession, sf_dir: str, log: ProgressLog | None = None) -> Tables:
    """As :func:`run_trades`; at last the first slice comes again, long after its windows closed."""
    root = scratch_dir(spark, "late")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)
    messages = inputs.raw_trades(spark, sf_dir)

    def run() -> None:
        ticks = trades.valid_trades(_topic(spark, f"{root}/topic", schemas.TRADE))
        frame = trades.ohlcv(watermarked(ticks, "trade_time"), "5 seconds")
        ran = run_all(spark, [Spec("late", frame, sinks.trades_batch(tables), f"{root}/checkpoint")])
        if log is not None:
            log.wait_for(ran)

    in_slices(messages, "trade_time", f"{root}/topic", run)
    low, high = messages.agg(F.min("trade_time"), F.max("trade_time")).first()
    again = messages.withColumn("price", F.col("price") * 100)  # a late row that counts would show
    deliver(again, "trade_time", f"{root}/topic", low, low + (high - low) // 2)
    run()
    return tables


def run_on_interval(spark: SparkSession, sf_dir: str) -> Tables:
    """A query with a processing-time trigger, stopped once it has read all there is."""
    root = scratch_dir(spark, "interval")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)

    def run() -> None:
        valid = quotes.valid_quotes(_topic(spark, f"{root}/topic", schemas.BOOKTICKER))
        frame = quotes.spread_snapshot(watermarked(valid, "ingested_at"))
        spec = Spec("interval", frame, sinks.quotes_batch(tables), f"{root}/checkpoint", "1 second")
        query = start(spec)
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    in_slices(inputs.raw_quotes(spark, sf_dir), "ingested_at", f"{root}/topic", run)
    return tables


def _quotes(spark: SparkSession, root: str, sink: Callable[[DataFrame, int], None]) -> Spec:
    valid = quotes.valid_quotes(_topic(spark, f"{root}/topic", schemas.BOOKTICKER))
    frame = quotes.spread_snapshot(watermarked(valid, "ingested_at"))
    return Spec("quotes", frame, sink, f"{root}/checkpoint")


def run_quotes(spark: SparkSession, sf_dir: str, sink) -> Tables:
    root = scratch_dir(spark, "quotes")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)

    def run() -> None:
        run_all(spark, [_quotes(spark, root, sink(tables))])

    in_slices(inputs.raw_quotes(spark, sf_dir), "ingested_at", f"{root}/topic", run)
    return tables


def run_klines(spark: SparkSession, sf_dir: str) -> Tables:
    root = scratch_dir(spark, "klines")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)

    def run() -> None:
        frame = candles.closed_klines(_topic(spark, f"{root}/topic", schemas.KLINE))
        sink = sinks.indicators_batch(tables, inputs.BLOCK_MS)
        run_all(spark, [Spec("klines", frame, sink, f"{root}/checkpoint")])

    in_slices(inputs.raw_klines(spark, sf_dir), "open_time", f"{root}/topic", run)
    return tables


def run_kept_klines(spark: SparkSession, sf_dir: str) -> Tables:
    """As :func:`run_klines` with frames kept as state; at last candles come that were held back.

    Each of the two slices and the late candles are a run of its own on one checkpoint.
    """
    root = scratch_dir(spark, "kept")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)

    def run() -> None:
        facts = candles.kline_fact(
            candles.closed_klines(_topic(spark, f"{root}/topic", schemas.KLINE)),
            {n: tables.dim(n) for n in ("symbol", "kline_interval")})
        frames = with_kept_frame(facts, last_candles(tables))
        sink = sinks.framed_batch(tables, inputs.BLOCK_MS)
        run_all(spark, [Spec("kept", frames, sink, f"{root}/checkpoint")])

    klines = inputs.raw_klines(spark, sf_dir)
    late = F.expr(f"open_time div {inputs.KLINE_MS} % 23 = 5")
    in_slices(klines.filter(~late), "open_time", f"{root}/topic", run)
    low, high = klines.agg(F.min("open_time"), F.max("open_time")).first()
    deliver(klines.filter(late), "open_time", f"{root}/topic", low, high + 1)
    run()
    return tables


def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade and the quote query side by side, each with a catalog of its own: one uses the
    cores that the small steps of the other leave idle."""
    roots = {kind: scratch_dir(spark, kind) for kind in ("trades", "quotes")}
    tables = {
        kind: Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR) for kind, root in roots.items()
    }

    def run() -> None:
        run_all(spark, [
            _trades(spark, roots["trades"], "5 seconds", sinks.trade_alerts_batch(tables["trades"])),
            _quotes(spark, roots["quotes"], sinks.quote_alerts_batch(tables["quotes"])),
        ])

    topics_in_slices([
        (inputs.raw_trades(spark, sf_dir), "trade_time", f"{roots['trades']}/topic"),
        (inputs.raw_quotes(spark, sf_dir), "ingested_at", f"{roots['quotes']}/topic"),
    ], run)
    return tables["trades"].fact("price_alert").unionByName(tables["quotes"].fact("price_alert"))


def run_both_windows(spark: SparkSession, sf_dir: str) -> Tables:
    """The one-second and the five-second query, side by side on one catalog."""
    root = scratch_dir(spark, "both")
    tables = Tables(spark, root=f"{root}/tables", calendar=inputs.CALENDAR)

    def run() -> None:
        specs = []
        for name, duration in (("bars_1s", "1 second"), ("bars_5s", "5 seconds")):
            ticks = trades.valid_trades(_topic(spark, f"{root}/topic", schemas.TRADE))
            frame = trades.ohlcv(watermarked(ticks, "trade_time"), duration)
            sink = sinks.trades_batch(tables.written_by(name))
            specs.append(Spec(name, frame, sink, f"{root}/checkpoint-{name}"))
        run_all(spark, specs)

    in_slices(inputs.raw_trades(spark, sf_dir), "trade_time", f"{root}/topic", run)
    return tables


def poll_alerts(
    spark: SparkSession, source: Tables, as_of_ms: int, limits: rules.Thresholds, times: int
) -> Tables:
    """Detects on ``source`` as of one time, and stores the alerts in a catalog of their own."""
    facts = {n: source.fact(n) for n in ("trade_agg", "spread_snapshot")}
    tables = Tables(spark, root=scratch_dir(spark, "alerts"), facts=facts, calendar=inputs.CALENDAR)
    for _ in range(times):
        rules.store_alerts(tables, as_of_ms, limits)
    return tables


def run_archive(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    root = scratch_dir(spark, "archive")
    columns, ts = ARCHIVES[kind]
    schema, messages = {
        "trades": (schemas.TRADE, inputs.raw_trades),
        "klines": (schemas.KLINE, inputs.raw_klines),
        "bookticker": (schemas.BOOKTICKER, inputs.raw_quotes),
    }[kind]

    def run() -> None:
        rows = _topic(spark, f"{root}/topic", schema)
        sinks.archive_stream(
            rows, f"{root}/archive", list(columns), ts, f"{root}/checkpoint", interval=None
        ).awaitTermination()

    in_slices(messages(spark, sf_dir), ts, f"{root}/topic", run)
    levels = [c for c in columns if c not in schema.fieldNames()]
    return spark.read.schema(
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        + "".join(f", {c} string" for c in levels)
    ).parquet(f"{root}/archive").drop("batch")
