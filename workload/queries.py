"""Registered queries: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, ShortType, TimestampType

from tickloom.functions import clock
from tickloom.operators import alerts as rules
from tickloom.operators import archive, candles, indicators, keys, ordering, quotes, rejects, trades, upsert
from tickloom.plans import marts, quality, serving, staging
from tickloom.schemas import FACTS
from tickloom.sources import dims, envelopes, topics
from tickloom import schemas
from tickloom.session import scratch_dir
from tickloom.sources.tables import Tables
from tickloom.streaming import sinks
from tickloom.streaming.progress import late_rows
from workload import inputs, streams

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SYMBOL = "BTCUSDT"
DAY = date(2024, 1, 15)


def portable(df: DataFrame) -> DataFrame:
    """Types that read the same everywhere: doubles, ISO dates, epoch milliseconds."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, TimestampType):
            c = F.unix_millis(c)
        elif isinstance(f.dataType, ShortType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(f(spark, sf_dir))

    REGISTRY[f.__name__] = run
    return f


# -- ingest ---------------------------------------------------------------------------------


def trade_envelopes(spark, sf_dir):
    data = F.struct(
        F.lit("trade").alias("e"), F.lower("symbol").alias("s"), F.col("trade_id").alias("t"),
        F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"),
        F.col("buyer_maker").alias("m"), F.col("trade_time").alias("T"),
    )
    return _envelope(inputs.raw_trades(spark, sf_dir), data, "@trade")


def kline_envelopes(spark, sf_dir):
    k = F.struct(
        F.col("interval").alias("i"), F.col("open_time").alias("t"),
        F.col("close_time").alias("T"), *[
            F.col(c).cast("string").alias(n)
            for c, n in (("open", "o"), ("high", "h"), ("low", "l"), ("close", "c"), ("volume", "v"))
        ],
        F.col("trade_count").alias("n"), F.col("is_closed").alias("x"),
    )
    data = F.struct(F.lit("kline").alias("e"), F.lower("symbol").alias("s"), k.alias("k"))
    return _envelope(inputs.raw_klines(spark, sf_dir), data, "@kline_1m")


def quote_envelopes(spark, sf_dir):
    data = F.struct(
        F.lower("symbol").alias("s"),
        *[
            F.col(c).cast("string").alias(n)
            for c, n in (("bid_price", "b"), ("bid_qty", "B"), ("ask_price", "a"), ("ask_qty", "A"))
        ],
    )
    return _envelope(inputs.raw_quotes(spark, sf_dir), data, "@bookTicker")


def _envelope(df, data, suffix):
    stream = F.concat(F.coalesce(F.lower("symbol"), F.lit("none")), F.lit(suffix))
    return df.select(F.to_json(F.struct(stream.alias("stream"), data.alias("data"))).alias("value"))


def faulty_envelopes(spark, sf_dir):
    """Broken JSON, an unknown kind, numbers that are none or not finite, a null symbol and a
    quote without one, one each for every event."""
    events = inputs.ev(spark, sf_dir)
    lines = F.array(
        F.lit("{"), F.lit('{"stream":"x@depth","data":{"e":"depth"}}'),
        F.lit('{"stream":"x@trade","data":{"e":"trade","s":"X","t":1,"p":"abc","q":"1","m":true,"T":1}}'),
        F.lit('{"stream":"x@trade","data":{"e":"trade","s":"X","t":1,"p":"NaN","q":"1","m":true,"T":1}}'),
        F.lit('{"stream":"x@trade","data":{"e":"trade","s":"X","t":1,"p":"1","q":"Infinity","m":true,"T":1}}'),
        F.lit('{"stream":"x@trade","data":{"e":"trade","s":null,"t":1,"p":"1","q":"1","m":true,"T":1}}'),
        F.lit('{"stream":"x@bookTicker","data":{"b":"1"}}'),
    )
    return events.select(F.explode(lines).alias("value"))


def mixed_envelopes(spark, sf_dir):
    parts = (trade_envelopes, kline_envelopes, quote_envelopes, faulty_envelopes)
    first, *rest = [f(spark, sf_dir) for f in parts]
    for df in rest:
        first = first.unionByName(df)
    return first


@query
def normalize_trades(spark, sf_dir):
    parsed = envelopes.parse_envelopes(trade_envelopes(spark, sf_dir))
    return envelopes.normalize_trades(parsed, F.lit(0).cast("long"))


@query
def normalize_klines(spark, sf_dir):
    parsed = envelopes.parse_envelopes(kline_envelopes(spark, sf_dir))
    return envelopes.normalize_klines(parsed, F.lit(0).cast("long"))


@query
def normalize_booktickers(spark, sf_dir):
    parsed = envelopes.parse_envelopes(quote_envelopes(spark, sf_dir))
    return envelopes.normalize_booktickers(parsed, F.lit(0).cast("long"))


@query
def route_envelopes_counts(spark, sf_dir):
    typed = envelopes.typed_envelopes(mixed_envelopes(spark, sf_dir))
    symbol = F.coalesce("trade.symbol", "kline.symbol", "bookticker.symbol")
    return typed.filter(symbol.isNotNull()).groupBy(
        F.col("route").alias("event_type"), symbol.alias("symbol")
    ).agg(F.count("*").alias("messages"))


@query
def ingest_counts(spark, sf_dir):
    return envelopes.ingest_counts(mixed_envelopes(spark, sf_dir))


@query
def malformed(spark, sf_dir):
    """Rejected messages by the kind their stream name gives, if it can be read at all."""
    lines = envelopes.malformed(mixed_envelopes(spark, sf_dir))
    kind = F.substring_index(F.get_json_object("value", "$.stream"), "@", -1)
    return lines.groupBy(F.coalesce(kind, F.lit("none")).alias("kind")).agg(
        F.count("*").alias("messages")
    )


@query
def topic_payload(spark, sf_dir):
    return topics.decode(topics.encode(inputs.raw_trades(spark, sf_dir)), schemas.TRADE)


# -- filters --------------------------------------------------------------------------------


@query
def valid_trades(spark, sf_dir):
    return trades.valid_trades(inputs.raw_trades(spark, sf_dir)).drop("event_type")


@query
def closed_klines(spark, sf_dir):
    return candles.closed_klines(inputs.raw_klines(spark, sf_dir)).drop("event_type")


@query
def valid_quotes(spark, sf_dir):
    return quotes.valid_quotes(inputs.raw_quotes(spark, sf_dir)).drop("event_type")


@query
def archive_partitions(spark, sf_dir):
    rows = archive.archivable(inputs.raw_quotes(spark, sf_dir, "ts_ms"))
    columns, ts = archive.ARCHIVES["bookticker"]
    return archive.add_partition_cols(rows, ts).groupBy(*columns).agg(
        F.count("*").alias("messages"), F.min(ts).alias("first_ms"), F.max(ts).alias("last_ms")
    )


# -- dimensions -----------------------------------------------------------------------------


@query
def dim_datetime(spark, sf_dir):
    """The calendar's minutes with the events that fall in each."""
    calendar = dims.dim_datetime(spark, inputs.CALENDAR.start, inputs.CALENDAR.end)
    per_minute = inputs.ev(spark, sf_dir).groupBy(
        clock.datetime_key("ts_ms").alias("datetime_key")
    ).agg(F.count("*").alias("events"))
    return calendar.join(per_minute, "datetime_key", "left").fillna(0, ["events"])


@query
def seed_dims(spark, sf_dir):
    """Trades by attributes of the seeded symbol and window dimensions."""
    t = inputs.tables(spark, sf_dir)
    return (
        t.windowed("trade_agg").join(t.symbols().drop("symbol", "is_active"), "symbol_key")
        .groupBy("symbol", "base_asset", "quote_asset", "display_name", "category", "window_type")
        .agg(F.sum("trade_count").alias("trades"))
    )


@query
def trading_session(spark, sf_dir):
    return inputs.ev(spark, sf_dir).groupBy(
        clock.trading_session("ts_ms").alias("session"),
        clock.alert_session("ts_ms").alias("alert_session"),
        clock.week_of_year("ts_ms").alias("week"),
    ).agg(F.count("*").alias("events"))


@query
def datetime_key(spark, sf_dir):
    return inputs.ev(spark, sf_dir).select(
        "event_id", "ts_ms", clock.datetime_key("ts_ms").alias("datetime_key"),
    )


# -- windows and facts ----------------------------------------------------------------------

BARS = ["window_start", "window_end", "symbol", "open", "high", "low", "close", "volume",
        "vwap", "trade_count"]


def _bars(df):
    return df.withColumn("vwap", F.round("vwap", 8)).select(*BARS)


@query
def ohlcv_1s(spark, sf_dir):
    return _bars(inputs.windows_1s(spark, sf_dir))


@query
def ohlcv_5s(spark, sf_dir):
    return _bars(inputs.windows_5s(spark, sf_dir))


@query
def ohlcv_rollup_5s(spark, sf_dir):
    return _bars(trades.rollup(inputs.windows_1s(spark, sf_dir), 5_000))


def _ticks(spark, sf_dir):
    valid = trades.valid_trades(inputs.raw_trades(spark, sf_dir))
    return trades.with_event_time(valid, "trade_time")


@query
def ohlcv_small_amounts(spark, sf_dir):
    """Prices near 1e-5 and quantities from 1e-9: sums must keep what 8 decimals lose."""
    ticks = inputs.small_trades(spark, sf_dir)
    bars = trades.ohlcv(trades.with_event_time(trades.valid_trades(ticks), "trade_time"), "5 seconds")
    return bars.select(
        "window_start", "symbol", "volume", F.col("notional").cast("double").alias("notional"),
        F.round("vwap", 12).alias("vwap"), "trade_count",
    )


@query
def order_flow_1s(spark, sf_dir):
    return trades.order_flow(_ticks(spark, sf_dir), "1 second")


@query
def order_flow_5s(spark, sf_dir):
    return trades.order_flow(_ticks(spark, sf_dir), "5 seconds")


@query
def spread_snapshot(spark, sf_dir):
    df = inputs.snapshots(spark, sf_dir)
    measures = [c for c in df.columns if c.startswith("avg_")]
    return df.select("window_start", "symbol", *[F.round(c, 8).alias(c) for c in measures])


def _register_facts() -> None:
    for name in ("trade_agg", "order_flow", "kline_closed", "spread_snapshot"):
        def run(spark, sf_dir, name=name):
            return inputs.fact(spark, sf_dir, name)

        run.__name__ = f"fact_{name}"
        query(run)


_register_facts()


# -- staging --------------------------------------------------------------------------------


def _register_staging() -> None:
    for name in FACTS:
        def run(spark, sf_dir, view=getattr(staging, f"stg_{name}")):
            return view(inputs.tables(spark, sf_dir))

        run.__name__ = f"stg_{name}"
        query(run)


_register_staging()


# -- indicators -----------------------------------------------------------------------------

SERIES = ["symbol", "interval"]


def _candles(spark, sf_dir):
    return candles.closed_klines(inputs.raw_klines(spark, sf_dir)).drop("event_type")


def _show(df, *columns):
    return df.select("symbol", "open_time", *columns)


@query
def rsi(spark, sf_dir):
    return _show(indicators.rsi(_candles(spark, sf_dir), SERIES, block_ms=inputs.BLOCK_MS), "rsi_14")


@query
def macd(spark, sf_dir):
    df = indicators.macd(_candles(spark, sf_dir), SERIES, block_ms=inputs.BLOCK_MS)
    return _show(df, "macd", "macd_signal", "macd_hist")


@query
def bollinger(spark, sf_dir):
    df = indicators.bollinger(_candles(spark, sf_dir), SERIES, block_ms=inputs.BLOCK_MS)
    return _show(df, "bb_upper", "bb_middle", "bb_lower", "bb_width")


@query
def atr(spark, sf_dir):
    return _show(indicators.atr(_candles(spark, sf_dir), SERIES, block_ms=inputs.BLOCK_MS), "atr_14")


@query
def obv(spark, sf_dir):
    return _show(indicators.obv(_candles(spark, sf_dir), SERIES, block_ms=inputs.BLOCK_MS), "obv")


@query
def technical_indicators(spark, sf_dir):
    return inputs.fact(spark, sf_dir, "technical_indicator")


# -- alerts ---------------------------------------------------------------------------------

# Limits under which the derived data raises each kind of alert.
LIMITS = rules.Thresholds(
    spike_pct=0.5, spike_high_pct=1.0, surge_ratio=1.5, surge_high_ratio=2.0,
    widening_ratio=1.2, liquidity_pct=80.0,
)


def _windows_of(spark, sf_dir):
    return inputs.tables(spark, sf_dir).windowed("trade_agg", "5s")


def _snapshots_of(spark, sf_dir):
    return rules.active_snapshots(inputs.tables(spark, sf_dir))


@query
def price_spikes(spark, sf_dir):
    return rules.price_spikes(
        _windows_of(spark, sf_dir), inputs.tick_as_of(spark, sf_dir), LIMITS
    )


@query
def volume_surges(spark, sf_dir):
    return rules.volume_surges(
        _windows_of(spark, sf_dir), inputs.tick_as_of(spark, sf_dir), LIMITS
    )


@query
def spread_widening(spark, sf_dir):
    return rules.spread_widening(
        _snapshots_of(spark, sf_dir), inputs.tick_as_of(spark, sf_dir), LIMITS
    )


@query
def low_liquidity(spark, sf_dir):
    return rules.low_liquidity(
        _snapshots_of(spark, sf_dir), inputs.tick_as_of(spark, sf_dir), LIMITS
    )


@query
def detect_alerts(spark, sf_dir):
    return rules.detect_alerts(
        inputs.tables(spark, sf_dir), inputs.tick_as_of(spark, sf_dir), LIMITS, by_minutes=False
    )


@query
def detect_alerts_by_minutes(spark, sf_dir):
    """The same poll of a store that keeps minute sums: hours of baselines without their rows."""
    stored = inputs.tables(spark, sf_dir)
    for name in ("trade_agg", "spread_snapshot"):
        stored.fact(name)  # built before its minutes are summed
    stored.keep_minutes()
    return rules.detect_alerts(stored, inputs.tick_as_of(spark, sf_dir), LIMITS)


@query
def price_spikes_replay(spark, sf_dir):
    return rules.price_spikes_replay(_windows_of(spark, sf_dir))


@query
def volume_surges_replay(spark, sf_dir):
    return rules.volume_surges_replay(_windows_of(spark, sf_dir), LIMITS)


@query
def spread_widening_replay(spark, sf_dir):
    return rules.spread_widening_replay(_snapshots_of(spark, sf_dir))


@query
def low_liquidity_replay(spark, sf_dir):
    return rules.low_liquidity_replay(_snapshots_of(spark, sf_dir))


# -- marts ----------------------------------------------------------------------------------


@query
def mart_latest_prices(spark, sf_dir):
    return marts.mart_latest_prices(inputs.tables(spark, sf_dir))


@query
def mart_daily_performance(spark, sf_dir):
    return marts.mart_daily_performance(inputs.tables(spark, sf_dir), inputs.CALENDAR_AS_OF)


@query
def mart_technical_signals(spark, sf_dir):
    return marts.mart_technical_signals(inputs.tables(spark, sf_dir))


@query
def mart_orderflow_summary(spark, sf_dir):
    as_of = inputs.tick_as_of(spark, sf_dir)
    return marts.mart_orderflow_summary(inputs.tables(spark, sf_dir), as_of)


@query
def mart_spread_by_session(spark, sf_dir):
    t = inputs.tables(spark, sf_dir, "calendar")
    return marts.mart_spread_by_session(t, inputs.CALENDAR_AS_OF)


@query
def refreshed_daily_performance(spark, sf_dir):
    """The daily mart of a second refresh: no day changed, so its days are merged from the first one's."""
    t = inputs.tables(spark, sf_dir)
    for _ in range(2):
        marts.refresh_marts(t, inputs.CALENDAR_AS_OF, stored=())
    return spark.table("mart_daily_performance")


@query
def spread_by_session_merged(spark, sf_dir):
    """Sessions of a span that begins within an hour, from kept sums by hour."""
    t = inputs.tables(spark, sf_dir, "calendar")
    return marts.spread_by_session_by_day(t, inputs.CALENDAR_AS_OF - 1_234_567)


@query
def mart_alert_summary(spark, sf_dir):
    as_of = inputs.tick_as_of(spark, sf_dir)
    return marts.mart_alert_summary(inputs.tables(spark, sf_dir), as_of)


@query
def daily_summary(spark, sf_dir):
    return marts.daily_summary(inputs.tables(spark, sf_dir), DAY)


@query
def top_movers(spark, sf_dir):
    days = marts.mart_daily_performance(inputs.tables(spark, sf_dir), inputs.CALENDAR_AS_OF)
    move = F.round((F.col("day_close") - F.col("day_open")) / F.col("day_open") * 100, 6)
    moves = days.select("date", "symbol", move.alias("change_pct"))
    return ordering.top_movers(moves, "date", "change_pct", 3)


# -- read queries ---------------------------------------------------------------------------


@query
def latest_prices(spark, sf_dir):
    return serving.latest_prices(inputs.tables(spark, sf_dir))


@query
def price_history(spark, sf_dir):
    return serving.price_history(inputs.tables(spark, sf_dir), SYMBOL, "5s", 60)


@query
def orderflow_summary(spark, sf_dir):
    as_of = inputs.tick_as_of(spark, sf_dir)
    return serving.orderflow_summary(inputs.tables(spark, sf_dir), as_of)


@query
def orderflow_history(spark, sf_dir):
    return serving.orderflow_history(inputs.tables(spark, sf_dir), SYMBOL, 60)


@query
def technical(spark, sf_dir):
    return serving.technical(inputs.tables(spark, sf_dir), SYMBOL, 20)


@query
def alerts(spark, sf_dir):
    as_of = inputs.tick_as_of(spark, sf_dir)
    return serving.alerts(
        inputs.tables(spark, sf_dir), as_of, severity="MEDIUM", resolved=False, limit=50
    )


@query
def spread_history(spark, sf_dir):
    return serving.spread_history(inputs.tables(spark, sf_dir), SYMBOL, 60)


# -- quality --------------------------------------------------------------------------------


@query
def not_null(spark, sf_dir):
    raw = inputs.raw_trades(spark, sf_dir).drop("event_type")
    return quality.check_not_null(raw, ["symbol", "price", "buyer_maker"])


@query
def unique(spark, sf_dir):
    return quality.check_unique(inputs.raw_quotes(spark, sf_dir), ["symbol", "bid_price"])


@query
def accepted_values(spark, sf_dir):
    known = [row[1] for row in dims.SEEDS["symbol"][1]]
    return quality.check_accepted(
        inputs.raw_trades(spark, sf_dir).drop("event_type"), "symbol", known
    )


@query
def no_future_timestamps(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    rows = staging.stg_trade_agg(t).select("symbol", "window_type", "window_start")
    as_of = inputs.tick_as_of(spark, sf_dir) - 60_000
    return quality.no_future_timestamps(rows, "window_start", as_of)


@query
def rsi_in_range(spark, sf_dir):
    """Stored values as they are, and moved up by 40, so that some are out of range."""
    rows = inputs.fact(spark, sf_dir, "technical_indicator")
    moved = rows.withColumn("rsi_14", F.col("rsi_14") + 40)
    return quality.rsi_in_range(rows.unionByName(moved))


@query
def spread_positive(spark, sf_dir):
    spread = F.round(F.col("ask_price") - F.col("bid_price"), 8)
    rows = inputs.raw_quotes(spark, sf_dir).select("symbol", "ingested_at", spread.alias("spread"))
    return quality.spread_positive(rows)


@query
def null_rate(spark, sf_dir):
    raw, as_of = inputs.raw_trades(spark, sf_dir), inputs.tick_as_of(spark, sf_dir)
    return quality.null_rate(raw, ["price", "symbol"], as_of, "trade_time")


@query
def window_gaps(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    return quality.window_gaps(
        t.windowed("trade_agg", "1s"), 2_000, inputs.tick_as_of(spark, sf_dir),
        block_ms=10 * clock.MINUTE,
    )


@query
def late_rate(spark, sf_dir):
    return quality.late_rate(inputs.raw_trades(spark, sf_dir), 2_000)


@query
def duplicate_rate(spark, sf_dir):
    return quality.duplicate_rate(
        inputs.raw_quotes(spark, sf_dir), ["symbol", "bid_price"],
        inputs.tick_as_of(spark, sf_dir), "ingested_at",
    )


@query
def freshness(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    as_of = inputs.tick_as_of(spark, sf_dir)
    return quality.check_fresh(t.fact("trade_agg"), "window_start", as_of)


@query
def insert_rate(spark, sf_dir):
    return quality.insert_rate(inputs.raw_quotes(spark, sf_dir, "ts_ms"), "ingested_at")


@query
def orphans(spark, sf_dir):
    known = dims.seed(spark, "symbol")
    return keys.orphans(inputs.raw_trades(spark, sf_dir).drop("event_type"), known, "symbol")


@query
def run_checks_by_day(spark, sf_dir):
    """The same results from the ledger of days; the second run finds no day changed."""
    t, as_of = inputs.tables(spark, sf_dir), inputs.tick_as_of(spark, sf_dir) - 60_000
    quality.run_checks_by_day(t, as_of)
    return quality.run_checks_by_day(t, as_of)


@query
def run_checks(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    return quality.run_checks(t, inputs.tick_as_of(spark, sf_dir) - 60_000)


# -- sinks ----------------------------------------------------------------------------------


@query
def insert_if_absent(spark, sf_dir):
    """Quotes keyed by symbol and price: many copies a key, half the keys stored already."""
    rows = inputs.raw_quotes(spark, sf_dir).drop("event_type").filter("symbol is not null")
    middle = inputs.TICK_START + (inputs.tick_as_of(spark, sf_dir) - inputs.TICK_START) // 2
    stored = rows.filter(F.col("ingested_at") < middle)
    return upsert.insert_if_absent(
        stored, rows, ["symbol", "bid_price"], [F.col("ingested_at").asc()]
    )


@query
def retention(spark, sf_dir):
    rows = inputs.raw_quotes(spark, sf_dir, "ts_ms")
    kept, deleted = upsert.apply_retention(rows, "ingested_at", 7, inputs.CALENDAR_AS_OF)
    per_symbol = kept.groupBy("symbol").agg(F.count("*").alias("messages"))
    return per_symbol.unionByName(
        deleted.select(F.lit("(deleted)").alias("symbol"), F.col("deleted").alias("messages"))
    )


@query
def expire_stored(spark, sf_dir):
    """A stored fact after its retention: whole days are gone and one is cut."""
    tables = Tables(spark, root=scratch_dir(spark, "expire"), calendar=inputs.CALENDAR)
    tables.append(inputs.fact(spark, sf_dir, "spread_snapshot_calendar"), "spread_snapshot")
    tables.expire("spread_snapshot", inputs.CALENDAR_AS_OF + 10 * clock.DAY + 12 * clock.HOUR)
    return tables.fact("spread_snapshot").groupBy("symbol_key").agg(
        F.count("*").alias("snapshots"), F.min("snapshot_time").alias("first_ms")
    )


@query
def named_symbols(spark, sf_dir):
    """Trades of the symbols that are asked for, in any case of letters."""
    asked = dims.active_symbols(dims.seed(spark, "symbol"), ["btcusdt", "ETHUSDT", "nope"])
    return inputs.raw_trades(spark, sf_dir).join(asked, "symbol").groupBy("symbol").agg(
        F.count("*").alias("trades")
    )


# -- streams --------------------------------------------------------------------------------


@query
def stream_ohlcv_5s(spark, sf_dir):
    return streams.run_trades(spark, sf_dir, "5 seconds", sinks.trades_batch).fact("trade_agg")


@query
def stream_bad_trades(spark, sf_dir):
    """Messages that no stored type can hold change nothing and don't end the stream."""
    return streams.run_bad_trades(spark, sf_dir).fact("trade_agg")


@query
def stream_rejects(spark, sf_dir):
    """What the same run sets aside, by reason."""
    stored = streams.run_bad_trades(spark, sf_dir).rejects("trades")
    trade = F.get_json_object("row", "$.trade_id").cast("long")
    return stored.groupBy("reason").agg(
        F.count("*").alias("messages"), F.min(trade).alias("first_id"), F.max(trade).alias("last_id"))


@query
def rejected_rows(spark, sf_dir):
    """Trades, quotes and candles that are not used, by reason."""
    sources = {
        "trades": inputs.raw_trades(spark, sf_dir).unionByName(inputs.bad_trades(spark, sf_dir)),
        "quotes": inputs.raw_quotes(spark, sf_dir), "klines": inputs.raw_klines(spark, sf_dir),
    }
    out = None
    for kind, rows in sources.items():
        part = rejects.rejected(rows, kind).groupBy("reason").agg(F.count("*").alias("messages")).withColumn("source", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query
def stream_late_rows(spark, sf_dir):
    """Rows that come after their windows closed change nothing."""
    return streams.run_late_trades(spark, sf_dir).fact("trade_agg")


@query
def late_rows_logged(spark, sf_dir):
    """Rows read and rows too late, from the durable log of a query's three runs."""
    found = late_rows(streams.run_logged(spark, sf_dir).rows())
    return found.select("name", "input_rows", (F.col("late_rows") > 0).alias("some_late"))


@query
def stream_interval_trigger(spark, sf_dir):
    return streams.run_on_interval(spark, sf_dir).fact("spread_snapshot")


@query
def stream_order_flow_1s(spark, sf_dir):
    return streams.run_trades(spark, sf_dir, "1 second", sinks.trades_batch).fact("order_flow")


@query
def stream_spread_snapshot(spark, sf_dir):
    return streams.run_quotes(spark, sf_dir, sinks.quotes_batch).fact("spread_snapshot")


@query
def stream_klines_indicators(spark, sf_dir):
    return streams.run_klines(spark, sf_dir).fact("technical_indicator")


@query
def stream_kept_indicators(spark, sf_dir):
    """Indicators from kept frames over three runs, late candles in the last."""
    return streams.run_kept_klines(spark, sf_dir).fact("technical_indicator")


@query
def stream_alerts(spark, sf_dir):
    return streams.run_alerts(spark, sf_dir)


@query
def stream_archive(spark, sf_dir):
    return streams.run_archive(spark, sf_dir, "trades")


@query
def stream_archive_klines(spark, sf_dir):
    return streams.run_archive(spark, sf_dir, "klines")


@query
def stream_archive_bookticker(spark, sf_dir):
    return streams.run_archive(spark, sf_dir, "bookticker")


@query
def stream_trades_1s_and_5s(spark, sf_dir):
    """Two queries side by side into the same two facts."""
    return streams.run_both_windows(spark, sf_dir).fact("trade_agg")


@query
def alerts_stored_twice(spark, sf_dir):
    """The scheduled poll, run twice as of the same time: each alert is stored once."""
    source = inputs.tables(spark, sf_dir)
    as_of = inputs.tick_as_of(spark, sf_dir)
    return streams.poll_alerts(spark, source, as_of, LIMITS, times=2).fact("price_alert")
