"""Market inputs derived from ``events``: trades, quotes and candles.

Trades and quotes use the tick clock (one event each 137 ms); candles use the events' own
times. Nulls, zeros, unknown symbols and crossed books are injected by the derivation, so
that every filter has rows to reject.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import HOUR
from tickloom.operators import candles, quotes, trades
from tickloom.operators.alerts import replay_alerts
from tickloom.operators.indicators import technical_indicators
from tickloom.session import scratch_dir
from tickloom.sources.dims import Calendar, seed_dims
from tickloom.sources.tables import Tables

CALENDAR = Calendar(date(2024, 1, 1), date(2024, 2, 1))
CALENDAR_AS_OF = 1706659200000  # 2024-01-31T00:00Z
TICK_START, TICK_STEP = 1704067200000, 137
KLINE_MS = 6 * HOUR
BLOCK_MS = 120 * HOUR  # 20 of the six-hour candles

SYMBOL_OF_USER = """case user_id % 8 when 0 then 'BTCUSDT' when 1 then 'ETHUSDT'
    when 2 then 'BNBUSDT' when 3 then 'SOLUSDT' when 4 then 'XRPUSDT'
    when 5 then 'DOGEUSDT' when 6 then 'ADAUSDT' else 'AVAXUSDT' end"""


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id", "cast(get_json_object(props, '$.k') as int) as k", "value", "user_id",
        "unix_millis(cast(ts as timestamp)) as ts_ms",
        f"{TICK_START} + event_id * {TICK_STEP} as tick_ms", f"{SYMBOL_OF_USER} as sym",
    )


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev(spark, sf_dir).selectExpr(
        "'trade' as event_type",
        """case when event_id % 109 = 0 then null when event_id % 113 = 0 then 'XYZUSDT'
           else sym end as symbol""",
        "event_id as trade_id",
        """case when event_id % 101 = 0 then null when event_id % 103 = 0 then 0D
           else 10000 + value end as price""",
        "case when event_id % 107 = 0 then 0D else cast(k + 1 as double) end as quantity",
        "case when event_id % 127 = 0 then null else event_id % 2 = 0 end as buyer_maker",
        "tick_ms as trade_time", "tick_ms + (event_id % 7) * 500 as ingested_at",
    )


def bad_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of some good trades whose numbers no stored type can hold, one kind each."""
    nan, inf = "double('NaN')", "double('Infinity')"
    kinds = [(nan, "1D"), (inf, "1D"), ("5e18D", "1D"), ("1D", nan), ("1D", inf), ("1D", "1e17D"), ("9e9D", "9e9D")]
    some = raw_trades(spark, sf_dir).filter("symbol is not null and trade_id % 10 < 7")
    price, quantity = ("element_at(array({}), cast(trade_id % 10 as int) + 1)".format(", ".join(k[i] for k in kinds)) for i in (0, 1))
    return some.withColumns({"price": F.expr(price), "quantity": F.expr(quantity), "trade_id": F.col("trade_id") + 10_000_000})


def small_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of tiny prices and quantities."""
    return raw_trades(spark, sf_dir).withColumns({
        "price": F.expr("cast(1000 + trade_id % 997 as double) / 1e8D"),
        "quantity": F.expr("cast(1 + trade_id % 13 as double) / 1e9D"),
    })


def raw_quotes(spark: SparkSession, sf_dir: str, clock: str = "tick_ms") -> DataFrame:
    return ev(spark, sf_dir).selectExpr(
        "'bookticker' as event_type",
        "case when event_id % 109 = 0 then null else sym end as symbol",
        "10000 + value as bid_price", "cast(1 + user_id % 50 as double) as bid_qty",
        """case when event_id % 97 = 0 then 9999 + value
           else 10000 + value + 0.01D + k * 0.1D end as ask_price""",
        "cast(1 + event_id % 40 as double) as ask_qty", f"{clock} as ingested_at",
    )


def raw_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, order = F.col("price"), F.struct("ts_ms", "event_id")
    return (
        ev(spark, sf_dir)
        .selectExpr(
            "sym as symbol", f"ts_ms div {KLINE_MS} as bucket", "10000 + value as price", "k",
            "ts_ms", "event_id",
        )
        .groupBy("symbol", "bucket")
        .agg(
            F.min_by(price, order).alias("open"), F.max(price).alias("high"),
            F.min(price).alias("low"), F.max_by(price, order).alias("close"),
            F.sum(F.col("k") + 1).cast("double").alias("volume"),
            F.count("*").cast("int").alias("trade_count"),
            # Aggregated, so that joins see a column and not a constant.
            F.max(F.lit("1m")).alias("interval"),
        )
        .selectExpr(
            "'kline' as event_type", "symbol", "interval",
            f"bucket * {KLINE_MS} as open_time", f"bucket * {KLINE_MS} + {KLINE_MS - 1} as close_time",
            "open", "high", "low", "close", "volume", "trade_count",
            "bucket % 17 <> 0 as is_closed",
            f"bucket * {KLINE_MS} + {KLINE_MS} as ingested_at",
        )
    )


def tick_as_of(spark: SparkSession, sf_dir: str) -> int:
    """Time of the last tick (one number)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return TICK_START + events.agg(F.max("event_id")).first()[0] * TICK_STEP


def windows_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = trades.with_event_time(trades.valid_trades(raw_trades(spark, sf_dir)), "trade_time")
    return trades.ohlcv(ticks, "1 second")


def windows_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = trades.with_event_time(trades.valid_trades(raw_trades(spark, sf_dir)), "trade_time")
    return trades.ohlcv(ticks, "5 seconds")


def both_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = windows_1s(spark, sf_dir)
    return seconds.unionByName(trades.rollup(seconds, 5_000))


def snapshots(spark: SparkSession, sf_dir: str, clock: str = "tick_ms") -> DataFrame:
    valid = quotes.valid_quotes(raw_quotes(spark, sf_dir, clock))
    return quotes.spread_snapshot(trades.with_event_time(valid, "ingested_at"))


def fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    dims = seed_dims(spark)
    if name == "trade_agg":
        return trades.trade_agg_fact(both_windows(spark, sf_dir), dims)
    if name == "order_flow":
        return trades.order_flow_fact(both_windows(spark, sf_dir), dims)
    if name == "kline_closed":
        return candles.kline_fact(candles.closed_klines(raw_klines(spark, sf_dir)), dims)
    if name == "technical_indicator":
        return technical_indicators(fact(spark, sf_dir, "kline_closed"), BLOCK_MS)
    if name == "spread_snapshot":
        return quotes.spread_fact(snapshots(spark, sf_dir), dims)
    if name == "spread_snapshot_calendar":
        return quotes.spread_fact(snapshots(spark, sf_dir, "ts_ms"), dims)
    raise LookupError(name)


class Warehouse(Tables):
    """The derived facts as stored tables, each built and written when it is first read.

    ``clock="calendar"`` has the quotes on the events' own times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, clock: str):
        super().__init__(spark, root=scratch_dir(spark, "facts"), calendar=CALENDAR)
        self._sf_dir, self._clock, self._built, self._windows = sf_dir, clock, set(), None

    def fact(self, name: str, from_ms=None, to_ms=None, days=None) -> DataFrame:
        if name not in self._built:
            self._build(name)
        return super().fact(name, from_ms, to_ms, days)

    def _folders(self, name: str):
        if name not in self._built:
            self._build(name)
        return super()._folders(name)

    def _both_windows(self) -> DataFrame:
        """:func:`both_windows`, aggregated and stored once for the two facts that are made of them."""
        if self._windows is None:
            seconds, longer = (f"{self.root}/windows/{label}" for label in ("1s", "5s"))
            windows_1s(self.spark, self._sf_dir).write.parquet(seconds)
            stored = self.spark.read.parquet(seconds)
            trades.rollup(stored, 5_000).write.parquet(longer)
            self._windows = stored.unionByName(self.spark.read.schema(stored.schema).parquet(longer))
        return self._windows

    def _build(self, name: str) -> None:
        if name == "price_alert":
            derived = replay_alerts(self)
        elif name in ("trade_agg", "order_flow"):
            made = trades.trade_agg_fact if name == "trade_agg" else trades.order_flow_fact
            derived = made(self._both_windows(), seed_dims(self.spark))
        elif name == "technical_indicator":
            derived = technical_indicators(self.fact("kline_closed"), BLOCK_MS)
        elif name == "spread_snapshot" and self._clock == "calendar":
            derived = fact(self.spark, self._sf_dir, "spread_snapshot_calendar")
        else:
            derived = fact(self.spark, self._sf_dir, name)
        self.append(derived, name)
        self._built.add(name)


_warehouses: dict[tuple[str, str, str], Warehouse] = {}


def tables(spark: SparkSession, sf_dir: str, clock: str = "tick") -> Warehouse:
    """The session's warehouse over one input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, clock)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, sf_dir, clock)
    return _warehouses[key]
