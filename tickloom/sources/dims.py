"""Dimensions: seeded small tables and the minute calendar."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import clock

# Rows of the small dimensions.
SEEDS = {
    "symbol": (
        "symbol_key int, symbol string, base_asset string, quote_asset string, "
        "display_name string, category string, is_active boolean",
        [
            (1, "BTCUSDT", "BTC", "USDT", "Bitcoin", "Layer1", True),
            (2, "ETHUSDT", "ETH", "USDT", "Ethereum", "Layer1", True),
            (3, "BNBUSDT", "BNB", "USDT", "BNB", "Exchange", True),
            (4, "SOLUSDT", "SOL", "USDT", "Solana", "Layer1", True),
            (5, "XRPUSDT", "XRP", "USDT", "XRP", "Layer1", True),
            (6, "DOGEUSDT", "DOGE", "USDT", "Dogecoin", "Meme", True),
            (7, "ADAUSDT", "ADA", "USDT", "Cardano", "Layer1", True),
            (8, "AVAXUSDT", "AVAX", "USDT", "Avalanche", "Layer1", True),
        ],
    ),
    "window_type": (
        "window_key int, window_label string, duration_ms int, description string",
        [
            (1, "1s", 1000, "1-second tumbling window"),
            (2, "5s", 5000, "5-second tumbling window"),
        ],
    ),
    "kline_interval": (
        "interval_key int, interval_label string, duration_ms long, description string",
        [(1, "1m", 60000, "1-minute candlestick")],
    ),
    "alert_type": (
        "alert_type_key int, alert_code string, description string, default_severity string",
        [
            (1, "price_spike", "Giá thay đổi > 1% trong 5 giây", "HIGH"),
            (2, "volume_surge", "Volume > 3x trung bình 30 phút trước", "MEDIUM"),
            (3, "spread_widening", "Spread > 2x trung bình 1 giờ trước", "MEDIUM"),
            (4, "low_liquidity", "Bid+ask qty < 20% trung bình 24 giờ", "LOW"),
        ],
    ),
}

def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def seed(spark: SparkSession, name: str) -> DataFrame:
    """A small dimension as an inline relation.

    Catalyst knows the exact size of an inline relation, so joins with it are broadcast by
    the size threshold and need no hint.
    """
    ddl, rows = SEEDS[name]
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    names = ", ".join(f[0] for f in fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS seed({names})").select(
        *[F.col(n).cast(t).alias(n) for n, t in fields]
    )


def seed_dims(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: seed(spark, name) for name in SEEDS}


def active_symbols(dim_symbol: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Key and name of the symbols in use, optionally only the named ones."""
    keep = F.col("is_active")
    if symbols is not None:
        keep = keep & F.col("symbol").isin([s.upper() for s in symbols])
    return dim_symbol.filter(keep).select("symbol_key", "symbol")


@dataclass(frozen=True)
class Calendar:
    """The minutes of ``[start, end)``."""

    start: date
    end: date

    @property
    def start_ms(self) -> int:
        return (self.start - date(1970, 1, 1)).days * clock.DAY

    @property
    def end_ms(self) -> int:
        return (self.end - date(1970, 1, 1)).days * clock.DAY

    def holds(self, datetime_key: Column) -> Column:
        first, end = (int(d.strftime("%Y%m%d")) * 10_000 for d in (self.start, self.end))
        return (datetime_key >= first) & (datetime_key < end)


def dim_datetime(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row a minute, generated on the executors."""
    cal = Calendar(start, end)
    minutes = (cal.end_ms - cal.start_ms) // clock.MINUTE
    ms = F.col("id") * clock.MINUTE + cal.start_ms
    d = clock.day("ms")
    return spark.range(minutes).select(ms.alias("ms")).select(
        clock.datetime_key("ms").alias("datetime_key"),
        clock.event_time("ms").alias("full_timestamp"),
        d.alias("date"),
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.month(d).cast("smallint").alias("month"),
        clock.week_of_year("ms").cast("smallint").alias("week_of_year"),
        F.dayofmonth(d).cast("smallint").alias("day_of_month"),
        clock.day_of_week("ms").cast("smallint").alias("day_of_week"),
        clock.is_weekend("ms").alias("is_weekend"),
        clock.hour("ms").cast("smallint").alias("hour"),
        clock.minute("ms").cast("smallint").alias("minute"),
        clock.trading_session("ms").alias("trading_session"),
    )


CALENDAR_COLUMNS = {
    "date": clock.day,
    "hour": lambda ms: clock.hour(ms).cast("smallint"),
    "day_of_week": lambda ms: clock.day_of_week(ms).cast("smallint"),
    "is_weekend": clock.is_weekend,
    "trading_session": clock.trading_session,
}


def with_calendar(
    df: DataFrame, calendar: Calendar | DataFrame, ms: str, columns: list[str]
) -> DataFrame:
    """Calendar columns of each row's minute; rows outside the calendar are dropped.

    A :class:`Calendar` has every minute of its range, so joining it is the same as testing
    the range and computing the columns, which costs no shuffle of the fact. A stored calendar
    (a DataFrame, which may have holes or own columns) is joined by ``datetime_key``.
    """
    if isinstance(calendar, Calendar):
        return df.filter(calendar.holds(F.col("datetime_key"))).withColumns(
            {name: CALENDAR_COLUMNS[name](ms) for name in columns}
        )
    return df.join(calendar.select("datetime_key", *columns), "datetime_key")
