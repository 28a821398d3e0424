"""Message schemas, fact schemas and their natural keys."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

_TYPES = {
    "string": StringType(), "long": LongType(), "int": IntegerType(),
    "double": DoubleType(), "boolean": BooleanType(),
}


def _type(name: str) -> DataType:
    if name.startswith("decimal"):
        return DecimalType(*map(int, re.findall(r"\d+", name)))
    return _TYPES[name]


def columns(text: str) -> StructType:
    """``"a int, b decimal(18,8)"`` as a schema, without needing a session."""
    out = StructType()
    for field in re.split(r",\s+", text):
        name, kind = field.split(" ")
        out = out.add(name, _type(kind))
    return out

# Message layouts.
TRADE = columns(
    "event_type string, symbol string, trade_id long, price double, quantity double, "
    "buyer_maker boolean, trade_time long, ingested_at long"
)
KLINE = columns(
    "event_type string, symbol string, interval string, open_time long, close_time long, "
    "open double, high double, low double, close double, volume double, trade_count int, "
    "is_closed boolean, ingested_at long"
)
BOOKTICKER = columns(
    "event_type string, symbol string, bid_price double, bid_qty double, "
    "ask_price double, ask_qty double, ingested_at long"
)


@dataclass(frozen=True)
class Fact:
    """A fact table: its stored types, natural key, time column and retention."""

    name: str
    schema: StructType
    keys: tuple[str, ...]
    time: str
    retention_days: int
    references: tuple[tuple[str, str], ...]
    nullable: frozenset[str] = frozenset()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def series(self) -> list[str]:
        """What tells the series of a fact apart: its key without the time."""
        return [c for c in self.keys if c != self.time]

    @property
    def required(self) -> list[str]:
        return [c for c in self.columns if c not in self.nullable]


def _fact(name, ddl, keys, time, days, references, nullable=()):
    return Fact(
        name, columns(ddl), tuple(keys), time, days,
        tuple(references), frozenset(nullable),
    )


_SYMBOL = ("symbol_key", "symbol")
_WINDOW = ("window_key", "window_type")

# Stored types, keys and retention of the six facts. Percentages, ratios and
# observed values have room for any outlier: one must not stop a stream.
FACTS = {
    f.name: f
    for f in (
        _fact(
            "trade_agg",
            "symbol_key int, datetime_key long, window_key int, window_start long, "
            "window_end long, open decimal(18,8), high decimal(18,8), low decimal(18,8), "
            "close decimal(18,8), volume decimal(24,8), vwap decimal(18,8), trade_count int, "
            "price_change decimal(18,8), price_change_pct decimal(24,6)",
            ["symbol_key", "window_start", "window_key"], "window_start", 90,
            [_SYMBOL, _WINDOW],
        ),
        _fact(
            "order_flow",
            "symbol_key int, datetime_key long, window_key int, window_start long, "
            "buy_volume decimal(24,8), sell_volume decimal(24,8), total_volume decimal(24,8), "
            "buy_count int, sell_count int, buy_pct decimal(6,3), net_flow decimal(24,8)",
            ["symbol_key", "window_start", "window_key"], "window_start", 90,
            [_SYMBOL, _WINDOW],
        ),
        _fact(
            "kline_closed",
            "symbol_key int, datetime_key long, interval_key int, open_time long, "
            "close_time long, open decimal(18,8), high decimal(18,8), low decimal(18,8), "
            "close decimal(18,8), volume decimal(24,8), trade_count int, "
            "price_change decimal(18,8), price_change_pct decimal(24,6), "
            "amplitude decimal(24,6), is_bullish boolean",
            ["symbol_key", "interval_key", "open_time"], "open_time", 90,
            [_SYMBOL, ("interval_key", "kline_interval")],
        ),
        _fact(
            "technical_indicator",
            "symbol_key int, datetime_key long, interval_key int, open_time long, "
            "rsi_14 decimal(8,4), macd decimal(18,8), macd_signal decimal(18,8), "
            "macd_hist decimal(18,8), bb_upper decimal(18,8), bb_middle decimal(18,8), "
            "bb_lower decimal(18,8), bb_width decimal(24,6), atr_14 decimal(18,8), "
            "obv decimal(24,8)",
            ["symbol_key", "interval_key", "open_time"], "open_time", 90,
            [_SYMBOL],
            ["rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_middle",
             "bb_lower", "bb_width", "atr_14", "obv"],
        ),
        _fact(
            "spread_snapshot",
            "symbol_key int, datetime_key long, snapshot_time long, bid_price decimal(18,8), "
            "ask_price decimal(18,8), mid_price decimal(18,8), spread decimal(18,8), "
            "spread_pct decimal(24,6), bid_qty decimal(24,8), ask_qty decimal(24,8), "
            "liquidity_imbalance decimal(24,6)",
            ["symbol_key", "snapshot_time"], "snapshot_time", 30,
            [_SYMBOL],
        ),
        _fact(
            "price_alert",
            "symbol_key int, datetime_key long, alert_type_key int, triggered_at long, "
            "trigger_value decimal(24,8), threshold_pct decimal(24,6), severity string, "
            "is_resolved boolean, resolved_at long",
            ["symbol_key", "alert_type_key", "triggered_at"], "triggered_at", 90,
            [_SYMBOL, ("alert_type_key", "alert_type")],
            ["resolved_at"],
        ),
    )
}


def conform(df: DataFrame, fact: str) -> DataFrame:
    """The fact's columns in order, rounded to its stored DECIMAL types.

    What doesn't fit its type (a ratio to almost nothing, a sum beyond all amounts) becomes null.
    """
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in FACTS[fact].schema]
    )


def misfit(fact: str) -> Column:
    """Of conformed rows whose required columns had values: which of these did not fit, else null."""
    required = [c for c in FACTS[fact].required if c not in FACTS[fact].keys]
    return F.coalesce(*(F.when(F.col(c).isNull(), f"{c} out of range") for c in required))
