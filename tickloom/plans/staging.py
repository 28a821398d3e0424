"""Staging views: facts with names instead of keys, doubles instead of decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import labels
from tickloom.sources.dims import with_calendar


def natural_key(*columns: str) -> Column:
    """A row's identity, in place of a sequence number."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in columns])


def _doubles(*columns: str) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in columns]


def _symbols(tables, *extra: str) -> DataFrame:
    return tables.symbols().select("symbol_key", "symbol", *extra)


def _windowed(tables, name: str, *extra: str, **bounds) -> DataFrame:
    labels_ = tables.dim("window_type").select(
        "window_key", F.col("window_label").alias("window_type")
    )
    return tables.fact(name, **bounds).join(_symbols(tables, *extra), "symbol_key").join(
        labels_, "window_key"
    )


def stg_trade_agg(tables, **bounds) -> DataFrame:
    df = _windowed(tables, "trade_agg", "display_name", "category", **bounds)
    calendar = ["trading_session", "hour", "day_of_week", "is_weekend"]
    return with_calendar(df, tables.calendar, "window_start", calendar).select(
        natural_key("symbol", "window_start", "window_type").alias("trade_agg_key"),
        "symbol", "display_name", "category", "window_type", "window_start", "window_end",
        *_doubles("open", "high", "low", "close", "volume", "vwap"), "trade_count",
        *_doubles("price_change", "price_change_pct"), *calendar,
    )


def stg_order_flow(tables, **bounds) -> DataFrame:
    df = _windowed(tables, "order_flow", **bounds)
    return with_calendar(df, tables.calendar, "window_start", ["trading_session", "hour"]).select(
        natural_key("symbol", "window_start", "window_type").alias("order_flow_key"),
        "symbol", "window_type", "window_start",
        *_doubles("buy_volume", "sell_volume", "total_volume"), "buy_count", "sell_count",
        *_doubles("buy_pct"), (100 - F.col("buy_pct")).cast("double").alias("sell_pct"),
        *_doubles("net_flow"), "trading_session", "hour",
    )


def stg_kline_closed(tables, **bounds) -> DataFrame:
    df = tables.fact("kline_closed", **bounds).join(_symbols(tables), "symbol_key")
    calendar = ["trading_session", "date", "hour"]
    return with_calendar(df, tables.calendar, "open_time", calendar).select(
        natural_key("symbol", "interval_key", "open_time").alias("kline_key"),
        "symbol", "interval_key", "open_time", "close_time",
        *_doubles("open", "high", "low", "close", "volume"), "trade_count",
        *_doubles("price_change", "price_change_pct", "amplitude"), "is_bullish", *calendar,
    )


def stg_spread_snapshot(tables, **bounds) -> DataFrame:
    facts = tables.fact("spread_snapshot", **bounds).filter(F.col("spread") > 0)
    df = facts.join(_symbols(tables), "symbol_key")
    calendar = ["trading_session", "hour", "date"]
    return with_calendar(df, tables.calendar, "snapshot_time", calendar).select(
        natural_key("symbol", "snapshot_time").alias("spread_key"),
        "symbol", "snapshot_time",
        *_doubles(
            "bid_price", "ask_price", "mid_price", "spread", "spread_pct",
            "bid_qty", "ask_qty", "liquidity_imbalance",
        ),
        *calendar,
    )


INDICATORS = (
    "rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_middle", "bb_lower",
    "bb_width", "atr_14", "obv",
)


def stg_technical_indicator(tables, **bounds) -> DataFrame:
    df = tables.fact("technical_indicator", **bounds).join(_symbols(tables), "symbol_key")
    return df.select(
        natural_key("symbol", "interval_key", "open_time").alias("tech_key"),
        "symbol", "interval_key", "open_time", *_doubles(*INDICATORS),
        labels.rsi_state(F.col("rsi_14")).alias("rsi_signal"),
        labels.macd_state(F.col("macd"), F.col("macd_signal")).alias("macd_signal_dir"),
    )


def stg_price_alert(tables, **bounds) -> DataFrame:
    kinds = tables.dim("alert_type").select(
        "alert_type_key", "alert_code", F.col("description").alias("alert_description")
    )
    df = tables.fact("price_alert", **bounds).join(_symbols(tables), "symbol_key").join(
        kinds, "alert_type_key"
    )
    calendar = ["trading_session", "date"]
    return with_calendar(df, tables.calendar, "triggered_at", calendar).select(
        natural_key("symbol", "alert_code", "triggered_at").alias("alert_key"),
        "symbol", "alert_code", "alert_description", "triggered_at",
        *_doubles("trigger_value", "threshold_pct"),
        "severity", "is_resolved", "resolved_at", *calendar,
    )
