"""Trades: validity, tumbling OHLCV with order flow, and their facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.functions.numbers import exact_sum, pct_change
from tickloom.operators.keys import resolve_keys, resolve_window
from tickloom.operators.rejects import AMOUNT_LIMIT, NOTIONAL_LIMIT, PRICE_LIMIT, within
from tickloom.schemas import conform


def valid_trades(df: DataFrame) -> DataFrame:
    """Trades with a symbol and a positive price and quantity, finite and within the stored types."""
    return df.filter(
        F.col("symbol").isNotNull() & within("price", PRICE_LIMIT) & within("quantity", AMOUNT_LIMIT)
        & (F.col("price") * F.col("quantity") < NOTIONAL_LIMIT)
    )


def with_event_time(df: DataFrame, ms: str) -> DataFrame:
    return df.withColumn("event_time", clock.event_time(ms))


def ohlcv(df: DataFrame, duration: str) -> DataFrame:
    """Tumbling open/high/low/close, volume, vwap and order flow a symbol, in one pass.

    Open and close follow (trade_time, trade_id), so they do not depend on the order in
    which a shuffle delivers rows. A null ``buyer_maker`` is neither a buy nor a sell.
    """
    order = F.struct("trade_time", "trade_id")
    quantity, taker_sold = F.col("quantity"), F.col("buyer_maker")
    notional = F.col("price") * quantity
    return (
        df.groupBy(F.window("event_time", duration), "symbol")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            exact_sum(quantity).alias("volume"),
            exact_sum(notional).alias("notional"),
            F.count("*").alias("trade_count"),
            exact_sum(F.when(~taker_sold, quantity).otherwise(0.0)).alias("buy_volume"),
            exact_sum(F.when(taker_sold, quantity).otherwise(0.0)).alias("sell_volume"),
            F.count_if(~taker_sold).alias("buy_count"),
            F.count_if(taker_sold).alias("sell_count"),
        )
        .select(
            F.unix_millis("window.start").alias("window_start"),
            F.unix_millis("window.end").alias("window_end"),
            "symbol", "open", "high", "low", "close", "volume", "notional",
            _vwap(), "trade_count", "buy_volume", "sell_volume", "buy_count", "sell_count",
        )
    )


def _vwap():
    mean = F.try_divide(F.col("notional").cast("double"), F.col("volume").cast("double"))
    return F.coalesce(mean, F.col("close")).alias("vwap")  # quantities under 5e-19 weigh nothing


def rollup(windows: DataFrame, duration_ms: int) -> DataFrame:
    """Longer windows out of shorter ones; equal to aggregating the trades again.

    The trades are then read and shuffled once for all window lengths.
    """
    start = clock.floor_div("window_start", duration_ms) * duration_ms
    return (
        windows.withColumn("_start", start)
        .groupBy("_start", "symbol")
        .agg(
            F.min_by("open", "window_start").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "window_start").alias("close"),
            *[
                F.sum(c).cast("decimal(38,18)").alias(c)
                for c in ("volume", "notional", "buy_volume", "sell_volume")
            ],
            *[F.sum(c).alias(c) for c in ("trade_count", "buy_count", "sell_count")],
        )
        .withColumn("window_start", F.col("_start"))
        .withColumn("window_end", F.col("_start") + duration_ms)
        .withColumn("vwap", _vwap())
        .select(*windows.columns)
    )


def order_flow(df: DataFrame, duration: str) -> DataFrame:
    """The order-flow part of :func:`ohlcv` alone."""
    return ohlcv(df, duration).select(
        "window_start", "window_end", "symbol",
        "buy_volume", "sell_volume", "buy_count", "sell_count",
    )


def trade_agg_fact(windows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    keyed = resolve_window(resolve_keys(windows, dims["symbol"]), dims["window_type"])
    return conform(
        keyed.withColumn("datetime_key", clock.datetime_key("window_start"))
        .withColumn("price_change", F.col("close") - F.col("open"))
        .withColumn("price_change_pct", pct_change("close", "open")),
        "trade_agg",
    )


def order_flow_fact(windows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    keyed = resolve_window(resolve_keys(windows, dims["symbol"]), dims["window_type"])
    buy, sell = F.col("buy_volume").cast("double"), F.col("sell_volume").cast("double")
    return conform(
        keyed.withColumn("datetime_key", clock.datetime_key("window_start"))
        .withColumn("total_volume", F.col("buy_volume") + F.col("sell_volume"))
        .withColumn("net_flow", F.col("buy_volume") - F.col("sell_volume"))
        .withColumn(
            "buy_pct",
            F.when(buy + sell > 0, buy / (buy + sell) * 100).otherwise(F.lit(50.0)),
        ),
        "order_flow",
    )
